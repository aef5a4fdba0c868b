"""Main text of web pages by tag-path ratios.

Every text node belongs to the path of tags from the root to it. Per page and path, the characters and the punctuation
of all its nodes are divided by their number; the two ratios are smoothed over the page's order of nodes with a
Gaussian window, fused by multiplication and cut at a share of their mean or spread. An `article` or `main` is only a prior: where a
page has one, nodes outside it have a tenth of their score. Furniture (menus, adverts, forms, comments, ... by tag, class, id or
role) has no score at all.

A block with a node above the cut is content wherever it stands. Blocks below the cut join by what they share with content:

- in the content element, which is the outermost article or main, else the deepest element with half of the chosen characters:
  headings, paragraphs, list items, cells and the like; other blocks, and those that are nothing but links, if they end as
  sentences do. So unnamed buttons, teasers and lists of links inside an article are cut;
- outside it, on the same side of an article's border: headings right before content, and sentences next to a chosen block.

Cases: null or empty html, and pages without text, give an empty text; text outside any tag belongs to the root path;
unclosed and stray tags are tolerated; pages of any length and depth are parsed whole, in time linear in both; ties between
elements go to the first; repeated rows give equal rows; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from math import exp

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of HTML: elements without an end tag, elements that break lines, and elements whose text is no prose.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody"
    " td tfoot th thead title tr ul".split()
)
SILENT = frozenset("script style noscript template head title iframe object svg canvas math audio video".split())
FURNITURE = frozenset("nav header footer aside form button select textarea input dialog menu option label".split())
CLOSES_P = BLOCK - frozenset("html body head title".split())
#: Elements that an opening tag of the same kind ends, and the elements beyond which it doesn't reach.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in class, id or role that name furniture.
NAMED = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert[a-z]*|banner|sponsor(?:ed)?|promo(?:tion)?s?|navs?|navbar"
    r"|navigation|menus?|menubar|breadcrumbs?|sidebars?|side|aside|foot|footers?|heads?|headers?|masthead|topbar"
    r"|comment(?!ar)[a-z]*|replies|reply|respond|discussion|disqus|share|sharing|social|related|recommended|newsletter"
    r"|subscribe|signup|login|cookies?|consent|gdpr|notices?|popup|modal|overlay|search|toolbar|pagination|pager"
    r"|skip|copyright|legal|complementary|contentinfo|alert|widgets?)(?:$|[-_ 0-9])"
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks whose text is content in the content element even where their path has little of it.
PROSE = HEADINGS | frozenset("p li dt dd td th caption figcaption blockquote pre summary article main".split())
#: How a sentence ends, quotes and brackets closed.
SENTENCE = re.compile("[.!?…。！？:;][\"'”’»)\\]]*$")
#: Share of their score that nodes outside an article keep on pages that have one.
OUTSIDE = 0.1
WHITE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?¡¿…。、，！？]")


class _Element:
    __slots__ = ("tag", "parent", "depth", "furniture", "path", "article", "block", "link", "scored")

    def __init__(self, tag: str, parent: _Element | None, furniture: bool, article: bool, path: int):
        self.tag, self.parent, self.path = tag, parent, path
        self.depth = parent.depth + 1 if parent else 0
        self.furniture = furniture or bool(parent and parent.furniture)
        self.article = article or bool(parent and parent.article)
        self.block: _Element = self if tag in BLOCK or not parent else parent.block
        self.link = tag == "a" or bool(parent and parent.link)
        self.scored = 0


class _Pages(HTMLParser):
    """Collects text nodes with their elements, and where blocks end; in time linear in the page, however deep it is."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.here = _Element("", None, False, False, 0)
        self.elements: list[_Element] = [self.here]  # parents before children
        self.paths: dict[tuple[int, str], int] = {}  # number of a path, by its parent path's and the tag
        self.open: list[_Element] = [self.here]
        self.places: dict[str, list[int]] = {}  # places of the open elements of a tag; of all blocks under the empty tag
        self.nodes: list[tuple[_Element, str] | None] = []  # None: a block ends here

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.nodes.append((self.here, " "))
            return
        if tag == "body":
            self._end({"head"}, set())
        if tag in CLOSES_P:
            self._end({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "button"})
            self.nodes.append(None)
        if tag in SIBLINGS:
            self._end(*SIBLINGS[tag])
        if tag in VOID:
            return
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower()
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        article = tag in ("article", "main") and not hidden
        # an article's header belongs to it; other headers, footers and named furniture, an article of a comment among it, don't
        inner = self.here.article
        own = tag in ("html", "body") or (tag == "header" and inner) or (article and not inner)
        furniture = hidden or tag in SILENT or (tag in FURNITURE and not own)
        furniture = furniture or not own and bool(named and NAMED.search(named))
        path = self.paths.setdefault((self.here.path, tag), len(self.paths) + 1)
        self.here = _Element(tag, self.here, furniture, article, path)
        self.elements.append(self.here)
        for name in (tag, "") if tag in BLOCK else (tag,):
            self.places.setdefault(name, []).append(len(self.open))
        self.open.append(self.here)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "br":
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.nodes.append(None)
        self._end({tag}, set() if tag in BLOCK else {""})

    def _last(self, tags: set[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _end(self, tags: set[str], walls: set[str]) -> None:
        """Ends the innermost open element of `tags`, and what is open in it, unless a wall lies in between."""
        at = self._last(tags)
        if not at or at < self._last(walls):
            return
        for element in self.open[at:]:
            self.places[element.tag].pop()
            if element.tag in BLOCK:
                self.places[""].pop()
        del self.open[at:]
        self.here = self.open[-1]

    def handle_data(self, data: str) -> None:
        if not (self.here.furniture and self.here.tag in SILENT):
            self.nodes.append((self.here, data))


def path_scores(nodes: list[tuple[int, str]], sigma: float = 1.0, radius: int = 2) -> list[float]:
    """Fused and smoothed ratio of every (path, text) node."""
    size: dict[int, int] = {}
    marks: dict[int, int] = {}
    times: dict[int, int] = {}
    for path, text in nodes:
        times[path] = times.get(path, 0) + 1
        size[path] = size.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
    by_size = [size[p] / times[p] for p, _ in nodes]
    by_marks = [1 + marks[p] / times[p] for p, _ in nodes]
    window = [exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            total = weight = 0.0
            for k, w in enumerate(window, start=i - radius):
                if 0 <= k < len(values):
                    total += w * values[k]
                    weight += w
            out.append(total / weight)
        return out

    return [a * b for a, b in zip(smooth(by_size), smooth(by_marks), strict=True)]


def main_text(html: str | None, share: float = 0.5) -> str:
    """Text of the content blocks; `share` of the scores' mean or standard deviation, the larger, is the cut."""
    if not html:
        return ""
    parser = _Pages()
    parser.feed(html)
    parser.close()
    blocks = _blocks(parser.nodes)
    if not blocks:
        return ""
    nodes = [(e, t) for block in blocks for e, t in block.nodes]
    scores = path_scores([(e.path, t) for e, t in nodes])
    if any(e.article for e, _ in nodes):
        scores = [s if e.article else OUTSIDE * s for s, (e, _) in zip(scores, nodes, strict=True)]
    mean = sum(scores) / len(scores)
    # the spread tells content from many menu entries; where nearly all is content, there is little spread
    cut = share * max(mean, (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5)
    at = 0
    for block in blocks:
        block.chosen = max(scores[at : at + len(block.nodes)]) >= cut
        at += len(block.nodes)
    inside = _inside(_content(parser.elements, blocks))
    kept = [b.chosen or b.prose and inside(b.element) for b in blocks]
    for i in range(len(blocks) - 1, -1, -1):  # backwards, so that a heading before a kept heading stays
        block = blocks[i]
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(blocks) and blocks[j].element.article == block.element.article]
        kept[i] = (
            kept[i]
            or (block.element.tag in HEADINGS and i + 1 in near and kept[i + 1])
            or (block.sentence and any(blocks[j].chosen for j in near))
        )
    return "\n\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


class _Block:
    """A run of text without a break: its nodes that aren't blank, and the block element it stands in."""

    __slots__ = ("nodes", "text", "element", "sentence", "prose", "chosen")

    def __init__(self, nodes: list[tuple[_Element, str]], text: str):
        self.nodes, self.text = nodes, text
        self.element = nodes[0][0].block
        self.sentence = bool(SENTENCE.search(text))
        self.prose = self.sentence or self.element.tag in PROSE and not all(e.link for e, _ in nodes)
        self.chosen = False


def _blocks(nodes: list[tuple[_Element, str] | None]) -> list[_Block]:
    blocks: list[_Block] = []
    run: list[tuple[_Element, str]] = []
    for node in [*nodes, None]:
        if node is None:
            clean = [(e, t) for e, raw in run if (t := WHITE.sub(" ", raw).strip())]
            if clean:
                blocks.append(_Block(clean, WHITE.sub(" ", "".join([t for _, t in run])).strip()))
            run = []
        elif not node[0].furniture:
            run.append(node)
    return blocks


def _content(elements: list[_Element], blocks: list[_Block]) -> _Element:
    """The deepest element with half of the chosen characters, or the outermost article around it; ties go to the first."""
    total = 0
    for block in blocks:
        if block.chosen:
            block.element.scored += len(block.text)
            total += len(block.text)
    for element in reversed(elements):
        if element.parent:
            element.parent.scored += element.scored
    content = max((e for e in elements if 2 * e.scored >= total), key=lambda e: e.depth)
    # one paragraph may be half of the text: its neighbours belong to it
    while content.parent and (content.tag not in BLOCK or content.tag in PROSE and not content.article):
        content = content.parent
    while content.article and content.parent and content.parent.article:
        content = content.parent
    return content


def _inside(content: _Element):
    """A test whether an element lies in `content`, in time linear in all elements it is asked for."""
    known: dict[int, bool] = {id(content): True}

    def belongs(element: _Element | None) -> bool:
        trail = []
        while element and id(element) not in known:
            trail.append(element)
            element = element.parent
        found = bool(element and known[id(element)])
        for x in trail:
            known[id(x)] = found
        return found

    return belongs


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; a page is parsed by itself, in Arrow batches, without a shuffle."""
    keep = pages.select("page_id", "url", "html")
    types = dict(keep.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return keep.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
