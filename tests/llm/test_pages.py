"""Main text of pages: the thresholded paths choose blocks, with and without an article element."""

from __future__ import annotations

import pytest

from agrilake.llm import tag_paths

LONG = "Rain fell on the hills, and the river rose; by noon, the lower fields stood under water, as they had in spring."
BODY = "".join(f"<p>{LONG} {i}.</p>" for i in range(4))
TEXT = "\n\n".join(f"{LONG} {i}." for i in range(4))


def page(inner: str) -> str:
    return f"<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav>{inner}<footer>(c) us.</footer></body></html>"


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
@pytest.mark.parametrize(
    "clutter",
    [
        "<div class='zone-7'>Buy now</div>",
        "<div class='zone-7'><a href='/a'>One more</a> <a href='/b'>Another</a></div>",
        "<ul class='x'><li><a href='/a'>One more</a></li><li><a href='/b'>Another</a></li></ul>",
        f"<ol class='commentlist'><li><p>{LONG}</p></li></ol>",
        f"<div class='advertorial'><p>{LONG}</p></div>",
    ],
)
def test_clutter_inside_the_content_goes(tag, clutter):
    assert tag_paths.main_text(page(f"<{tag}>{BODY}{clutter}</{tag}>")) == TEXT


@pytest.mark.parametrize("tag", ["article", "main"])
def test_articles_of_comments_inside_the_content_go(tag):
    assert tag_paths.main_text(page(f"<{tag}>{BODY}<article class='comment'><p>{LONG}</p></article></{tag}>")) == TEXT


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
@pytest.mark.parametrize(
    ("block", "text"),
    [
        ("<p>Then it stopped</p>", "Then it stopped"),
        ("<h2>After the rain</h2>", "After the rain"),
        ("<ul><li>two bridges</li><li>one mill</li></ul>", "two bridges\n\none mill"),
        ("<blockquote>No boats left</blockquote>", "No boats left"),
        ("<table><tr><td>Level</td><td>4 m</td></tr></table>", "Level\n\n4 m"),
        ("<div>So it ended.</div>", "So it ended."),
        ("<p><a href='/mill'>The mill</a> stands</p>", "The mill stands"),
    ],
)
def test_short_blocks_inside_the_content_stay(tag, block, text):
    assert tag_paths.main_text(page(f"<{tag}>{BODY}{block}{BODY}</{tag}>")) == f"{TEXT}\n\n{text}\n\n{TEXT}"


def test_title_in_the_header_of_an_article():
    inner = f"<article><header class='entry-header'><h1>The flood</h1><nav><a href='/'>Up</a></nav></header>{BODY}</article>"
    assert tag_paths.main_text(page(inner)) == f"The flood\n\n{TEXT}"


def test_title_and_last_line_beside_the_content():
    inner = f"<h1>The flood</h1><div>{BODY}</div><div>So it ended.</div>"
    assert tag_paths.main_text(page(inner)) == f"The flood\n\n{TEXT}\n\nSo it ended."


def test_short_text_outside_an_article_goes():
    inner = f"<h3>More on this</h3><div>Sign in.</div><article>{BODY}</article><div>All rights reserved.</div>"
    assert tag_paths.main_text(page(inner)) == TEXT


def test_paths_decide_where_the_article_is_only_a_teaser():
    story = "".join(f"<p>{LONG} {LONG} {LONG} {i}.</p>" for i in range(30))
    found = tag_paths.main_text(page(f"<article>Hot</article><div>{story}</div>"))
    assert found.count(LONG) == 90


def test_several_articles_and_ties():
    inner = "".join(f"<article><h2>Day {i}</h2>{BODY}</article>" for i in range(3))
    assert tag_paths.main_text(page(inner)) == "\n\n".join(f"Day {i}\n\n{TEXT}" for i in range(3))
    assert tag_paths.main_text("<p>a</p><p>a</p>") == "a\n\na"


def test_path_scores_against_plain_sums():
    nodes = [(1, "a.b."), (2, "xy"), (1, "c" * 8), (3, "!")]
    by_size, by_marks = [6.0, 2.0, 6.0, 1.0], [2.0, 1.0, 2.0, 2.0]
    from math import exp

    def smooth(values):
        weight = [[exp(-((i - j) ** 2) / 2) if abs(i - j) <= 2 else 0.0 for j in range(4)] for i in range(4)]
        return [sum(w * v for w, v in zip(row, values, strict=True)) / sum(row) for row in weight]

    expected = [a * b for a, b in zip(smooth(by_size), smooth(by_marks), strict=True)]
    assert tag_paths.path_scores(nodes) == pytest.approx(expected)
