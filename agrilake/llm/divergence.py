"""Quality rules by distribution divergence: how far a text lies from the languages it may be in.

Two histograms describe a text: its characters by class, and its common words (function words of the languages) against
all other words. Each language's reference is the sum of the histograms of all its rows that pass the plain rules. A
text's distance to a language is the Jensen-Shannon distance (base 2, 0 to 1) of either histogram; what counts is the
language with the smallest sum. A text is kept if both distances there are within their limits; texts with fewer than
MIN_CHARS characters or MIN_WORDS words say too little about the respective histogram and are not judged by it.

A text without any common word lies at a distance that depends on the reference alone: the larger the share of common
words in the language, the farther. The limit of the word distance is the share WORDS_SHARE of it, by language; a fixed
one would be out of reach where that distance is small. Both limits were chosen on labelled rows, see the README.

Everything is column expressions inside one row, so a long text costs in proportion to its length, and a source or a
group of copies with a third of all rows moves nothing. The sums per language are a few hundred numbers.

Cases: a null text has no words and fails the plain rules; languages that are null or not in COMMON lend nothing to the
references but their rows are judged; without any reference the plain rules decide; equal rows get equal verdicts; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log2, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS, MIN_CHARS = 50, 100
MAX_CLASSES, WORDS_SHARE = 0.30, 0.85
#: Frequent function words of the languages.
COMMON = {
    "en": "the of and to a in is that it was for on are as with be this".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par au".split(),
    "es": "de la que el en y a los se del las un por con no una su".split(),
}
#: Character classes as Java patterns of everything outside them; what is left of the words, a-z mostly, is one more.
CLASSES = {
    "upper": r"[^A-Z]+",
    "letters": r"[^\p{L}&&[^a-zA-Z]]+",
    "digits": r"[^0-9]+",
    "stops": r"[^.,;:'\"!?()\-]+",
    "symbols": r"[^#*$%&|<>]+",
}


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null."""
    text = F.coalesce(text, F.lit(""))
    # blanks and line ends only: cutting at a plain character is several times faster than at a pattern
    plain = F.split(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit(" "))
    cut = F.when(F.rlike(text, F.lit(r"[\x09\x0B-\x0D]")), F.split(text, SPACE)).otherwise(plain)
    return F.filter(cut, lambda w: w != "")


def bound(value: Column, use) -> Column:
    """`use` of a value that is computed once, though `use` may look at it in every step of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def windows(of: Column, size: int) -> Column:
    """Hashes of all runs of `size` elements, in order."""
    n = F.size(of)
    hashed = lambda i: F.xxhash64(*[F.get(of, i + k) for k in range(size)])
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), hashed)).otherwise(
        F.array().cast("array<bigint>")
    )


def covered(hashes: Column, size: int) -> Column:
    """Elements that lie in a window whose hash occurs twice or more."""

    def in_order(w: Column) -> Column:
        # sorted by hash, a repeated one stands beside its like
        placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(placed, lambda p: bound(starts(p), count))

    def starts(p: Column) -> Column:
        """Places of the repeated windows, in order."""
        same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        repeated = F.filter(p, lambda x, k: same(x, k + 1) | ((k > 0) & same(x, F.greatest(k - 1, F.lit(0)))))
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def count(s: Column) -> Column:
        # each window covers what lies between its start and the next one's, `size` at most
        one = lambda i, k: F.least(F.coalesce(F.get(s, k + 1) - i, F.lit(size)), F.lit(size))
        return F.aggregate(F.transform(s, one), F.lit(0), lambda a, x: a + x)

    return bound(hashes, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(in_order(w)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length; 1 if one of them is empty."""

    def of(shares: Column) -> Column:
        total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x["p"] + x["q"])
        term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
        one = lambda a, x: a + (term(x["p"], (x["p"] + x["q"]) / 2) + term(x["q"], (x["p"] + x["q"]) / 2)) / 2
        found = F.aggregate(shares, F.lit(0.0), one)
        return F.when(total < 1.5, F.lit(1.0)).otherwise(F.sqrt(F.greatest(F.least(found, F.lit(1.0)), F.lit(0.0))))

    scaled = lambda h: bound(h, lambda a: bound(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), lambda t: F.transform(a, lambda x: F.when(t > 0, x / t).otherwise(0.0))))
    return bound(F.arrays_zip(scaled(p).alias("p"), scaled(q).alias("q")), of)


def described(docs: DataFrame, keep: Sequence[str] = ("doc_id", "lang")) -> DataFrame:
    """The plain figures and both histograms of every row."""
    common = sorted({w for own in COMMON.values() for w in own})
    named = F.transform(F.lit(common), lambda w: F.xxhash64(w))
    text = F.coalesce(F.col("text"), F.lit(""))
    outside = lambda pattern: F.length(F.regexp_replace(F.col("__text"), pattern, "")).cast("double")
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda s: F.length(F.trim(s, F.lit(BLANKS))) > 0)
    held = F.transform(
        F.filter(F.transform("__words", lambda w: F.lower(w)), lambda w: w.isin(common)), lambda w: F.xxhash64(w)
    )
    first = docs.select(*keep, text.alias("__text")).select(
        *keep,
        "__text",
        words(F.col("__text")).alias("__words"),
        F.array(*[outside(pattern) for pattern in CLASSES.values()]).alias("__classes"),
        bound(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).alias("n_dup_lines"),
    )
    times = lambda c: F.transform(named, lambda w: (F.size(c) - F.size(F.array_remove(c, w))).cast("double"))
    first = first.withColumns({"word_chars": F.length(F.array_join("__words", "")), "__common": bound(held, times)})
    n_words = F.size("__words")
    n_repeat = covered(windows(F.col("__words"), 5), 5)
    known = F.aggregate("__common", F.lit(0.0), lambda a, x: a + x)
    listed = F.aggregate("__classes", F.lit(0.0), lambda a, x: a + x)
    figures = first.select(
        *keep,
        n_words.cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.get("__classes", F.lit(len(CLASSES) - 1)).cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"),
        F.concat("__classes", F.array(F.greatest(F.col("word_chars") - listed, F.lit(0.0)))).alias("classes"),
        F.concat("__common", F.array(F.greatest(n_words - known, F.lit(0.0)))).alias("common"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return figures.withColumn("base_failed", failed)


def references(figures: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Summed histograms by language, over all rows that pass the plain rules and the guards."""
    sums = lambda column, n: F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(n)])
    n_common = len({w for own in COMMON.values() for w in own}) + 1
    good = figures.where(~F.col("base_failed") & F.col("lang").isin(*COMMON) & (F.col("n_words") >= MIN_WORDS))
    rows = good.groupBy("lang").agg(sums("classes", len(CLASSES) + 1).alias("classes"), sums("common", n_common).alias("common"))
    return {r["lang"]: (r["classes"], r["common"]) for r in rows.collect()}  # one row per language of COMMON


def words_limit(reference: Sequence[float], share: float = WORDS_SHARE) -> float:
    """Largest word distance to a language: `share` of that of a text without common words; 1 if the language has none."""
    other = reference[-1] / sum(reference)
    if other == 1.0:
        return 1.0
    middle = (1 + other) / 2
    # a common word's share p is p * log2(2) from the middle, the other words' share is what both have
    found = (1 - other - log2(middle) + (other * log2(other / middle) if other else 0.0)) / 2
    return share * sqrt(found)


def judge(docs: DataFrame, max_classes: float = MAX_CLASSES, words_share: float = WORDS_SHARE, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, the figures, both distances to the nearest language, base_failed and kept for every row."""
    keep = list(dict.fromkeys(["doc_id", "lang", *carry]))
    figures = stored(described(docs, keep), "quality-figures")
    learned = references(figures)
    if not learned:
        near = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("classes"), F.lit(0.0).alias("common"), F.lit(1.0).alias("limit"))
    else:
        by_language = []
        for lang in sorted(learned):
            classes, common = (distance(F.col(c), F.lit(list(h))) for c, h in zip(("classes", "common"), learned[lang], strict=True))
            both, limit = F.array(classes, common), F.lit(words_limit(learned[lang][1], words_share)).alias("limit")
            by_language.append(bound(both, lambda d: F.struct((d[0] + d[1]).alias("sum"), d[0].alias("classes"), d[1].alias("common"), limit)))  # noqa: B023
        near = F.array_min(F.array(*by_language))
    judged = figures.withColumn("__near", near).withColumns(
        {"class_distance": F.col("__near.classes"), "word_distance": F.col("__near.common")}
    )
    far = (F.col("word_chars") >= MIN_CHARS) & (F.col("class_distance") > max_classes)
    far = far | (F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > F.col("__near.limit"))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).select(
        *[c for c in keep if c != "lang" or "lang" in carry],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "class_distance",
        "word_distance",
    )
