"""Benchmark decontamination with a positional inverted index.

The index holds a posting (term, key, pos) for every occurrence of a test term in the training texts, key numbering the
texts. A phrase is found from its rarest term: the term's postings, moved back by the term's offset, are candidate
starts; these are intersected with the moved postings of the second rarest term, and what is left with those of all
others. So only the shortest lists are read for all texts, and long lists only for texts that are likely to match.
Proximity search takes the same index and asks for all terms of a phrase within a given span, in any order.

Terms are 64-bit hashes of words. The index is written once to the shared folder. Its size follows the occurrences of
test terms, a hot term's postings included; they are joined on (key, pos), which no common word can overload.

Cases: null and empty texts have no words, no hits and no items; items without words are found nowhere; an item of
fewer words than a window is one window; repeated items share their windows and are all reported; equal rows have keys
of their own; an empty benchmark or table gives zero hits or an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables of at most so many rows of a few numbers each are sent to every task; larger ones are joined by a shuffle.
SENT = 200_000
END = ""  # a term that no text has: its posting is a text's end


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; `lower` is faster where both agree."""
    capitals = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\x00-\x7F]]"
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.rlike(text, F.lit(capitals)), F.translate(text, upper, small)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def sized(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if it is small enough by count."""
    return F.broadcast(df) if df.count() <= SENT else df


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, key, pos) of the words in `terms`.word, and one (END, key, number of words) with doc_id per text."""
    listed = terms.select("word").distinct().unionByName(docs.sparkSession.createDataFrame([(END,)], "word string"))
    listed = sized(stored(listed, "index-terms"))
    texts = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", F.concat(words(F.col("text")), F.array(F.lit(END))).alias("w"))
    found = texts.select("key", "doc_id", F.posexplode("w").alias("pos", "word")).join(listed, "word")
    return stored(
        found.select(
            F.xxhash64("word").alias("term"), "key", "pos", F.when(F.col("word") == END, F.col("doc_id")).alias("doc_id")
        ),
        "postings",
    )


def _of_terms(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("term") != F.xxhash64(F.lit(END))).select("term", "key", "pos")


def phrase_windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, phrase (a number for equal windows) and terms of every window of `size` words."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = w.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at"), size).alias("w"))
    hashed = F.transform("w", lambda x: F.xxhash64(x))
    return cut.select("item_id", F.xxhash64("w").alias("phrase"), hashed.alias("terms")).distinct()


def phrase_matches(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """phrase, key, start and length of every occurrence of the phrases (phrase, terms)."""
    lists = _of_terms(postings)
    spelled = phrases.select("phrase", "terms").distinct()
    parts = spelled.select("phrase", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
    parts = stored(parts, "phrase-terms")
    counts = lists.join(sized(parts.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.count("*").alias("times"))
    by_rarity = Window.partitionBy("phrase").orderBy(F.coalesce("times", F.lit(0)), "term", "offset")
    ranked = parts.join(counts, "term", "left").withColumn("rank", F.row_number().over(by_rarity))
    ranked = ranked.withColumn("least", F.min(F.coalesce("times", F.lit(0))).over(Window.partitionBy("phrase")))
    ranked = stored(ranked.where(F.col("least") > 0).drop("least", "times"), "ranked-terms")  # all terms occur somewhere

    # the rarest term's postings, moved back by its offset
    first = sized(ranked.where(F.col("rank") == 1).select("phrase", "length", "term", "offset"))
    start = (F.col("pos") - F.col("offset")).alias("start")
    found = lists.join(first, "term").select("phrase", "length", "key", start).where(F.col("start") >= 0)
    found = stored(found, "candidates")

    # those where the second rarest agrees; a phrase of one word has none
    second = ranked.where(F.col("rank") == 2).select("phrase", "term", "offset")
    asked = found.join(sized(second), "phrase").withColumn("pos", F.col("start") + F.col("offset"))
    heads = sized(stored(found.select("key").distinct(), "candidate-keys"))
    near = lists.join(sized(second.select("term").distinct()), "term", "left_semi").join(heads, "key", "left_semi")
    agreed = asked.join(near, ["term", "key", "pos"], "left_semi").select("phrase", "length", "key", "start")
    agreed = stored(agreed.unionByName(found.where(F.col("length") == 1)), "candidates")

    # those where all others agree
    rest = ranked.where(F.col("rank") > 2).select("phrase", "term", "offset")
    asked = agreed.join(sized(rest), "phrase").withColumn("pos", F.col("start") + F.col("offset"))
    heads = sized(stored(agreed.select("key").distinct(), "candidate-keys"))
    near = lists.join(heads, "key", "left_semi").select("key", "pos", "term")
    full = asked.join(near, ["key", "pos", "term"]).groupBy("phrase", "length", "key", "start").agg(F.count("*").alias("n"))
    full = full.where(F.col("n") == F.col("length") - 2).drop("n")
    return full.unionByName(agreed.where(F.col("length") <= 2))


def proximity_matches(postings: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """phrase, key and first such end of texts that hold all terms of a phrase within `span` words, in any order."""
    wanted = phrases.select("phrase", F.array_distinct("terms").alias("terms")).distinct()
    parts = wanted.select("phrase", F.size("terms").alias("kinds"), F.explode("terms").alias("term"))
    found = _of_terms(postings).join(sized(stored(parts, "phrase-terms")), "term")
    whole = found.groupBy("phrase", "key", "kinds").agg(F.count_distinct("term").alias("n")).where(F.col("n") == F.col("kinds"))
    there = found.join(whole.select("phrase", "key"), ["phrase", "key"], "left_semi")
    behind = Window.partitionBy("phrase", "key").orderBy("pos").rangeBetween(-(span - 1), 0)
    seen = there.withColumn("seen", F.size(F.array_distinct(F.collect_list("term").over(behind))))
    return seen.where(F.col("seen") == F.col("kinds")).groupBy("phrase", "key").agg(F.min("pos").alias("end"))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every text, and its row's `key`.

    A hit word lies in an occurrence of a window of `size` words of an item.
    """
    windows = stored(phrase_windows(items, size), "phrase-windows")
    postings = build_index(docs, items.select(F.explode(words(F.col("text"))).alias("word")))
    found = stored(phrase_matches(postings, windows), "phrase-matches")
    # words covered: each occurrence adds what lies beyond the furthest end before it; a text's occurrences are bounded
    # by its words
    runs = found.groupBy("key", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    hits = runs.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("key").agg(F.sum("fresh").alias("n_hit"))
    names = found.select("key", "phrase").distinct().join(windows.select("phrase", "item_id"), "phrase")
    named = names.groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    texts = postings.where(F.col("term") == F.xxhash64(F.lit(END))).select("key", "doc_id", F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return texts.join(hits, "key", "left").join(named, "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "key",
    )
