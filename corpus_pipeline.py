"""From raw documents to packed training sequences: language, quality, near duplicates, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; its result is written as
Parquet in the shared folder and read again. All but the last return the columns of `docs`.

Cases: null and empty texts have no language and go at the first stage; rows without a doc_id are judged like others;
equal rows have equal verdicts, but of near duplicates, equal rows among them, one stays; an empty table passes through and
is packed into nothing; columns of any other name or type are carried unchanged, `score`, `lang_pred` and `row` among them.
Rows are known by a 64-bit hash of (doc_id, text): of 10^10 rows about three pairs share one, and share their verdict.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrilake.llm import adaptive_join, byte_gru, divergence, phrase_index, swap_packing
from agrilake.llm.queries import fold
from agrilake.llm.scratch import stored

#: A text stays if the network gives its language at least this share of all bytes' probability.
SURE = 0.5
#: Rejected rows' hashes are sent to every task up to this number; beyond it they are joined by a shuffle.
SENT = 200_000
#: Rows of whole texts that go to a Python worker at a time, at most: Spark's 10,000 are copied in the JVM and the worker, some
#: 50 MB each time, by every task that runs.
ROWS = 1000
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with the session set to batches of at most ROWS rows; the setting stays, as results are read later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get(ROWS_SETTING))
        if not 0 < rows <= ROWS:
            spark.conf.set(ROWS_SETTING, ROWS)
        return stage(spark, docs, sf_dir)

    return run


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """`docs` without the rows whose hash is in `rejected`.row; equal rows have equal verdicts."""
    rejected = stored(rejected.select("row").distinct(), "rejected-rows")
    hashes = F.broadcast(rejected) if rejected.count() <= SENT else rejected
    # the documents' columns travel in one, so that none of their names can clash
    own = docs.select(_row().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    return own.join(hashes, "row", "left_anti").select("document.*")


def _row():
    return F.xxhash64("doc_id", "text")


@in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in one of the languages that the rows name."""
    net = byte_gru.fit(docs, fold(4) != 2)
    # by position, as the documents may have columns of the prediction's names
    own = docs.toDF(*[c if c == "text" else f"column{i}" for i, c in enumerate(docs.columns)])
    known = byte_gru.predict(own, net).where((F.col("lang_pred") != byte_gru.UNKNOWN) & (F.col("score") >= SURE))
    return known.drop("lang_pred", "score").toDF(*docs.columns)


@in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = divergence.judge(docs.select("doc_id", "text", "lang", _row().alias("row")), carry=["row"])
    return _without(docs, judged.where(~F.col("kept")))


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: of those with the group's smallest doc_id, nulls last, the one of the smallest hash."""
    linked = adaptive_join.link(docs.select(_row().alias("doc_id"), "text"))
    linked = stored(linked.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group")), "linked-rows")
    others = linked.where(F.col("row") != F.col("group")).distinct()
    members = stored(others.union(others.select(F.col("group").alias("row"), "group").distinct()), "duplicate-rows")
    sent = F.broadcast(members) if members.count() <= SENT else members
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    first = docs.select(_row().alias("row"), "doc_id").join(sent, "row").groupBy("group").agg(F.min(order).alias("first"))
    kept = _without(docs, members.join(first.select("first.row"), "row", "left_anti"))
    repeated = linked.groupBy("row").count().where(F.col("count") > 1)
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = phrase_index.decontaminate(docs.select(_row().alias("doc_id"), "text"), items)
    return _without(docs, found.where("contaminated").select(F.col("doc_id").alias("row")))


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return swap_packing.pack_documents(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained network and a tokenizer stand in the way of SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
