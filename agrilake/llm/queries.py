"""Registered queries of the subpackage: thin callers of its operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrilake.llm import (
    adaptive_join,
    block_rotation,
    byte_gru,
    divergence,
    fm_index,
    hash_tree,
    lattice,
    permuterm,
    phrase_index,
    string_svm,
    swap_packing,
    tag_paths,
    token_coder,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def fold(of: int) -> Column:
    """crc32 of the doc_id as text, modulo `of`; a null doc_id is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of, F.lit(0))


def op1_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_texts(_table(spark, sf_dir, "documents"), fold(10) != 0, _vocabulary("piece_bpe_32k.model"))


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(_table(spark, sf_dir, "documents"))


def op3_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = byte_gru.fit(docs, fold(4) != 2)
    held = docs.select("doc_id", "text", (fold(4) == 2).alias("held_out"))
    return byte_gru.predict(held, net).select("doc_id", "held_out", "lang_pred", "score")


def op4_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return phrase_index.decontaminate(docs, items).drop("key")


def op5_string_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machine = string_svm.fit(docs, _table(spark, sf_dir, "labels"), fold(5) != 0)
    found = string_svm.score(docs, machine)
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Eight shards in two regions with two racks each; the ninth comes in a region of its own, so that no other key moves.
TREE = {
    "region-0": {"rack-0": {0: 1.0, 1: 1.0}, "rack-1": {2: 1.0, 3: 1.0}},
    "region-1": {"rack-2": {4: 1.0, 5: 1.0}, "rack-3": {6: 1.0, 7: 1.0}},
}
GROWN = {**TREE, "region-2": {"rack-4": {8: 1.0}}}


def op6_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hash_tree.shard_documents(_table(spark, sf_dir, "documents"), TREE, GROWN)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return swap_packing.pack_documents(docs, _vocabulary("byte_bpe_50k.json"), remembered=192 << 20, together=6 << 20)


def op8_adaptive_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_join.link(_table(spark, sf_dir, "documents"))


def op9_context_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_coder.round_trip(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op10_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(_table(spark, sf_dir, "pages"))


def op11_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.variants(_table(spark, sf_dir, "documents"))


def op12_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = block_rotation.restored(block_rotation.fill_in_middle(_table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lattice_likelihood,
        op2_divergence,
        op3_byte_gru,
        op4_phrase_index,
        op5_string_svm,
        op6_hash_tree,
        op7_swap_packing,
        op8_adaptive_join,
        op9_context_coder,
        op10_tag_paths,
        op11_permuterm,
        op12_fm_index,
        op13_block_rotation,
    )
}
