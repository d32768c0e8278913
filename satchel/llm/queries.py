"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satchel.llm import (
    extendible,
    hard_negatives,
    hashing_index,
    importance,
    kd_shards,
    language,
    merkle,
    mixing,
    oracle,
    packing,
    quality_rules,
    simhash,
    token_files,
    toxicity,
)
from satchel.llm.sampling import crc_mod

WORD_END, BYTE_END = 2, 0  # end ids that the queries append
PACKED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(mod: int, rest: int) -> Column:
    return F.coalesce(crc_mod("doc_id", mod) == rest, F.lit(False))


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label``: one row for each id, of the labels that may be learned only."""
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(5, 0))
    return rows.groupBy("doc_id").agg(F.max(label).alias(label))


def targets(labels: DataFrame) -> DataFrame:
    """``doc_id, is_target``: whose text is good text."""
    return learnable(labels, "quality").select("doc_id", (F.col("quality") == 1).alias("is_target"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return hashing_index.search(rows, rows.where("vec_id % 50 = 0"), 5)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.fit(docs.where(~held_out(4, 2)))
    found = language.predict(docs, profiles)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs)


def cut_documents(docs: DataFrame) -> DataFrame:
    return packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), "word", WORD_END).drop("ids")


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(cut_documents(docs)).select(PACKED)


def pack_in_mix(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``places``: ``doc_id``, each once, with its ``run`` and ``position``."""
    cut, places = cut_documents(docs), places.withColumnRenamed("doc_id", "_of")
    placed = cut.join(places, F.col("doc_id").eqNullSafe(F.col("_of"))).drop("_of")
    return packing.pack_mixed(placed).select(PACKED)


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = learnable(table(spark, sf_dir, "labels"), "toxic")
    found = toxicity.score(docs, toxicity.fit(docs.where(~held_out(5, 0)), labels))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def token_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), "byte", BYTE_END)


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), targets(table(spark, sf_dir, "labels")))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label, F.col("embedding").alias("vector"))
    return hard_negatives.mine(rows, "vec_id % 100 = 0")


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible.duplicates(table(spark, sf_dir, "documents"))


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def proven(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = {c: F.col(c) for c in LEAF} | {"text": extendible.lowered(F.col("text"))}
    touched = F.when(crc_mod("doc_id", 5) == 0, merkle.digest(*(merkle.field(c) for c in lowered.values())))
    return merkle.prove(docs, LEAF, "doc_id", "source", touched)


QUERIES = {
    "op1_multi_index_hashing": neighbours,
    "op2_hyperdimensional_language": languages,
    "op3_best_fit_packing": packed,
    "op4_weak_toxicity": toxic,
    "op5_pfair_mixing": mixed,
    "op6_patched_token_files": token_round_trip,
    "op7_golay_near_duplicates": copies,
    "op8_importance_resampling": resampled,
    "op9_weak_quality_rules": ruled,
    "op10_kd_tree_shards": sharded,
    "op11_threshold_hard_negatives": hard,
    "op12_extendible_exact_copies": exact_copies,
    "op13_merkle_manifest": proven,
}
# The others are learned models, searches over binary codes, schedules and token ids, which SQL does not express.
ORACLE = {
    "op11_threshold_hard_negatives": oracle.HARD,
    "op12_extendible_exact_copies": oracle.COPIES,
    "op13_merkle_manifest": oracle.MANIFEST,
}
