"""A corpus in five stages: quality, toxicity, near-duplicates, mixing, packing.

Each stage is handed the rows its predecessor kept and returns rows of ``documents``, the last one the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satchel.llm import importance, minhash, mixing, toxicity
from satchel.llm.queries import learnable, pack_in_mix, table, targets
from satchel.llm.scratch import keep

WEIGHTS: dict[str, float] | None = None  # of sources; by default those of mixing.mix
RUN_SLOTS = 16  # of the mix that are packed together, 1 MB of text
FILE_SLOTS = 1024  # of the mix in one file, 64 MB of text


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws.

    A decision is that of an id, null too, with a text, so rows that share an id are judged each; only a label
    is that of all rows of its id.  A null text is an empty one, which is drawn last.
    """
    rows = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    drawn = importance.resample(rows, targets(table(spark, sf_dir, "labels")), carry=["digest"]).where("kept")
    whole = docs.select(F.struct(*docs.columns).alias("document"))
    digest = F.sha2(F.coalesce("document.text", F.lit("")), 256)
    same = F.col("document.doc_id").eqNullSafe(F.col("doc_id")) & (digest == F.col("digest"))
    return whole.join(drawn.select("doc_id", "digest"), same, "left_semi").select("document.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this stage's own input, does not call toxic."""
    classifier = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels"), "toxic"))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_document"))
    return toxicity.score(rows, classifier, "_document").where("predicted = 0").select("_document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of five-word similarity 0.8 or more the document with the smallest id; of repeated rows one."""
    return minhash.without_near_copies(docs)


def _mix(docs: DataFrame) -> DataFrame:
    """``doc_id``, null too, each once, with its first ``slot`` and ``position``."""
    order = mixing.mix(docs, WEIGHTS).groupBy("doc_id")
    return order.agg(F.min("slot").alias("slot"), F.min("position").alias("position"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix: a reader of the files gets sources at their target weights.

    Slots have no gaps and a block of bytes each, so a row's file follows from its slot.  The join is the same whether
    the places are few or many: sorted by id on both sides.
    """
    order = keep(_mix(docs).select(F.col("doc_id").alias("of"), "slot", "position"), "order")
    files = (order.agg(F.max("slot")).first()[0] or 0) // FILE_SLOTS + 1
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*docs.columns).alias("document"))
    placed = rows.hint("merge").join(order, F.col("id").eqNullSafe(F.col("of")))
    dealt = placed.repartitionById(files, F.expr(f"cast(slot div {FILE_SLOTS} as int)")).sortWithinPartitions("position")
    return dealt.select("document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, run after run of the mix.

    Readers of files do not keep rows in order, so the mix, which is the same for the same rows, is worked out again.
    """
    places = _mix(docs).select("doc_id", F.expr(f"slot div {RUN_SLOTS}").alias("run"), "position")
    return pack_in_mix(docs, places)


STAGES = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]
# Learned models and token ids: SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = keep(stage(spark, rows, sf_dir), name)
    return rows
