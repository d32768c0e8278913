"""Stages of the pipeline decide for rows, not for ids, and carry columns of any name."""

import corpus_pipeline
from satchel.llm import importance

SMALL = "/root/testdata/sf0.001"
NAMES = ["_of", "_position", "_row", "digest", "document", "slot", "draw"]


def test_rows_that_share_an_id_are_judged_each(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = corpus_pipeline.targets(corpus_pipeline.table(spark, SMALL, "labels"))
    # A label is that of an id, so a labelled id would make its junk target text.
    free = importance.resample(docs, labels).join(labels.where("is_target"), "doc_id", "left_anti")
    first = free.orderBy("draw", ascending=False).first()
    good = docs.where(f"doc_id = {first.doc_id}").first()
    junk = "zq zq zq zq zq zq %% %% xx xx xx xx " * 20
    added = [(good.doc_id, junk), (None, good.text), (None, junk)]
    more = docs.unionByName(spark.createDataFrame(added, "doc_id long, text string"), allowMissingColumns=True)
    found = corpus_pipeline.quality(spark, more, SMALL).select("doc_id", "text").collect()
    assert (good.doc_id, good.text) in map(tuple, found)
    assert junk not in {r.text for r in found}


def test_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in NAMES:
        docs = docs.withColumn(name, corpus_pipeline.F.col("doc_id") + 1)
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_duplicates, corpus_pipeline.mixture):
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert out.where("_of <> doc_id + 1 or document <> doc_id + 1").isEmpty()
