"""Target weights reach what the pipeline returns."""

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import plain


def test_packed_sequences_follow_the_weights(spark, monkeypatch):
    word = lambda i: F.substring(F.hex(F.xxhash64(i, "id")), 1, 5)
    draw = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(400)), word))
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), draw.alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
    ).cache()
    share = {}
    for name, heavy in (("a", {"a": 0.8, "b": 0.2}), ("b", {"a": 0.1, "b": 0.9})):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", heavy)
        got = corpus_pipeline.packed(spark, docs, "").collect()
        assert {r.doc_id for r in got} == set(range(3000))
        windows = {}
        for r in got:
            windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert sorted(windows) == list(range(len(windows)))
        for window in windows.values():
            at = 0
            for offset, length in sorted(window):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(windows) <= 1.05 * len(plain.best_fit_decreasing([r.length for r in got], 4096)) + 1
        first = [r for r in got if r.sequence_id < len(windows) // 3]
        share[name] = sum(r.length for r in first if r.doc_id % 2 == 0) / sum(r.length for r in first)
    assert abs(share["a"] - 0.8) < 0.08 and abs(share["b"] - 0.1) < 0.08


def test_run_changes_with_the_weights(spark, monkeypatch):
    # The first stages do not look at weights.
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    got = []
    for heavy in (None, {"src1": 1.0, "src7": 0.01}):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", heavy)
        rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
        got.append(sorted((r.doc_id, r.start, r.sequence_id, r.offset) for r in rows))
    assert [x[:2] for x in got[0]] == [x[:2] for x in got[1]] and got[0] != got[1]
