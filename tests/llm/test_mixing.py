"""The mix against the weights that were given, not against its own bounds."""

from fractions import Fraction

from pyspark.sql import functions as F

from satchel.llm import mixing


def furthest(slots, weights):
    """The largest distance of any prefix of ``slots`` (sources in order) from the weights, in blocks."""
    seen, most = dict.fromkeys(weights, 0), Fraction(0)
    total = sum(weights.values())
    for n, source in enumerate(slots, 1):
        seen[source] += 1
        most = max(most, *(abs(seen[s] - n * w / total) for s, w in weights.items()))
    return most


def test_prefixes_stay_within_a_block_of_the_weights():
    for given in ([0.9, 0.1], [0.989, 0.01, 0.001], [5**0.5, 7**0.5, 1.0, 1e-3], [1, 1, 1, 1, 1, 1, 1]):
        weights = [Fraction(w) for w in given]
        n = 8000
        blocks = [int(n * w / sum(weights)) + 2 for w in weights]
        first = [s for s, _, phase, *_ in mixing.schedule(blocks, weights) if phase == 0]
        assert len(first) > 7000
        assert furthest(first, dict(enumerate(weights))) < 1


def test_no_block_is_lost_when_sources_run_out():
    rows = list(mixing.schedule([3, 50, 1, 400], [Fraction(4), Fraction(1), Fraction(1, 3), Fraction(2)]))
    assert [r[3] for r in rows] == list(range(454))
    assert sorted(r[:2] for r in rows) == [(s, b) for s, n in enumerate([3, 50, 1, 400]) for b in range(n)]
    assert all(release <= slot < deadline for *_, slot, release, deadline in rows)


def test_rows_follow_the_weights(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
    )
    got = mixing.mix(docs, {"a": 0.9, "b": 0.1}, block_bytes=100).where("phase = 0").orderBy("position").collect()
    assert len(got) > 2000
    assert furthest([r.source for r in got], {"a": Fraction(0.9), "b": Fraction(0.1)}) < 1
