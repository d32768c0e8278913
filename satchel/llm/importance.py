"""Quality by importance resampling.

Two bag models over hashed n-grams, one of target text and one of raw text, give every document the logarithm of their
ratio.  Gumbel noise with top-k then draws documents without replacement in proportion to that weight.

The n-grams are the three-byte ones of the text, and for each pair of neighbouring words whether they are the same word.
A document weighs as much as ``PER`` of its n-grams, so that its length does not decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satchel.llm.ranks import numbered
from satchel.llm.sampling import drawn, with_labels
from satchel.llm.scratch import keep

BUCKETS = 1 << 14
SMOOTHING = 1.0
PER = 100
NO_WORDS = -1000.0  # the weight of a text without words
CHUNK = 1 << 20
TARGETS = 100_000  # labelled target texts that the model of target text is made of
STEP, STEPS_TO = 0.5, 100.0  # bins of weights for the calibration
NOT_BLANK = re.compile(rb"[^\x09-\x0D\x20]")
ODD = 0x9E3779B97F4A7C15  # fixed value: the usual odd multiplier of multiplicative hashing


def mixed(grams: np.ndarray, buckets: int) -> np.ndarray:
    grams = (grams ^ grams >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (grams >> np.uint64(32)).astype(np.int64) % buckets


class Hasher:
    """Buckets of a text's n-grams, chunk by chunk; words are what white space of ASCII parts, with their case."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = buckets
        self.powers, self.back = (
            np.cumprod(np.array([1] + [base] * CHUNK, dtype=np.uint64)) for base in (ODD, pow(ODD, -1, 1 << 64))
        )
        self.pair = mixed(np.array([1, 2], dtype=np.uint64) << np.uint64(40), buckets)

    def words(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A hash for each word of at most ``CHUNK`` bytes, from differences of one running sum, its start and its end."""
        inside = np.zeros(len(part) + 2, dtype=np.int8)
        inside[1:-1] = (part != 32) & ((part < 9) | (part > 13))
        turns = np.diff(inside)
        starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.powers[: len(part)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.back[starts], starts, ends

    def __call__(self, text: str | None) -> Iterator[np.ndarray]:
        """The last word of a chunk, as far as it goes, and the last two bytes are carried over to the next."""
        data = (text or "").encode("utf-8", "replace")
        if not NOT_BLANK.search(data):
            return
        tail, before, begun, length = np.array([32], dtype=np.uint8), [], 0, 0
        for at in range(0, len(data), CHUNK):
            part = np.frombuffer(data, dtype=np.uint8, count=min(CHUNK, len(data) - at), offset=at)
            last = at + CHUNK >= len(data)
            hashes, starts, ends = self.words(part)
            whole, sizes = hashes.tolist(), (ends - starts).tolist()
            if length and len(starts) and starts[0] == 0:
                whole[0] = (begun + pow(ODD, length, 1 << 64) * whole[0]) % (1 << 64)
                sizes[0] += length
            elif length:
                whole, sizes = [begun, *whole], [length, *sizes]
            begun = length = 0
            if not last and len(ends) and ends[-1] == len(part):
                begun, length = whole.pop(), sizes.pop()
            words = np.array(before + whole, dtype=np.uint64)
            before = words[-1:].tolist()
            wide = np.concatenate([tail, part, [32] if last else []]).astype(np.uint64)
            tail = wide[-2:]
            grams = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
            yield np.concatenate([mixed(grams, self.buckets), self.pair[(words[1:] == words[:-1]).astype(int)]])


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, target``: how often each bucket occurs in all texts and in those with ``is_target``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher, counts = Hasher(buckets), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            texts, target = batch.column("text"), batch.column("is_target").to_pylist()
            for i in range(len(batch)):
                for found in hasher(texts[i].as_py()):
                    some = np.bincount(found, minlength=buckets)
                    counts[0] += some
                    if target[i]:
                        counts[1] += some
        if counts.any():
            yield pa.RecordBatch.from_pydict({"bucket": np.arange(buckets), "raw": counts[0], "target": counts[1]})

    counted = docs.select("text", "is_target").mapInArrow(run, "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


@dataclass
class Ratio:
    log_ratio: np.ndarray  # of each bucket

    def weigh(self, hasher: Hasher, text: str | None) -> tuple[float, int]:
        total, n = 0.0, 0
        for found in hasher(text):
            total, n = total + float(self.log_ratio[found].sum()), n + len(found)
        return (PER * total / n if n else NO_WORDS), n


def fit(docs: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> Ratio:
    """The two models from all rows of ``docs`` (``text``, ``is_target``).

    Counts of every text are summed; one row for each bucket comes to the driver.  Without any target text, or
    any text, no bucket tells anything.
    """
    counts = np.zeros((2, buckets))
    for row in bucket_counts(docs, buckets).collect():
        counts[:, row["bucket"]] = row["raw"], row["target"]
    if not counts.sum(axis=1).all():
        return Ratio(np.zeros(buckets))
    shares = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return Ratio(np.log(shares[1] / shares[0]))


def weigh(docs: DataFrame, ratio: Ratio, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, log_weight, n_grams`` and the columns ``carry``; a text without words weighs ``NO_WORDS``."""
    names = ["doc_id", *carry]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher(len(ratio.log_ratio))
        for batch in batches:
            texts = batch.column("text")
            found = [ratio.weigh(hasher, texts[i].as_py()) for i in range(len(batch))]
            columns = [*map(batch.column, names), pa.array([w for w, _ in found], pa.float64())]
            columns.append(pa.array([n for _, n in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, [*names, "log_weight", "n_grams"])

    kinds = [docs.schema[n] for n in names]
    out = T.StructType([*kinds, T.StructField("log_weight", T.DoubleType()), T.StructField("n_grams", T.LongType())])
    return docs.select(*names, "text").mapInArrow(run, out)


def expected_target(weighed: DataFrame) -> int:
    """How many rows are target text: the sum of the probability that a row's weight speaks for.

    The probability is a logistic curve over the weight, fitted on the rows where ``is_target`` is told, binned by weight so
    that only the bins come to the driver.  Without rows of both kinds the odds are the weight's own.
    """
    limited = F.greatest(F.lit(-STEPS_TO), F.least(F.lit(STEPS_TO), F.col("log_weight")))
    bins = weighed.groupBy(F.round(limited / STEP).cast("int").alias("bin"), "is_target").count().collect()
    x = np.array([row["bin"] * STEP for row in bins])
    n = np.array([row["count"] for row in bins], dtype=float)
    told = np.array([row["is_target"] is not None for row in bins], dtype=bool)
    y = np.array([bool(row["is_target"]) for row in bins], dtype=float)
    slope, middle = 1.0, 0.0
    if 0 < (n * y)[told].sum() < n[told].sum():
        scaled, w = np.clip(x, -20, 20), np.zeros(2)
        for _ in range(100):  # Newton steps; the penalty keeps the slope finite where the kinds are apart
            p = 1 / (1 + np.exp(-np.clip(w[0] * scaled + w[1], -30, 30)))
            off, curve = (n * (p - y))[told], (n * p * (1 - p))[told] + 1e-9
            design = np.stack([scaled[told], np.ones(told.sum())])
            w -= np.linalg.solve((design * curve) @ design.T + np.diag([1.0, 0.01]), design @ off + w * [1.0, 0.01])
        slope, middle = w
    return round(float((n / (1 + np.exp(-np.clip(slope * np.clip(x, -20, 20) + middle, -50, 50)))).sum())) if len(n) else 0


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep_rows: int | None = None,
    seed: int = 5,
    ratio: Ratio | None = None,
    targets: int = TARGETS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, log_weight, n_grams, draw, kept`` for each row of ``docs`` (``doc_id, text``) and its columns ``carry``.

    ``labels`` (``doc_id, is_target``, one row for each id) says whose text is target text.  Unless ``ratio`` is given the
    model of raw text is made of all rows and that of target text of about ``targets`` labelled ones.  ``draw`` is the weight plus Gumbel noise from a hash of ``doc_id`` and ``seed``; the
    ``keep_rows`` largest are kept, by default as many as ``expected_target`` finds.

    Ties in ``draw`` go to the smaller ``doc_id``; repeated rows are drawn each.  A text without words (null, empty,
    only white space) has the weight ``NO_WORDS`` and comes last.  Without any target row all other weights are 0.  An
    empty table gives an empty one; other columns are left out.
    """
    labels = labels.select("doc_id", "is_target")
    ratio = ratio or fit(with_labels(docs.select("doc_id", "text"), labels.where("is_target"), targets, "left"))
    weighed = keep(
        weigh(docs, ratio, carry).withColumn("draw", F.col("log_weight") - F.log(-F.log(drawn("doc_id", seed=seed)))), "weighed"
    )
    if keep_rows is None:
        keep_rows = expected_target(weighed.join(labels, "doc_id", "left"))
    ranked = numbered(weighed.withColumn("_low", -F.col("draw")), ["_low", "doc_id"], "_rank")
    kept = (F.col("_rank") < keep_rows).alias("kept")
    return ranked.select("doc_id", *carry, "log_weight", "n_grams", "draw", kept)
