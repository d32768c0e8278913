"""Bounded, repeatable samples for fitting, and draws that are the same whatever the partitions are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 52


def crc_mod(doc_id: str, mod: int) -> Column:
    """``crc32`` of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % mod


def drawn(*keys: str, seed: int = 11) -> Column:
    """A number in (0, 1) from a hash of ``keys``."""
    return (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(STEPS)) + 0.5) / float(STEPS)


def about(rows: DataFrame, most: int, *keys: str, seed: int = 11) -> DataFrame:
    """About ``most`` rows chosen by a hash of ``keys``, all of them if there are fewer."""
    n = rows.count()
    return rows if n <= most else rows.where(drawn(*keys, seed=seed) < most / n)


def with_labels(docs: DataFrame, labels: DataFrame, most: int, how: str = "inner") -> DataFrame:
    """``docs`` beside about ``most`` rows of ``labels`` (one for each ``doc_id``).

    The chosen labels are few whatever there is, so they go to the texts and no text is shuffled.
    """
    return docs.join(F.broadcast(about(labels, most, "doc_id")), "doc_id", how)
