"""Recall of the neighbour search where vectors share a direction."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from satchel.llm import hashing_index
from tests.llm import plain


@pytest.mark.parametrize("shift", [0, 1, 2, 5])
def test_recall_on_shifted_vectors(spark, shift):
    table = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    matrix = np.array([v for _, v in table], dtype=np.float64)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    one = np.random.default_rng(2).standard_normal(matrix.shape[1])
    matrix += shift * one / np.linalg.norm(one)
    vectors = {i: v for (i, _), v in zip(table, matrix, strict=True)}
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, vector array<double>")
    hit = total = 0
    found = hashing_index.search(rows, rows.where(F.col("vec_id") % 10 == 0), 5).groupBy("query_id").agg(F.collect_set("vec_id"))
    for query, got in found.collect():
        best = {i for i, _ in plain.nearest(vectors, query, 5)}
        hit, total = hit + len(best & set(got)), total + len(best)
    print("recall", shift, hit / total)
    assert total >= 900 and hit / total >= 0.95
