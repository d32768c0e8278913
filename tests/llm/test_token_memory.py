"""What a Python worker of the token files holds: batches bounded by bytes, one segment at a time, words up to a bound."""

import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from satchel.llm import queries as q
from satchel.llm import token_files, tokens
from satchel.session import BATCH_BYTES


def sizes(session):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    rows = session.range(0, 3000, 1, 1).selectExpr("repeat(cast(id % 10 as string), 10000) AS text")
    return [tuple(r) for r in rows.mapInArrow(run, "n long, bytes long").collect()]


@pytest.mark.parametrize("use", ["write", "read"])
def test_batches_of_token_files_are_bounded_by_bytes(spark, tmp_path, use):
    session = spark.newSession()
    session.conf.unset(BATCH_BYTES)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    path = str(tmp_path / "tokens")
    docs = session.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    token_files.write_tokens(docs, path, q.public_tokenizers.path("byte_bpe_50k.json"), "byte", 0)
    if use == "read":
        session.conf.unset(BATCH_BYTES)
        assert token_files.read_tokens(session, path).count() == 2
    found = sizes(session)
    assert sum(n for n, _ in found) == 3000 and max(b for _, b in found) < 5 * 2**20


def test_segments_of_a_batch_are_read_one_by_one():
    ids = np.random.default_rng(4).integers(0, 50_000, 1 << 16).astype("<u4")
    blob, n = token_files.encode(ids), 64
    types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    columns = [[0] * n, list(range(n)), [[x] for x in range(n)], [[len(ids)]] * n, [blob] * n]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "segment", "doc_ids", "lengths", "blob"]
    )
    tracemalloc.start()
    try:
        found = [x["doc_id"][0].as_py() for x in token_files._documents(iter([batch]), token_files.BLOCK, False)]
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == list(range(n)) and held < n * len(blob) / 4


def test_remembered_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(tokens.Encoder, "_bare", lambda self, words: [b"ids of " + w.encode() for w in words])
    mine = tokens.Encoder(q.public_tokenizers.path("byte_bpe_50k.json"), "byte")
    most = 0
    for at in range(0, 1_500_000, 10_000):
        mine(" ".join(f"{'abcdefghij'[x % 10]}{np.base_repr(x, 2).translate({48: 'q', 49: 'z'})}" for x in range(at, at + 10_000)))
        known = mine.known
        if at % 50_000 == 0:
            most = max(most, sys.getsizeof(known) + sum(sys.getsizeof(a) + sys.getsizeof(b) for a, b in known.items()))
    assert 0 < most < 120 * 10**6


@pytest.mark.parametrize("width", range(1, 33))
def test_packed_bits_are_those_of_each_value(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 77).astype(np.uint32)
    number = sum(int(x) << width * i for i, x in enumerate(ids))
    packed = token_files.bits(ids, width)
    assert packed == number.to_bytes(token_files.packed_size(77, width), "little")
    after = np.frombuffer(b"x" + packed + b"rest", dtype=np.uint8)[1:]  # as in a blob: at an odd place, more behind it
    assert np.array_equal(token_files.values(after, 77, width), ids)
