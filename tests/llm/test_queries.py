"""The registered queries on whole tables, against plain Python."""

import zlib
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from satchel.llm import queries
from tests.llm import plain

SF = "/root/testdata/sf0.01"


def rows(table):
    return duckdb.sql(f"SELECT * FROM '{SF}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs():
    return {row[0]: row for row in rows("documents")}


def run(spark, name):
    (full,) = [n for n in queries.QUERIES if n.startswith(name + "_")]
    return queries.QUERIES[full](spark, SF).collect()


@cache
def tokenizer_of(file):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(file, end, text):
    tokenizer = tokenizer_of(file)
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def test_neighbours_reach_the_recall(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    vectors = {i: np.array(v, dtype=np.float64) for i, v in table}
    got = {}
    for r in run(spark, "op1"):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in vectors if i % 50 == 0}
    hit = total = 0
    for query, found in got.items():
        found.sort()
        best = plain.nearest(vectors, query, 5)
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        for _, i, score in found:
            assert abs(score - plain.cosine(vectors[query], vectors[i])) < 1e-12
        hit += len({i for _, i, _ in found} & {i for i, _ in best})
        total += len(best)
    assert hit / total >= 0.95


def test_languages_of_held_out_texts(spark, docs):
    got = run(spark, "op2")
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id][2] for r in held) / len(held) > 0.98


def test_packing_keeps_every_id_once(spark, docs):
    got = run(spark, "op3")
    by_doc, by_window = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == docs.keys()
    for doc_id, pieces in by_doc.items():
        ids = ids_of("word_bpe_49k.json", 2, docs[doc_id][1])
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in pieces)
    assert sorted(by_window) == list(range(len(by_window)))
    for window in by_window.values():
        at = 0
        for offset, length in sorted(window):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(by_window) <= -(-total // 4096) * 1.02 + 1
    rest = [r.length for r in got if r.length < 4096]
    assert len(by_window) - sum(r.length == 4096 for r in got) == len(plain.best_fit_decreasing(rest, 4096))


def test_toxicity_of_held_out_texts(spark, docs):
    toxic = {i: t for i, _, t in rows("labels")}
    got = run(spark, "op4")
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) / len(held) > 0.95


def test_mix_never_is_a_block_off(spark, docs):
    got = sorted(run(spark, "op5"), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(docs)))
    assert Counter(r.doc_id for r in got) == Counter(list(docs))
    assert [r.slot for r in got] == sorted(r.slot for r in got)
    assert all(r.release <= r.slot < r.deadline for r in got)
    blocks = {(r.source, r.block): r.slot for r in got}
    assert len(set(blocks.values())) == len(blocks)


def test_files_come_back(spark, docs):
    got = sorted(run(spark, "op6"), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == sorted(docs)
    start = 0
    for r in got:
        ids = ids_of("byte_bpe_50k.json", 0, docs[r.doc_id][1])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_copies_are_linked(spark, docs):
    prints = {i: plain.fingerprint(row[1], 4) for i, row in docs.items()}
    component = plain.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    got = run(spark, "op7")
    assert len(got) == len(docs)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{prints[i]:016x}", component[i]) for i in docs
    }


def test_resampling_parts_good_from_bad(spark, docs):
    quality = {i: q for i, q, _ in rows("labels")}
    got = run(spark, "op8")
    assert Counter(r.doc_id for r in got) == Counter(list(docs))
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in quality]
    good = [r.kept for r in held if quality[r.doc_id] == 1]
    bad = [r.kept for r in held if quality[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


def test_rules_count_right(spark, docs):
    quality = {i: q for i, q, _ in rows("labels")}
    got = run(spark, "op9")
    assert Counter(r.doc_id for r in got) == Counter(list(docs))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in got:
        counts = plain.measures(docs[r.doc_id][1])
        assert tuple(r[n] for n in names) == counts
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert r.base_failed == failed and not (failed and r.kept)
    good = [r.kept for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in got if quality.get(r.doc_id) == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.2


def test_shards_are_even(spark, docs):
    got = run(spark, "op10")
    assert Counter(r.doc_id for r in got) == Counter(list(docs))
    size, slots = Counter(), {}
    for r in got:
        text = (docs[r.doc_id][1] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "bytes", None)
        size[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(size) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) < 1.25 * min(size.values())
