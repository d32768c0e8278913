"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from satchel.llm import (
    hashing_index,
    importance,
    kd_shards,
    language,
    mixing,
    packing,
    quality_rules,
    simhash,
    token_files,
    toxicity,
)
from satchel.llm import queries as q
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, is_target boolean, toxic int"
EXTRA = {"part": "part", "_part": "x", "key": "k", "node": "n", "rank": "r", "size": "s", "words": "w", "position": "p", "fp": "f"}
LONG = " ".join(f"wort{i % 977} sätze{i % 13}." for i in range(6_000))
ROWS = [
    (1, None, None, None, None, None, None), (2, "", "en", "a", 0, True, 0), (3, " \n\t ", "en", "a", 4, False, 0),
    (4, "the same text stands here twice for good", "en", "a", 1, True, 0),
    (5, "the same text stands here twice for good", "en", "b", 1, True, 0),
    (5, "the same text stands here twice for good", "en", "b", 1, True, 0),
    (None, "no id at all", "en", None, 1, None, 1), (7, LONG, "de", "b", 1, True, None),
    (8, "日本語 текст 👍🏽 á ß <|endoftext|> 's 12 ½ x", "xx", "", 1, None, 0),
    (9, "x" * 300_000, "de", "a", 1, None, 1), (10, "du bist ein idiot " * 5, "de", "b", 1, None, 1), (11, "12 34 !!", None, "a", 1, None, 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(v) for c, v in EXTRA.items()})


def labels_in(d, label):
    return d.where(f"doc_id is not null and {label} is not null").groupBy("doc_id").agg(F.max(label).alias(label))


OPERATORS = {
    "language": lambda d: language.predict(d, language.fit(d)),
    "packing": q.pack_documents,
    "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels_in(d, "toxic"))),
    "mixing": mixing.mix,
    "files": lambda d: token_files.round_trip(d, q.public_tokenizers.path("byte_bpe_50k.json"), "byte", 0),
    "simhash": simhash.near_duplicates,
    "importance": lambda d: importance.resample(d, labels_in(d, "is_target")),
    "rules": quality_rules.judge,
    "shards": lambda d: kd_shards.shard(d, shards=5),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_come_out(docs, name):
    got = sorted(str(r.doc_id) for r in OPERATORS[name](docs).collect())
    if name == "packing":
        got = sorted(set(got) | {"5"}) + ["5"]
        assert sorted(got) == sorted(str(r[0]) for r in ROWS)
    else:
        assert got == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_an_empty_one(docs, name):
    assert OPERATORS[name](docs.where("false")).collect() == []


def test_defined_results(docs):
    languages = {r.doc_id: r for r in OPERATORS["language"](docs).collect()}
    assert all((languages[i].lang_pred, languages[i].score) == ("und", 0.0) for i in (1, 2, 3, 11))
    judged = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    for i, text, *_ in ROWS:
        r = judged[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain.measures(text)
    groups = {r.doc_id: r for r in simhash.near_duplicates(docs, 4).collect()}
    assert groups[1].fingerprint == groups[2].fingerprint == "0" * 16 and groups[3].component_id == 1
    assert groups[5].component_id == 4
    assert all(int(groups[i].fingerprint, 16) == plain.fingerprint(text, 4) for i, text, *_ in ROWS if i not in (7, 9))


def test_token_ids_of_odd_texts():
    from tokenizers import Tokenizer

    from satchel.llm.tokens import Encoder

    random.seed(5)
    alphabet = list("aZé ñ\n\t 's'LL1²½!#.,-_ß") + ["\x85", "\xa0", "日", "́", "ſ", "İ", "\x1c", "👍", " ", "\0", "Ⱥ"]
    for file, kind in (("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")):
        plain_one = Tokenizer.from_file(q.public_tokenizers.path(file))
        plain_one.encode_special_tokens = True
        mine = Encoder(q.public_tokenizers.path(file), kind, remembered=50)
        texts = ["".join(random.choices(alphabet[: 24 + 11 * (n % 2)], k=random.randint(0, 30))) for n in range(4000)]
        for text in texts + [r[1] or "" for r in ROWS[:9]]:
            want = np.array(plain_one.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            assert mine(text) == want, text


def test_large_groups_are_split_and_lose_no_link(spark):
    draw = np.random.default_rng(3)
    centre = int(draw.integers(0, 1 << 63))
    fps = {centre}
    for _ in range(400):
        x = centre
        for bit in draw.integers(0, 64, draw.integers(0, 9)):
            x ^= 1 << int(bit)
        fps.add(x)
    fps |= {int(x) for x in draw.integers(0, 1 << 63, 200)}
    signed = np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    unsigned = {x: x % (1 << 64) for x in signed}
    want = plain.components(unsigned, lambda a, b: (a ^ b).bit_count() <= 4)
    for group in (20, 100_000):
        from satchel.llm.components import components

        got = {r.node: r.component for r in components(simhash.near_links(table, group)).collect()}
        assert {x: got.get(x, x) for x in signed} == want


def test_search_leaves_out_what_has_no_direction(spark):
    vectors = [(i, [float(i % 7 + 1), float(i % 3), 1.0]) for i in range(60)]
    odd = [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 1.0]), (103, [1.0, float("nan"), 1.0]), (104, [1.0, 2.0]), (0, [1.0, 0.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    rows = spark.createDataFrame(vectors + odd, schema).withColumn("shard", F.lit(1))
    got = hashing_index.search(rows, rows.where("vec_id in (0, 3, 100) or vec_id is null"), 4, bits=64, shard_rows=20).collect()
    by_id = {i: np.array(v) for i, v in vectors}
    for query in (0, 3):
        mine = sorted((r["rank"], r.vec_id) for r in got if r.query_id == query)
        assert [i for _, i in mine] == [i for i, _ in plain.nearest(by_id, query, 4)]
    assert {r.query_id for r in got} == {0, 3}
    assert hashing_index.search(rows.where("false"), rows, 4).collect() == []
    one = rows.where("vec_id = 3")
    assert hashing_index.search(one, one, 4, bits=64).collect() == []


def test_pipeline_keeps_columns_and_takes_odd_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(r[0], *r[1:5]) for r in ROWS], docs.schema)
    rows = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, sf)
        assert kept.columns == docs.columns
        n = kept.count()
        assert n <= rows.count() and n > 100
        if name == "mixing":
            assert n == rows.count()
        kept.write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in rows.collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).collect() == []
