"""The pipeline's near-duplicate stage proposes by Golay keys of fingerprints, as op7 does, and by MinHash keys."""

import random

import numpy as np

from satchel.llm import minhash, simhash
from satchel.llm.components import components


def texts():
    draw = random.Random(12)
    words = [f"w{draw.randrange(5000)}" for _ in range(600)]
    return " ".join(words), " ".join([*words[:300], "other", *words[301:]]), " ".join(draw.sample(words, 600))


def test_majority_is_the_fingerprint_of_distinct_shingles():
    for text in texts():
        assert simhash.majority(minhash.shingles(text)) == simhash.fingerprint(text, minhash.SHINGLE)
    assert simhash.majority(np.array([7, 3], dtype=np.uint64)) == 3


def test_golay_keys_connect_nodes(spark):
    draw = random.Random(3)
    prints = [draw.getrandbits(64) for _ in range(200)]
    fps = prints + [x ^ sum(1 << i for i in draw.sample(range(64), 4)) for x in prints[:50]] + prints[50:60]
    rows = [(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(fps)] + [(1000, None)]
    near = minhash._near(spark.createDataFrame(rows, "node long, fp long"))
    groups = {r.node: r.component for r in components(near).collect()}
    assert groups == {200 + i: i for i in range(60)}


def test_golay_keys_alone_link_in_a_task(monkeypatch):
    """Without any MinHash key in common."""
    sets = [minhash.shingles(x) for x in texts()]
    assert (simhash.majority(sets[0]) ^ simhash.majority(sets[1])).bit_count() <= 4
    alone = iter(range(10**6, 10**6 + len(sets)))
    monkeypatch.setattr(minhash, "keys", lambda hashes: np.array([-next(alone)]))
    assert minhash.links_of(sets) == [(0, 1)]


def test_golay_links_between_groups_meet_again(spark):
    """Nodes of one large set without a MinHash key in common that chunks have left apart."""
    nodes = spark.createDataFrame([(i, [i + 100], i) for i in range(4)], "node long, keys array<long>, fp long")
    members = spark.createDataFrame([(i, 0) for i in range(4)], "node long, proposal long")
    links, near = (spark.createDataFrame(x, "a long, b long") for x in ([(0, 1)], [(1, 0), (3, 1)]))
    found = minhash._apart(members, nodes, links, near.toDF("node", "other")).collect()
    assert sorted(r.node for r in found) == [1, 3] and len({r.proposal for r in found}) == 1
