"""SQL of the operators that SQL expresses, for DuckDB."""

from __future__ import annotations

UPPER = "".join(map(chr, range(65, 91)))
SOURCE_LEVELS, TOP_LEVELS = 6, 4  # 16 to that power: leaves in a source, and sources

HARD = """
WITH numbers AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id,
        CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM numbers a JOIN numbers b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
    AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
"""

COPIES = f"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
grouped AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM lowered GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM lowered JOIN grouped USING (t)
"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


# Each character's code is taken in, then eight steps of one bit, from the fixed polynomial of this checksum.
CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END))"""


def _level(name: str, at: int) -> str:
    """One step up: what stands beside each node, and the nodes above; a tree of one node stays as it is."""
    run = "PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN"
    return f""", {name}_beside{at} AS (
    SELECT tree, i, count(*) OVER (PARTITION BY tree) AS n, digest,
        coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name}{at}
), {name}{at + 1} AS (
    SELECT tree, i // 16 AS i, CASE WHEN max(n) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest
    FROM {name}_beside{at} GROUP BY tree, i // 16
)"""


def _fold(name: str, at: int, tree: str, rank: str, before: str) -> str:
    """``found`` and ``siblings`` taken over one level."""
    return f""", {name}_folded{at} AS (
    SELECT p.* EXCLUDE (found, siblings),
        CASE WHEN b.n = 1 THEN p.found ELSE sha256(b.before || p.found || b.after) END AS found,
        CASE WHEN b.n = 1 THEN p.siblings ELSE p.siblings || b.before || b.after END AS siblings
    FROM {before} p JOIN {name}_beside{at} b ON b.tree = {tree} AND b.i = p.{rank} // {16**at}
)"""


def _manifest() -> str:
    sql = f"""
WITH leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
        CASE WHEN {CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS touched
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), source0 AS (SELECT tree, i, leaf AS digest FROM ranked)"""
    for at in range(SOURCE_LEVELS):
        sql += _level("source", at)
    sql += f""", subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM source{SOURCE_LEVELS})
, top0 AS (SELECT 0 AS tree, place AS i, digest FROM subroots)"""
    for at in range(TOP_LEVELS):
        sql += _level("top", at)
    sql += """, start AS (
    SELECT r.doc_id, r.leaf, r.tree, r.i, s.digest AS subroot, s.place, coalesce(r.touched, r.leaf) AS found, '' AS siblings
    FROM ranked r JOIN subroots s USING (tree)
)"""
    last = "start"
    for name, levels, tree, rank in (("source", SOURCE_LEVELS, "p.tree", "i"), ("top", TOP_LEVELS, "0", "place")):
        for at in range(levels):
            sql += _fold(name, at, tree, rank, last)
            last = f"{name}_folded{at}"
    return sql + f"""
SELECT f.doc_id, f.leaf, f.subroot, t.digest AS root, sha256(f.siblings) AS proof_sha256, f.found AS folded_root,
    f.found = t.digest AS verified
FROM {last} f, top{TOP_LEVELS} t
"""


MANIFEST = _manifest()
