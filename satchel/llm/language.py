"""Language by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point.  An n-gram is the product of its letters'
vectors, each rotated by its place; a text is the sum of its n-grams, and a language the sum of its texts at length one.
The language of a text is the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satchel.llm.sampling import drawn

DIMENSIONS, GRAM, SEED = 1024, 3, 20
PER_LANGUAGE = 2000
CHUNK = 1 << 19  # characters whose n-grams are counted at a time
COLUMNS = 2048  # distinct n-grams whose vectors are held at a time
SHARPNESS = 20.0  # of the softmax that makes a score from cosines
UNKNOWN = "und"


class Space:
    """Vectors of letters and texts.  ``None`` and texts without a letter have the zero vector."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM, seed: int = SEED):
        self.dimensions, self.gram, self.seed = dimensions, gram, seed
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            draw = np.random.default_rng([self.seed, code])
            self.letters[code] = draw.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def codes(self, text: str) -> np.ndarray:
        """Lower-case letters; whatever lies between two words counts as one blank."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
        seen, where = np.unique(codes, return_inverse=True)
        kind = np.array([chr(c).isalpha() for c in seen.tolist()], dtype=bool)
        codes = np.where(kind[where], codes, 32)
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        return codes[keep].astype(np.uint64)

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams, 21 bits a letter, and how often each occurs."""
        if not text:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        text, carry, found, counts = f" {text} ".lower(), np.empty(0, np.uint64), [], []
        for at in range(0, len(text), CHUNK):
            codes = self.codes(text[at : at + CHUNK])
            if len(carry) and carry[-1] == 32 == codes[0]:
                codes = codes[1:]
            # what an n-gram over the border needs of the chunk before
            codes = np.concatenate([carry, codes])
            carry = codes[max(len(codes) - self.gram + 1, 0) :]
            n = len(codes) - self.gram + 1
            if n < 1:
                continue
            packed = np.zeros(n, dtype=np.uint64)
            for place in range(self.gram):
                packed = packed << np.uint64(21) | codes[place : place + n]
            values, times = np.unique(packed, return_counts=True)
            found.append(values)
            counts.append(times)
        if len(found) > 1:
            values, where = np.unique(np.concatenate(found), return_inverse=True)
            return values, np.bincount(where, np.concatenate(counts)).astype(np.int64)
        return (found[0], counts[0]) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))

    def gram_vectors(self, packed: np.ndarray) -> np.ndarray:
        out = np.ones((len(packed), self.dimensions), dtype=np.int8)
        for place in range(self.gram):
            back = self.gram - 1 - place
            codes = (packed >> np.uint64(21 * back) & np.uint64((1 << 21) - 1)).astype(np.int64)
            seen, where = np.unique(codes, return_inverse=True)
            out *= np.stack([np.roll(self.letter(c), back) for c in seen.tolist()])[where]
        return out

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """``(texts, dimensions)`` sums of n-gram vectors."""
        grams = [self.grams(text) for text in texts]
        seen, where = np.unique(np.concatenate([values for values, _ in grams]), return_inverse=True)
        rows = np.repeat(np.arange(len(texts)), [len(values) for values, _ in grams])
        times = np.concatenate([counts for _, counts in grams]).astype(np.float32)
        out = np.zeros((len(texts), self.dimensions), dtype=np.float32)
        for at in range(0, len(seen), COLUMNS):
            some = seen[at : at + COLUMNS]
            inside = (where >= at) & (where < at + COLUMNS)
            table = np.zeros((len(texts), len(some)), dtype=np.float32)
            table[rows[inside], where[inside] - at] = times[inside]
            out += table @ self.gram_vectors(some).astype(np.float32)
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def in_groups(texts, most: int = 256) -> Iterator[list[str | None]]:
    """Texts of an Arrow column, so many and so long that their counts fit."""
    held, size = [], 0
    for i in range(len(texts)):
        text = texts[i].as_py()
        held.append(text)
        size += len(text or "")
        if len(held) == most or size > CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Profiles:
    space: Space
    languages: list[str]
    prototypes: np.ndarray  # one row of length one for each language

    def scores(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        vectors = self.space.texts(texts)
        empty = ~vectors.any(axis=1) & np.array([not any(map(str.isalpha, t or "")) for t in texts])
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosines = unit(vectors).astype(np.float64) @ self.prototypes.T
        best = cosines.argmax(axis=1)  # ties: the first in the order of names
        odds = np.exp(SHARPNESS * (cosines - cosines.max(axis=1, keepdims=True)))
        score = np.where(empty, 0.0, 1 / odds.sum(axis=1))
        return [UNKNOWN if e else self.languages[b] for e, b in zip(empty, best)], score


def fit(docs: DataFrame, space: Space | None = None, per_language: int = PER_LANGUAGE) -> Profiles:
    """Profiles from ``text`` and ``lang`` of about ``per_language`` documents of each language, chosen by a hash.

    Rows without text or language are left out; with no rows at all every language is unknown.  There is a row on the
    driver for each language, of which there are few.
    """
    space = space or Space()
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    if not counts:
        return Profiles(space, [], np.zeros((0, space.dimensions)))
    shares = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    chosen = known.where(drawn("doc_id") < F.element_at(shares, F.col("lang"))).select("lang", "text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            languages, at = batch.column("lang").to_pylist(), 0
            for texts in in_groups(batch.column("text")):
                for lang, vector in zip(languages[at:], unit(space.texts(texts))):
                    sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
                at += len(texts)
        if sums:
            names = sorted(sums)
            yield pa.RecordBatch.from_pydict({"lang": names, "sums": [sums[x] for x in names]})

    sums = chosen.mapInArrow(run, "lang string, sums array<double>")
    summed = sums.select("lang", F.posexplode("sums").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    table = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))  # one number a dimension
    rows = {row["lang"]: [x["x"] for x in row["v"]] for row in table.collect()}
    languages = sorted(rows)
    return Profiles(space, languages, unit(np.array([rows[x] for x in languages]).reshape(-1, space.dimensions)))


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; only ``text`` is looked at.

    A null text, an empty one and one without a letter are ``und`` with score 0.  Repeated rows come out each.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names, scores = [], []
            for texts in in_groups(batch.column("text")):
                found, score = profiles.scores(texts)
                names += found
                scores.append(score)
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.concatenate(scores or [np.empty(0)]))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
