"""Toxicity by weak supervision.

Many voters, lexicons and patterns, each say yes, no or nothing of a text.  A generative model (``label_model``) estimates
from the votes alone how far to trust each and which repeat one another, and its posteriors train a linear classifier on
the words and patterns of the text, which then scores every document.

Lexicons are general word lists and the words that labelled rows show to stand in toxic texts only.  People's labels are
one more voter of the model, where there are any; a score never looks at them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from satchel.llm import label_model
from satchel.llm.label_model import ABSTAIN, NO, YES
from satchel.llm.sampling import about, with_labels
from satchel.llm.scratch import keep

# Common English, German, French and Spanish insults.
INSULTS = """idiot idiots stupid moron morons dumb loser losers scum trash pathetic worthless disgusting clown clowns
imbecile jerk fool bastard bitch asshole crap damn shit fuck fucking dumm dummkopf trottel arschloch schwachkopf
connard crétin imbécile débile salaud estúpido imbécil gilipollas pendejo cabrón""".split()
SECOND_PERSON = "you your du dein ihr tu ton vous votre tú usted vosotros".split()
WORD = re.compile(r"[^\W_]+")
UPPER = re.compile(r"\b[A-ZÀ-Þ]{2,}\b")
SHOUT, SPLIT_UP = re.compile(r"[!?]{2,}"), re.compile(r"\b(?:\w[.*_-]){2,}\w\b")
STEM = 5  # letters; a longer word also counts as its beginning, written with a star
LEXICON = 400  # words and beginnings learned from labels
CAUTION = 1.64  # standard errors
STRONG = 2.5  # log-odds
SUPPORT = 5  # texts that a learned word must stand in
SAMPLE = 20_000  # rows the two models are fitted on
PATTERNS = 9  # measures of a text besides its words
LABELLED = 40_000  # labelled rows that words are learned from
STEPS = 300


def learned_words(labelled: DataFrame, most: int = LEXICON, support: int = SUPPORT) -> dict[str, float]:
    """The ``most`` words and beginnings of words that speak most for a toxic text, each with its log-odds.

    The log-odds are a lower bound, so that few texts prove little.  Copies and near copies of one text count once, else
    their words would seem to tell something: texts are one if three minima over hashes of their words agree.
    """
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 1))
    least = [F.array_min(F.transform("words", lambda w, s=s: F.xxhash64(F.lit(s), w))).alias(f"h{s}") for s in range(3)]
    texts = labelled.select("toxic", words.alias("words")).select("toxic", "words", *least)
    texts = texts.groupBy("h0", "h1", "h2").agg(F.max("toxic").alias("toxic"), F.max("words").alias("words"))
    sizes = {row["toxic"]: row["count"] for row in texts.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}
    long = F.filter("words", lambda w: F.length(w) > STEM)
    stems = F.array_distinct(F.transform(long, lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*"))))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    found = (
        texts.select("toxic", F.explode(F.concat("words", stems)).alias("word"))
        .groupBy("word")
        .agg(F.sum(F.col("toxic").cast("long")).alias("a"), F.sum(1 - F.col("toxic").cast("long")).alias("b"))
        .where(F.col("a") >= support)
        .withColumn("odds", F.log((a / (sizes[1] + 1.0)) / (b / (sizes[0] + 1.0))) - CAUTION * F.sqrt(1 / a + 1 / b))
    )
    rows = found.where("odds > 1").orderBy(F.desc("odds"), F.desc("a"), "word").limit(most).collect()
    return {row["word"]: row["odds"] for row in rows}


@dataclass
class Features:
    """What the voters and the classifier see of a text."""

    odds: dict[str, float]
    vocabulary: dict[str, int] = field(init=False)

    def __post_init__(self):
        words = dict.fromkeys([*INSULTS, *self.odds])
        self.vocabulary = {word: at for at, word in enumerate(words)}
        self.insults, self.second = frozenset(INSULTS), frozenset(SECOND_PERSON)
        self.strong = frozenset(w for w, x in self.odds.items() if x >= STRONG)
        self.mild = frozenset(self.odds) - self.strong

    def __call__(self, text: str | None) -> tuple[list[int], list[float]]:
        """Places of the words in the vocabulary, and the pattern measures."""
        words = WORD.findall((text or "").lower())
        kinds = set(words)
        kinds.update([w[:STEM] + "*" for w in kinds if len(w) > STEM])
        known = kinds & self.vocabulary.keys() if len(kinds) < len(self.vocabulary) else self.vocabulary.keys() & kinds
        n = max(len(words), 1)
        patterns = [
            len(known & self.insults), len(known & self.strong), len(known & self.mild),
            float(sum(1 for w in words if w in self.insults)) / n if known & self.insults else 0.0,
            len(kinds & self.second) > 0 and bool(known & self.insults), len(SHOUT.findall(text or "")) / n,
            len(UPPER.findall(text or "")) / n,
            bool(SPLIT_UP.search(text or "")), len(words) == 0,
        ]
        return sorted(self.vocabulary[w] for w in known), [float(x) for x in patterns]

    def votes(self, patterns: np.ndarray) -> np.ndarray:
        """One column for each voter: 0 no, 1 abstain, 2 yes."""
        insults, strong, mild, rate, second, shout, upper, split_up, empty = patterns.T

        def voter(yes, no):
            return np.where(yes, YES, np.where(no, NO, ABSTAIN))

        quiet = (insults == 0) & (strong == 0)
        return np.stack([
            voter(insults >= 1, insults == 0), voter(insults >= 2, False), voter(strong >= 1, strong == 0),
            voter(strong >= 2, False), voter(mild >= 3, False), voter(False, quiet & (mild == 0)),
            voter(rate > 0.005, False), voter(second > 0, False), voter((shout > 0.05) & ~quiet, False),
            voter((upper > 0.5) & ~quiet, False), voter((split_up > 0) & ~quiet, False), voter(False, empty > 0),
        ], axis=1)


@dataclass
class Classifier:
    features: Features
    scale: np.ndarray
    weights: np.ndarray  # vocabulary, then patterns
    bias: float
    voters: label_model.LabelModel | None = None

    def score(self, text: str | None) -> float:
        words, patterns = self.features(text)
        v = len(self.features.vocabulary)
        z = self.bias + self.weights[words].sum() + float(np.minimum(np.array(patterns) / self.scale, 3) @ self.weights[v:])
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _observed(docs: DataFrame, features: Features) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            seen = [features(texts[i].as_py()) for i in range(len(batch))]
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"), "words": pa.array([w for w, _ in seen], pa.list_(pa.int32())),
                "patterns": pa.array([p for _, p in seen], pa.list_(pa.float64())),
            })

    schema = "toxic int, words array<int>, patterns array<double>"
    return docs.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """A classifier from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``, one row for each id).

    Words are learned from about ``LABELLED`` labelled rows and the models are fitted on about ``sample`` rows, labelled or
    not, both chosen by a hash of ``doc_id``.  Without labelled rows of both kinds only the general lists vote.  With no rows at all
    every text scores by those lists alone.
    """
    docs = docs.select("doc_id", "text")
    labels = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    labelled = keep(with_labels(docs.where("text IS NOT NULL"), labels, LABELLED), "labelled")
    features = Features(learned_words(labelled))
    v = len(features.vocabulary)
    seen = keep(about(docs, sample, "doc_id"), "seen")
    rows = _observed(seen.join(labels, "doc_id", "left"), features).collect()
    patterns = np.array([row["patterns"] for row in rows]).reshape(len(rows), PATTERNS)
    if not len(rows):
        weights = np.zeros(v + PATTERNS)
        weights[: len(INSULTS)] = 6.0
        return Classifier(features, np.ones(PATTERNS), weights, -3.0)
    votes = features.votes(patterns)
    told = np.array([{0: NO, 1: YES}.get(row["toxic"], ABSTAIN) for row in rows])
    share = labelled.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = None if share is None else float(np.clip(share, 0.01, 0.99))
    voters = label_model.fit(np.column_stack([votes, told]), prior=prior)
    target = voters.posterior(np.column_stack([votes, told])).astype(np.float32)
    scale = np.maximum(np.quantile(patterns, 0.99, axis=0), patterns.max(axis=0) / 4)
    scale[scale <= 0] = 1.0
    x = np.zeros((len(rows), v + patterns.shape[1]), dtype=np.float32)
    for at, row in enumerate(rows):
        x[at, row["words"]] = 1
    x[:, v:] = np.minimum(patterns / scale, 3)
    weights, bias = _linear(x, target)
    return Classifier(features, scale, weights, bias, voters)


def _linear(x: np.ndarray, target: np.ndarray, steps: int = STEPS, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam over the whole matrix."""
    w = np.zeros(x.shape[1] + 1)
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -50, 50)))
        off = (p - target).astype(np.float32)
        grad = np.append(x.T @ off / len(x) + decay * w[:-1], off.mean())
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, classifier: Classifier, carried: str | None = None) -> DataFrame:
    """``doc_id, score, predicted`` for every row; only ``text`` is looked at.  ``carried`` names a column that rides along.

    Null and empty texts are scored like a text without any word.  Repeated rows come out each.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            scores = pa.array([classifier.score(texts[i].as_py()) for i in range(len(batch))], pa.float64())
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, scores], [*kept, "score"])

    kept = ["doc_id"] if carried is None else ["doc_id", carried]
    schema = StructType([docs.schema[name] for name in kept]).add("score", "double")
    scored = docs.select(*kept, "text").mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
