"""Quality rules as weak voters, with DataFrame functions only.

Each rule says bad or nothing, or good or nothing, of a document.  Expectation-maximisation over how often each pattern
of votes occurs estimates how often each rule is right, without labels, and the posterior probability of good text
decides in place of "all rules must pass".
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satchel.llm.scratch import keep

BLANKS = " \t\n\x0b\f\r"
WINDOW = 8
SYMBOLS = "#*$%&|<>"  # none of them means anything else inside a class of a pattern
LEAST_WORDS, MOST_REPEATED = 20, 30  # of the base rule: words, and per cent of words in repeated windows
ROUNDS = 100
BAD, NOTHING, GOOD = -1, 0, 1


def _bound(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once for each row, however often they are used: a one-row generator between
    them and their users keeps Catalyst from copying the expressions."""
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", made)


def measures(docs: DataFrame) -> DataFrame:
    """The base counts of each row of ``docs`` (``doc_id``, ``text``).

    ``n_words`` words (runs without ASCII white space), ``word_chars`` code points in them, ``n_symbols``, ``n_dup_lines``
    lines with a word that equal an earlier line, ``n_repeat_words`` words in windows of eight that occur twice or more in
    the text, and ``n_upper``, ``n_distinct``, ``n_digits``, ``n_lines``.  A null text counts as an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = _bound(
        docs.select("doc_id", text.alias("text")),
        words=F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        lines=F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0),
    )
    n = F.size("words")
    counted = _bound(
        split,
        n_words=n.cast("long"),
        word_chars=F.length(F.translate("text", BLANKS, "")).cast("long"),
        n_symbols=(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_distinct=F.size(F.array_distinct("words")).cast("long"),
        n_symbol_runs=F.regexp_count("text", F.lit(rf"[{SYMBOLS}]+")).cast("long"),
        n_upper=F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long"),
        n_digits=(F.length("text") - F.length(F.translate("text", "0123456789", ""))).cast("long"),
        n_marks=(F.length("text") - F.length(F.translate("text", "!?", ""))).cast("long"),
        windows=F.when(
            n >= WINDOW,
            F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("text", "words", "lines")
    # Most texts repeat no window, and a set of the hashes tells; only the others sort them.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(
        repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    sorted_ = _bound(counted, placed=placed).drop("windows")
    h = lambda at: F.get("placed", at)["h"]
    twice = F.filter("placed", lambda x, at: (h(at - 1) == x["h"]) | (h(at + 1) == x["h"]))
    found = _bound(sorted_, places=F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("placed")
    gaps = F.transform(
        "places", lambda i, at: F.when(at > 0, F.least(F.lit(WINDOW), i - F.get("places", at - 1))).otherwise(WINDOW)
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", covered).drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _share(count: str, of: str) -> Column:
    return F.col(count) / F.greatest(F.col(of), F.lit(1))


def rules() -> dict[str, Column]:
    """Votes of each rule, -1 for bad and 1 for good text; a rule that has no ground to speak abstains with 0."""
    length, variety = _share("word_chars", "n_words"), _share("n_distinct", "n_words")
    symbols, runs = _share("n_symbols", "n_words"), _share("n_symbol_runs", "n_words")
    marks, upper = _share("n_marks", "n_words"), _share("n_upper", "word_chars")
    enough = F.col("n_words") >= LEAST_WORDS
    bad = {
        "few_words": ~enough,
        "odd_length": (length < 2) | (length > 14),
        "symbols": symbols > 0.3,
        "symbol_runs": runs > 0.2,
        "symbol_share": _share("n_symbols", "word_chars") > 0.05,
        "repeated": _share("n_repeat_words", "n_words") > 0.3,
        "marks": marks > 0.3,
        "upper": upper > 0.5,
        "few_kinds": (variety < 0.1) & (F.col("n_words") < 2000),
        "digits": _share("n_digits", "word_chars") > 0.3,
        "same_lines": _share("n_dup_lines", "n_lines") > 0.3,
    }
    good = {
        "varied": enough & (variety > 0.3),
        "plain": enough & (symbols < 0.05) & (marks < 0.05) & (upper < 0.2) & length.between(3, 10),
    }
    return {name: F.when(says, vote).otherwise(NOTHING) for vote, named in ((BAD, bad), (GOOD, good)) for name, says in named.items()}


@dataclass
class Trust:
    """How often each rule is right when it speaks, and the share of good text to begin with."""

    names: list[str]
    accuracy: list[float]
    prior: float

    def weights(self) -> list[float]:
        return [math.log(a / (1 - a)) for a in self.accuracy]

    def posterior(self) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, weight in zip(self.names, self.weights(), strict=True):
            odds = odds + F.col(name) * F.lit(weight)
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], prior: float = 0.5, rounds: int = ROUNDS) -> Trust:
    """Expectation-maximisation over patterns of votes and how many rows have each.

    A rule that abstains says nothing either way.  Each rule starts as right nine times in ten and keeps ten imagined votes
    of that kind, so one that never speaks stays as written, and none is ever always right.
    """
    trust = Trust(names, [0.9] * len(names), prior)
    for _ in range(rounds):
        weights, start = trust.weights(), math.log(prior / (1 - prior))
        right, told = [9.0] * len(names), [10.0] * len(names)
        for votes, n in patterns:
            odds = start + sum(w * v for w, v in zip(weights, votes, strict=True))
            good = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            for i, vote in enumerate(votes):
                if vote:
                    told[i] += n
                    right[i] += n * (good if vote == GOOD else 1 - good)
        now = [r / t for r, t in zip(right, told, strict=True)]
        apart = max((abs(x - y) for x, y in zip(now, trust.accuracy, strict=True)), default=0.0)
        # A rule that is wrong more often than not is not turned round: it is only no longer heard.
        trust = Trust(names, [max(x, 0.5) for x in now], prior)
        if apart < 1e-9:
            break
    return trust


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Each row's measures with ``base_failed``, ``votes`` (a struct), ``posterior`` and ``kept``.

    ``kept`` is false where the base rule fails, else whether ``posterior`` reaches ``threshold``.  Null, empty and blank
    texts have no words and fail.  Repeated rows come out each; extra columns are left out; an empty table gives an empty
    one.  Patterns of votes, at most three to the power of the rules, come to the driver.
    """
    votes = rules()
    names = list(votes)
    judged = keep(measures(docs).withColumns(votes), "measures")
    patterns = [(tuple(row[n] for n in names), row["count"]) for row in judged.groupBy(*names).count().collect()]
    trust = estimate(patterns, names)
    scored = judged.withColumns({"posterior": trust.posterior(), "base_failed": base_failed()})
    kept = ~F.col("base_failed") & (F.col("posterior") >= threshold)
    return scored.withColumns({"kept": kept, "votes": F.struct(*names)}).drop(*names)
