"""The mix's schedule and the verdict of the quality rules against plain reckonings, slot by slot and row by row."""

import math
import random
from fractions import Fraction

import pytest

from satchel.llm import mixing, quality_rules


def plain_schedule(blocks, weights):
    """Earliest deadline first by looking at every source in every slot; a source that has run out ends a phase."""
    left, start, phase, out = list(blocks), 0, 0, []
    done = [0] * len(blocks)
    while active := [s for s in range(len(left)) if left[s]]:
        total, served, slot, last = sum(weights[s] for s in active), dict.fromkeys(active, 0), 0, None
        while last is None or left[last]:
            share = {s: weights[s] / total for s in active}
            due = [
                (math.ceil((served[s] + 1) / share[s]), s) for s in active if math.floor(served[s] / share[s]) <= slot
            ]
            deadline, last = min(due)
            release = math.floor(served[last] / share[last])
            out.append((last, done[last], phase, start + slot, start + release, start + deadline))
            served[last], done[last], left[last], slot = served[last] + 1, done[last] + 1, left[last] - 1, slot + 1
        start, phase = start + slot, phase + 1
    return out


@pytest.mark.parametrize("seed", range(8))
def test_schedule(seed):
    draw = random.Random(seed)
    n = draw.randrange(1, 7)
    blocks = [draw.choice([0, 1, draw.randrange(1, 90)]) for _ in range(n)]
    weights = [draw.choice([Fraction(1), Fraction(draw.random() + 1e-3), Fraction(draw.randrange(1, 9), 7)]) for _ in range(n)]
    assert list(mixing.schedule(blocks, weights)) == plain_schedule(blocks, weights)


WORDS = "sun moon river stone bread house winter summer letter garden window silver".split()


def text(draw):
    words = [draw.choice(WORDS) + str(draw.randrange(40)) * (draw.random() < 0.5) for _ in range(draw.randrange(0, 120))]
    kind = draw.randrange(6)
    if kind == 0:
        words = ["#", "$$", "..."] * (1 + len(words) // 3)
    elif kind == 1:
        words = words[:4] * 20
    elif kind == 2:
        words = [w.upper() for w in words]
    elif kind == 3:
        words = [str(draw.randrange(10**6)) for _ in words]
    lines = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
    return "\n".join(lines * draw.choice([1, 1, 1, 4]))


def by_rows(votes, prior=0.5):
    """Posteriors of rows and their rules' accuracies, one row after another."""
    names = sorted({name for row in votes for name in row})
    right = dict.fromkeys(names, 0.9)
    for _ in range(quality_rules.ROUNDS):
        good = []
        for row in votes:
            for_good, for_bad = prior, 1 - prior
            for name, vote in row.items():
                if vote:
                    agrees, differs = right[name], 1 - right[name]
                    for_good *= agrees if vote > 0 else differs
                    for_bad *= differs if vote > 0 else agrees
            good.append(for_good / (for_good + for_bad))
        was, right = right, {}
        for name in names:
            spoke = [(g if row[name] > 0 else 1 - g) for g, row in zip(good, votes, strict=True) if row[name]]
            right[name] = max((9 + sum(spoke)) / (10 + len(spoke)), 0.5)
        if max(abs(right[n] - was[n]) for n in names) < 1e-9:
            break
    out = []
    for row in votes:
        odds = sum(math.log(right[n] / (1 - right[n])) * v for n, v in row.items())
        out.append(1 / (1 + math.exp(-odds)))
    return out


def test_verdicts_of_rules(spark):
    draw = random.Random(12)
    rows = [(i, text(draw)) for i in range(400)] + [(400, None), (401, ""), (402, " \n ")]
    found = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(403))
    want = by_rows([r.votes.asDict() for r in found])
    assert max(abs(r.posterior - p) for r, p in zip(found, want, strict=True)) < 1e-6
    kept = [not r.base_failed and p >= 0.5 for r, p in zip(found, want, strict=True)]
    assert [r.kept for r in found] == kept
    assert 40 < sum(kept) < 360
