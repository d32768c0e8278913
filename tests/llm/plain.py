"""Brute-force versions of the operators, in plain Python."""

import re
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
from xxhash import xxh64_intdigest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cosine(a, b):
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def nearest(vectors, query, k):
    ids = np.array([i for i in vectors if i != query])
    matrix = np.stack([vectors[i] for i in ids])
    scores = matrix @ vectors[query] / np.linalg.norm(matrix, axis=1) / np.linalg.norm(vectors[query])
    best = np.lexsort((ids, -scores))[:k]
    return [(int(ids[i]), float(scores[i])) for i in best]


def best_fit_decreasing(lengths, window):
    left, windows = [], []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(left, length)
        room = left.pop(at) if at < len(left) else window
        insort(left, room - length)
    windows.extend(left)
    return windows


def fingerprint(text, shingle):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    hashes = [xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > n)


def components(items, linked):
    """``items``: id to value; ids of None values stay alone."""
    left, out = sorted(items), {}
    while left:
        root, *left = left
        group, front = [root], [root]
        while front:
            one = front.pop()
            near = [x for x in left if linked(items[one], items[x])]
            left = [x for x in left if x not in set(near)]
            group += near
            front += near
        out.update(dict.fromkeys(group, root))
    return out


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)
