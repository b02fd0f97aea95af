"""Greedy string tiling against a plain search, and texts that repeat themselves."""

from __future__ import annotations

import re
import time

import numpy as np
import pytest

from tallyfold.llm import tiling


def _seeds(tokens, other, width):
    """Positions and numbers of the seeds that the other text holds too."""
    grams = sorted({tuple(tokens[k : k + width]) for k in range(len(tokens) - width + 1)} & {tuple(other[k : k + width]) for k in range(len(other) - width + 1)})
    number = {g: k for k, g in enumerate(grams)}
    at = [k for k in range(len(tokens) - width + 1) if tuple(tokens[k : k + width]) in number]
    return np.array(at, dtype=np.int64), np.array([number[tuple(tokens[k : k + width])] for k in at], dtype=np.int64)


def _plain(a, b, width):
    """Again and again the longest match of free tokens, the first in the document, then in the item."""
    used_a, used_b, tiles = set(), set(), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n >= width and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return tiles
        tiles.append(best)
        used_a.update(range(best[0], best[0] + best[2]))
        used_b.update(range(best[1], best[1] + best[2]))


@pytest.mark.parametrize("width", [2, 5])
def test_tiles_equal_a_plain_greedy_search(width):
    rng = np.random.default_rng(width)
    several = 0
    for round_ in range(120):
        letters = 1 + round_ % 4
        a, b = rng.integers(0, letters, rng.integers(0, 45)).tolist(), rng.integers(0, letters, rng.integers(0, 30)).tolist()
        if round_ % 3 == 0:
            a = a + b[len(b) // 2 :] + [9] + b[: len(b) // 2]
        want = _plain(a, b, width)
        (doc_at, doc_seed), (item_at, item_seed) = _seeds(a, b, width), _seeds(b, a, width)
        assert tiling.tile_seeds(doc_at, doc_seed, item_at, item_seed, width) == want
        pairs = [(i, j) for i, s in zip(doc_at, doc_seed, strict=True) for j, t in zip(item_at, item_seed, strict=True) if s == t]
        both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        assert tiling.tile(both[:, 0], both[:, 1], width) == want
        several += len(want) > 1
    assert several > 15


def test_overlaps_equal_a_plain_search(spark):
    rng = np.random.default_rng(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"]

    def some(n, k):
        return " ".join(rng.choice(words[:k], n))

    items = [(1, some(30, 2)), (2, some(25, 7)), (3, "alpha " * 40), (3, "beta " * 40), (4, None), (5, ""), (None, some(20, 3))]
    rows = [(d, some(60, 2 + d % 5)) for d in range(12)]
    halves = [t.split() for _, t in items if t]
    rows += [(20 + k, " ".join([*h[len(h) // 2 :], "cut", *h[: len(h) // 2]])) for k, h in enumerate(halves)]
    rows += [(40, "alpha " * 300), (41, None), (42, ""), (40, "alpha " * 300), (None, "beta " * 50)]
    got = tiling.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want: dict[tuple, int] = {}
    for d, text in set(rows):
        for i, item in items:
            listed = re.findall("[a-z]+", item or "")
            covered = sum(t[2] for t in _plain(re.findall("[a-z]+", text or ""), listed, tiling.WIDTH))
            if covered:
                want[d, i] = max(want.get((d, i), 0), covered)
    assert {(r["doc_id"], r["item_id"]): r["covered_tokens"] for r in got} == want
    assert all(sum(t["tokens"] for t in r["tiles"]) == r["covered_tokens"] for r in got)


def test_repetitive_texts_end_soon(spark):
    docs = spark.createDataFrame([(1, "word " * 200_000), (2, "one two " * 100_000), (3, "word " * 3)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "word " * 2000), (2, "two one " * 1000)], "item_id long, text string")
    begun = time.monotonic()
    got = {(r["doc_id"], r["item_id"]): (r["covered_tokens"], len(r["tiles"])) for r in tiling.overlaps(docs, items).collect()}
    assert got == {(1, 1): (2000, 1), (2, 2): (2000, 1)}
    assert time.monotonic() - begun < 60
