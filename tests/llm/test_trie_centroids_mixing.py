"""Prefix trie, clustering and mixing against plain Python and DuckDB, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tallyfold.llm import centroids, mixing, queries, trie
from tallyfold.session import cut_lineage

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_trie", "op12_centroids", "op13_mixing"])
def test_matches_sql(spark, name):
    con = connect(SF)
    con.execute(f"CREATE VIEW IF NOT EXISTS embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert difference(queries.QUERIES[name](spark, SF), con, queries.SQL[name]) is None


# --- prefix trie


def brute_trie(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r or "", x or ""))
    for turns in convs.values():
        turns.sort(key=lambda q: (q[0] is not None, q[0] or 0, hashlib.md5(f"{len(q[1])}:{q[1]}{q[2]}".encode()).hexdigest()))
    own = {c: [q[1:] for q in turns] for c, turns in convs.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, children, below = {}, {}, {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    for path in sorted(members, key=len, reverse=True):
        under = [below[q] for q in children.get(path, [])]
        saved = (len(members[path]) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        below[path] = (sum(u[0] for u in under) if under else 1, saved + sum(u[1] for u in under))
    out = []
    for path, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(whole[c]) == len(path))
        up = min(members[path[:-1]]) if path else None
        out.append((min(inside), len(path), up, len(inside), len(children.get(path, [])), *below[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def spark_trie(df, n_shards):
    rows = trie.nodes(cut_lineage(trie.rebuilt(df)), n_shards).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def talks():
    """A hot first turn, a hot conversation, long ones, turns that tie, nulls everywhere, repeated rows."""
    draw, rows = random.Random(3), []
    for c in [*range(0, 120, 3), *range(200, 260)]:
        hot, long = draw.random(), draw.random() < 0.1
        turns = [("user", "hi there")] + [(draw.choice(["user", None, ""]), draw.choice(["a", "b c", None, " d\te f "])) for _ in range(draw.randint(0, 90 if long else 6))]
        if hot < 0.3:
            turns = [("user", "hi there"), ("assistant", "hello you two")] * 2
        elif hot < 0.5:
            turns = [("user", "deep")] * 40 + turns
        rows += [(c, draw.choice([t, t, None]) if hot > 0.9 else t, r, x) for t, (r, x) in enumerate(turns)]
    return rows + rows[:6] + [(None, 1, "user", "x")] * 5 + [(40, None, None, None), (4_000_000_000_000, 0, "u", "v " * 200_000)]


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("n_shards", [1, 2, 13, 60])
def test_trie_is_the_same_over_any_shards(spark, talks, n_shards):
    df = spark.createDataFrame(talks, TURNS).select("*", *(F.lit("x").alias(n) for n in ("conv", "path", "words", "key", "depth", "shard")))
    assert spark_trie(df, n_shards) == brute_trie(talks)


def test_trie_of_few_rows(spark):
    assert spark_trie(spark.createDataFrame([], TURNS), None) == []
    for rows in ([(7, 0, "user", "x y")], [(20, None, None, None)], [(21, 5, "a", ""), (21, 5, "", "a")]):
        assert spark_trie(spark.createDataFrame(rows, TURNS), None) == brute_trie(rows)


def test_equal_conversations_fill_many_shards(spark):
    """Ids that end at one node come from all shards and are hashed in order."""
    rows = [(c, t, "user", "same words") for c in range(0, 400, 20) for t in range(2)] + [(c, t, "user", "same words") for c in range(401, 420) for t in range(2)]
    assert spark_trie(spark.createDataFrame(rows, TURNS), 9) == brute_trie(rows)


def test_matrices_mark_starts_deeper_than_one_matrix():
    conv = np.array([5, 3, 9])
    codes = np.array([1] * 70 + [1] * 70 + [1] * 69 + [2], dtype=np.int32)
    t = trie.Trie(conv, np.array([0, 70, 140, 210]), codes, np.ones(210, dtype=np.int64))
    assert np.bincount(t.depth).tolist() == [1] * 70 + [2]
    assert t.conv[-2:].tolist() == [3, 9] and t.n_convs[-2:].tolist() == [2, 1]
    assert t.children[-3:].tolist() == [2, 0, 0]
    assert {k: e.tolist() for k, e in t.ends if len(e)} == {70: [3, 5], 71: [9]}


# --- clustering


def brute_clusters(rows, k=8, rounds=10, size=64):
    def kept(v):
        return v is not None and len(v) == size and all(c is not None and abs(c) < 2**17 for c in v)

    whole = [(i, [int(np.floor(1024 * c)) for c in v]) for i, v in rows if kept(v)]
    if not whole:
        return []
    first = sorted(whole, key=lambda t: (hashlib.sha256(f"3:{'' if t[0] is None else t[0]}".encode()).hexdigest(), t[1]))[:k]
    c, x = np.array([v for _, v in first]), np.array([v for _, v in whole])

    def assign():
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        n, _ = assign()
        for j in set(n.tolist()):
            c[j] = x[n == j].sum(0) // (n == j).sum()
    n, d = assign()
    names = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c]
    out = [(i, int(a), int(b), int(d[n == a].sum()), int(d.sum()), names[a]) for (i, _), a, b in zip(whole, n, d, strict=True)]
    return sorted(out, key=lambda r: (r[0] is not None, r))


def spark_clusters(df):
    return sorted((tuple(r) for r in centroids.cluster(df).collect()), key=lambda r: (r[0] is not None, r))


@pytest.fixture(scope="module")
def vectors():
    """Ties (few values), repeated rows, null ids and vectors, wrong sizes, components that are no numbers or too large."""
    draw = np.random.default_rng(0)
    rows = [(i, draw.integers(-2, 3, 64).astype(float).tolist()) for i in range(40)]
    odd = [None, [1.0] * 63, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] * 64, [], [1e30] * 64, [-131071.5] * 64, [131071.5] * 64]
    return rows + rows[:10] + [(None, [0.5] * 64), (None, [0.25] * 64)] + [(100 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("n", [100, 40, 3, 1, 0])
def test_clusters_are_those_of_brute_force(spark, vectors, n):
    df = spark.createDataFrame(vectors[:n], "vec_id long, embedding array<double>").select("*", *(F.lit(1).alias(c) for c in ("x", "rest", "cluster", "inertia")))
    assert spark_clusters(df) == brute_clusters(vectors[:n])


def test_bounds_hold_and_leave_few_centroids(spark):
    """No distance lies below its bound; where vectors gather, most centroids are never measured."""
    draw = np.random.default_rng(1)
    heaps = draw.normal(0, 1, (8, 64))
    points = [(i, (heaps[i % 8] + draw.normal(0, 0.1, 64)).tolist()) for i in range(800)]
    table = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    whole = centroids.whole_vectors(table, "vec_id", "embedding", 64)
    how = centroids.rotation(whole, 64)
    assert np.allclose(how.axes.T @ how.axes, np.eye(how.axes.shape[1]), atol=1e-9)
    x = np.array([r["x"] for r in whole.collect()], dtype=np.int64)
    c = centroids.seeds(whole, 8, 3)
    exact = ((x[:, None, :] - c[None]) ** 2).sum(2)
    bound = how.bounds(*how.project(x), c)
    assert (bound <= exact).all()
    number, distance = how.nearest(x, *how.project(x), c)
    assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert (bound <= distance[:, None]).mean() < 0.5


# --- mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight, total, capped = {s: 1 + i % 3 for i, s in enumerate(names)}, sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, share = total - sum(capped.values()), sum(weight[s] for s in free)
        over = [s for s in free if Fraction(left * weight[s], share) > 3 * sizes[s]]
        if not over:
            return {s: float(capped[s]) if s in capped else left * weight[s] / share for s in names}
        capped |= {s: 3 * sizes[s] for s in over}


DOCS = "doc_id int, text string, source string"


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_every_budget(spark, monkeypatch, seed):
    """Hot and tiny sources, null ids, texts and sources, repeated rows; ranges of few rows."""
    monkeypatch.setattr(mixing, "RANGE", 7)
    draw = random.Random(seed)
    names = [None, "", "b", "é", "z", "\U0001f600"]
    rows = [(draw.choice([None, *range(40)]), "a\x0bb " * draw.choice([0, 1, 5, 500]), draw.choice(names[:2] * seed + names)) for _ in range(90)]
    rows += [(9, None, "q"), (9, None, "q"), (1, "one", "y"), (6, "w " * 100_000, "z")]
    df = spark.createDataFrame(rows, DOCS).select("*", *(F.lit(1).alias(c) for c in ("size", "draw", "range", "row_key", "taken", "target")))
    out = mixing.mix(df).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    aims = brute_targets(sizes)
    for source, size in sizes.items():
        got = [r for r in out if r["source"] == source]
        assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((d or -1, len(WORD.findall(x or ""))) for d, x, s in rows if s == source)
        assert all(r["source_size"] == size and abs(r["target"] - aims[source]) <= 1e-9 * max(1, size) for r in got)
        assert sum(r["taken"] for r in got) == int(aims[source] + 0.5)
        epochs = {r["taken"] / r["size"] for r in got if r["size"]}
        assert all(0 <= e <= 3 for e in epochs) and len({int(e) for e in epochs if e % 1}) <= 1
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mix_of_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    out = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], DOCS)).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in out) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
