"""Centroid clustering, one-bit code search and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from functools import cmp_to_key

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparquill.llm import centroids, hard_negatives, queries, rotated_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def clumps(n, length=64, groups=7, seed=1, spread=0.1):
    """Rows around a few points, every ninth a copy of another, under shuffled ids."""
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((groups, length))
    out = [(middle[i % groups] + spread * rng.standard_normal(length)).astype(np.float32).tolist() for i in range(n)]
    for i in range(0, n, 9):
        out[i] = out[min(3, n - 1)]
    return [(int(k), v, i % 4) for i, (k, v) in enumerate(zip(rng.permutation(2 * n)[:n], out, strict=True))]


#: Rows that take part nowhere, but for the label of the last but one.
ODD = [(50, None, 1), (100, [0.5] * 63 + [None], 1), (150, [NAN] * 64, 1), (200, [INF] + [0.0] * 63, 2), (250, [], 1), (300, [0.0] * 64, None), (None, None, None)]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"v": F.lit("clash"), "id": F.lit(1), "cluster": F.lit(2), "code": F.lit(3), "distance": F.lit(4)}).repartition(parts)


def whole(v):
    return [math.floor(256 * x) for x in v]


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# Centroid clustering


def brute_clusters(rows, k, rounds=5, length=64):
    kept = [(i, np.array(whole(v))) for i, v, _ in rows if sound(v) and len(v) == length]
    text = lambda i: "2:" + ("" if i is None else str(i))
    original = {id(x): v for x, v in zip((x for _, x in kept), (v for _, v, _ in rows if sound(v) and len(v) == length), strict=True)}
    first = sorted(kept, key=lambda r: (hashlib.sha256(text(r[0]).encode()).hexdigest(), original[id(r[1])]))[:k]
    middle = [x.tolist() for _, x in first]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x.tolist(), c, strict=True)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        to = [near(x)[1] for _, x in kept]
        for j in range(len(middle)):
            own = [x for (_, x), t in zip(kept, to, strict=True) if t == j]
            if own:
                middle[j] = [sum(int(x[d]) for x in own) // len(own) for d in range(length)]
    last = [(i, *near(x)) for i, x in kept]
    total = sum(d for _, d, _ in last)
    per = {j: sum(d for _, d, t in last if t == j) for j in range(len(middle))}
    return [(i, t, d, per[t], total, hashlib.sha256(",".join(map(str, middle[t])).encode()).hexdigest()) for i, d, t in last]


@pytest.mark.parametrize(("n", "k", "spread"), [(160, 12, 0.1), (90, 40, 1.0), (25, 40, 0.0), (1, 3, 0.1)])
def test_centroids(spark, n, k, spread):
    rows = clumps(n, spread=spread) + ODD + [(7, [0.25] * 64, None), (7, [0.25] * 64, 1), (7, [-0.25] * 64, 1), (None, [0.001] * 64, 1), (9, [1.0] * 63, 1)]
    got = centroids.report(*centroids.cluster(table(spark, rows), k=k))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_clusters(rows, k), key=repr)


def test_centroids_of_nothing(spark):
    assert centroids.report(*centroids.cluster(table(spark, ODD[:5] + ODD[6:]))).count() == 0
    assert centroids.report(*centroids.cluster(table(spark, ODD).limit(0))).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.report(*centroids.cluster(table(spark, [(1, [1e9] * 64, 1)])))


@pytest.mark.parametrize("kind", ["clumps", "copies", "noise", "line"])
def test_trees_assign_as_brute_force_and_hold_exact_sums(kind):
    rng = np.random.default_rng(3)
    points = {
        "clumps": rng.integers(-500, 500, (9, 16)).repeat(60, 0) + rng.integers(-3, 4, (540, 16)),
        "copies": np.full((700, 16), -7),
        "noise": rng.integers(-(1 << 23), 1 << 23, (500, 16)),
        "line": np.arange(600)[:, None] * np.ones((1, 16), np.int64),
    }[kind].astype(np.int64)
    tree, order = centroids.grow(points, leaf=8)
    assert sorted(order.tolist()) == list(range(len(points))) and (tree.points == points[order]).all()
    for i in range(len(tree.lo)):
        own = tree.points[tree.lo[i] : tree.hi[i]]
        assert (tree.total[i] == own.sum(0)).all() and tree.radius[i] ** 2 >= ((own - tree.center[i]) ** 2).sum(1).max()
    middle = np.concatenate([points[::60], points[:70:60], points[-1:] + 40])  # ties: equal centroids
    want = ((points[:, None, :] - middle[None]) ** 2).sum(2).argmin(1)
    assert (centroids.assigned(tree, middle) == want[order]).all()
    nodes, _, open_points, _ = centroids.descend(tree, middle)
    if kind in ("clumps", "copies"):  # most vectors go with their ball
        assert len(open_points) < len(points) / 4 and len(nodes) < len(points) / 2


def test_a_large_group_of_copies_is_one_ball(spark):
    rows = [(i, [0.5] * 64, 1) for i in range(3000)] + clumps(300)
    tree = centroids.trees(centroids.kept(table(spark, rows, 1), "vec_id", "embedding", 64)).collect()
    assert len(tree) == 1 and len(np.frombuffer(tree[0].lo, np.int32)) < 3300 / 8
    got = centroids.report(*centroids.cluster(table(spark, rows), k=5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_clusters(rows, 5), key=repr)


# Nearest neighbours


def brute_nearest(rows, k=5):
    fit = [(i, [float(x) for x in v]) for i, v, _ in rows if sound(v) and any(x != 0 for x in v)]

    def folded(a, b):
        s = 0.0
        for x, y in zip(a, b, strict=True):
            s += x * y
        return s

    out = []
    for q in {i for i, _ in fit if i is not None and i % 50 == 0}:
        v = min(x for i, x in fit if i == q)
        scores = {}
        for i, x in fit:
            if i != q and len(x) == len(v):
                s = folded(v, x) / (math.sqrt(folded(v, v)) * math.sqrt(folded(x, x)))
                scores[i] = max(scores.get(i, -2.0), s)
        best = sorted(scores.items(), key=lambda r: (-r[1], r[0] is None, r[0]))[:k]
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(best)]
    return out


@pytest.mark.parametrize("n", [0, 3, 400])
def test_nearest(spark, n):
    rng = random.Random(2)
    rows = clumps(n, spread=0.6) + ODD + [(350, [0.0] * 63 + [1e-30], 1), (None, [0.5] * 64, 1), (400, [1.0, 2.0], 1), (13, [2.0, 4.0], 1), (17, [2.0, 4.0], 1), (13, [1.0, 0.0], 1), (450, [3.0], 1), (400, [1.0, 2.0], 1)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(64)], 1) for i in (500, 550, 600)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]
    vecs = table(spark, rows)
    got = rotated_codes.search(rotated_codes.build(vecs), vecs.filter("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_nearest(rows), key=repr)


def test_codes_prune_and_recall(spark):
    rng = np.random.default_rng(8)
    m = rng.standard_normal((6000, 64))
    m /= np.linalg.norm(m, axis=1)[:, None]
    u, q = rotated_codes.turned(m), rotated_codes.turned(m[:60])
    code, fit = np.packbits(u > 0, axis=1), np.abs(u).sum(1) / 8
    guess, true = rotated_codes.estimates(code, fit, q), m[:60] @ m.T
    off = np.abs(guess - true) / rotated_codes.deviations(fit, 64)
    off = off[np.arange(60)[:, None] != np.arange(6000)]
    assert 0.9 < np.sqrt((off**2).mean()) < 1.05 and (off > rotated_codes.EPS).mean() < 0.004
    rows = [(i, v.tolist(), 0) for i, v in enumerate(m)]
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {}
    for r in rotated_codes.search(rotated_codes.build(vecs), vecs.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = m[::50] @ m.T
    score[np.arange(120), np.arange(0, 6000, 50)] = -2
    want = [set(np.argsort(-s)[:5].tolist()) for s in score]
    assert sum(len(got[50 * i] & w) for i, w in enumerate(want)) >= 0.98 * 600
    assert (guess + rotated_codes.EPS * rotated_codes.deviations(fit, 64) < np.sort(true, 1)[:, -6:-5]).mean() > 0.6  # dropped by codes alone


def test_blocks_of_any_number_give_the_same(spark, monkeypatch):
    rows = clumps(300, spread=0.6)
    vecs = table(spark, rows)
    monkeypatch.setattr(vectors, "KEPT_BYTES", 1)
    monkeypatch.setattr(vectors.write_blocks, "__defaults__", (2,))
    got = rotated_codes.search(rotated_codes.build(vecs), vecs.filter("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_nearest(rows), key=repr)


# Hard negatives


def first_by(order, rows):
    return sorted(rows, key=cmp_to_key(lambda a, b: (order(a) > order(b)) - (order(a) < order(b))))


def brute_negatives(rows):
    fit = []
    for i, v, c in rows:
        if c is not None and sound(v):
            fit.append((i, (c + 1) % 10 if i is not None and i % 7 == 0 else c, whole(v), v))
    out = []
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for a in {r[0] for r in fit if r[0] is not None and r[0] % 50 == 0}:
        _, label, x, _ = min((r for r in fit if r[0] == a), key=lambda r: (str(r[1]), r[3]))
        same, rest = {}, {}
        for i, c, y, _ in fit:
            if len(y) == len(x):
                s = sum(p * q for p, q in zip(x, y, strict=True))
                if c == label and i != a:
                    same[i] = max(same.get(i, s), s)
                if c != label:
                    rest.setdefault(i, []).append(s)
        for p, ps in sorted(same.items(), key=order)[:5]:
            hit = {i: max(s for s in ss if 50 * ps <= 100 * s <= 95 * ps) for i, ss in rest.items() if any(50 * ps <= 100 * s <= 95 * ps for s in ss)}
            out += [(a, p, n + 1, i, ps, s) for n, (i, s) in enumerate(sorted(hit.items(), key=order)[:3])]
    return out


def mined(vecs):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.prepared(vecs, label), F.col("id") % 50 == 0)


@pytest.mark.parametrize(("n", "spread"), [(0, 1.0), (40, 0.5), (500, 0.8)])
def test_hard_negatives(spark, n, spread):
    rows = clumps(n, spread=spread) + ODD + [(700, [1.0] * 64, 9), (350, [0.9] * 64, 0), (351, [0.7] * 64, 5), (352, [0.7] * 64, 5), (None, [0.7] * 64, 5), (None, [0.9] * 64, 0), (353, [-1.0] * 64, 0)]
    rows += [(400, [1.0, 2.0], 1), (13, [2.0, 4.0], 1), (17, [1.0, 2.0], 2), (17, [1.0, 2.0], 2), (400, [1.0, 2.0], 1), (1000, [0.0] * 64, 3), (1001, [0.0] * 64, 3)]
    got = mined(table(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_negatives(rows), key=repr)


def test_pruning_keeps_every_pair_that_counts():
    rng = np.random.default_rng(5)
    m = (rng.standard_normal((700, 64)) * np.linspace(2, 0.01, 64)) @ np.linalg.qr(rng.standard_normal((64, 64)))[0]
    import pyarrow as pa

    t = pa.table({"id": pa.array(range(700)), "label": ["a"] * 700, "v": pa.array(m.tolist())})
    x = vectors.integers(m)
    basis = {64: np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]}
    for bases in (basis, {}):
        b = hard_negatives.Pruned(t, bases)
        a = hard_negatives.Pruned(t.slice(0, 50), bases)
        exact = x[:50] @ x.T
        least = np.sort(exact, 1)[:, -20]
        i, j = hard_negatives.hopeful(a, b, slice(0, 700), least, np.ones((50, 700), bool))
        want = np.argwhere(exact >= least[:, None])
        assert {tuple(p) for p in want.tolist()} <= set(zip(i.tolist(), j.tolist(), strict=True))
        if bases:  # the leading components decide: little more is left than what counts
            assert len(i) < 1.2 * len(want)


def test_products_are_exact_beyond_double_precision():
    a = np.array([[(1 << 27) + 1, 1]])
    assert vectors.products(a, a).tolist() == [[((1 << 27) + 1) ** 2 + 1]]


# Queries


@pytest.mark.parametrize("name", ["op11_centroids", "op12_nearest", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name, tmp_path):
    rows = clumps(260, spread=0.5, seed=4)
    rows += [r for r in ODD if r[0] is not None and (name == "op11_centroids" or r[0] not in {i for i, _, _ in rows})]
    vecs = spark.createDataFrame(rows, SCHEMA)
    vecs.repartition(2).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = queries.queries()[name](spark, str(tmp_path))
    found = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(found.fetchall())
