from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.llm import hard_negatives, queries, whitening
from siftloom.llm.hard_negatives import angles, centroids, mine, walk

INF = float("inf")


def grouped(seed, rows, d=8, groups=4, spread=0.15):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(groups, d))
    x = middle[rnd.integers(0, groups, rows)] + spread * rnd.normal(size=(rows, d))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def table(spark, rows):
    """``rows`` of (vec_id, label, vector) with columns beside them whose names the operators use themselves."""
    names = ["id", "x", "doc", "cluster", "part", "pos", "rank", "score", "component", "n", "anchor"]
    return spark.createDataFrame([(i, v, l, *([7] * len(names))) for i, l, v in rows],
                                 "vec_id long, embedding array<float>, label int, " + ", ".join(f"`{c}` int" for c in names))


def plain(rows, anchor, k=5):
    """Hard negatives by sorting all scores."""
    kept = [(i, l, [int(np.floor(256 * float(c))) for c in v]) for i, l, v in rows
            if i is not None and l is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, l, x in kept:
        if anchor(i):
            s = [(-int(np.dot(x, y)), j, m) for j, m, y in kept]
            near = sorted(t for t in s if t[2] == l and t[1] != i)[:k]
            for p, j, _ in near:
                far = sorted(t for t in s if t[2] != l and 80 * -p <= 100 * -t[0] <= 100 * -p)[:k]
                out += [(i, j, r, m, -p, -q) for r, (q, m, _) in enumerate(far, 1)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in mine(df, F.col("vec_id") % 10 == 0, **kw).collect())


def awkward():
    x = grouped(1, 160).tolist()
    rows = [(i, i % 3, v) for i, v in enumerate(x)]
    rows += [(i, i % 3, x[i % 4]) for i in range(160, 240)]  # ties
    rows += [(240, 1, [0.0] * 8), (250, 2, [-c for c in x[0]]), (251, 1, [-c for c in x[0]]), (None, 1, x[0]), (252, None, x[0]), (260, 1, None),
             (270, 1, [float("nan"), *x[0][1:]]), (271, 1, [INF, *x[0][1:]]), (272, 1, [None, *x[0][1:]]), (280, 99, x[3]), (17, 17 % 3, x[17]), (3, 0, x[5])]
    return rows


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rows = awkward()
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert mined(table(spark, rows)) == want
    # several clusters, each with several files of anchors, some of them empty
    for name, value in (("PART", 3), ("CLUSTER", 8), ("BOUND_SAMPLE", 40), ("FIT_SAMPLE", 12)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(table(spark, rows).repartition(5)) == want
    assert mined(table(spark, [*rows, (300, 1, [0.5] * 3), (301, 1, [])])) == want  # other lengths take no part


def test_hard_negatives_of_repeated_anchors_and_empty_tables(spark):
    rows = awkward()
    twice = [*rows, rows[10]]
    assert mined(table(spark, twice)) == plain(twice, lambda i: i % 10 == 0)
    assert mined(table(spark, rows).limit(0)) == [] and mined(table(spark, [(1, 1, [0.1])])) == []
    assert mined(table(spark, [(0, 1, [0.1, 0.2])])) == [] and mined(table(spark, [(0, 1, []), (10, 2, [])])) == []


def test_query_moves_labels(spark, tmp_path):
    x = grouped(2, 400).tolist()
    rows = [(i, i % 10, v) for i, v in enumerate(x)]
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in queries.op12_hard_negatives(spark, str(tmp_path)).collect())
    assert got == plain([(i, (l + 1) % 10 if i % 7 == 0 else l, v) for i, l, v in rows], lambda i: i % 100 == 0)


def test_walks_end_early_where_bounds_allow():
    x = np.floor(256 * grouped(3, 20_000, d=16, groups=12, spread=0.02).astype(float))
    ids, labels, norm = np.arange(len(x)), np.arange(len(x)) % 2, np.linalg.norm(x, axis=1)
    middle = centroids(x[:200], 12)
    mine = angles(x[:200], norm[:200], middle).argmin(axis=1)
    taken = rows = 0
    for c in range(len(middle)):
        at = np.flatnonzero(mine == c)
        if not len(at):
            continue
        away = angles(x, norm, middle[c:c + 1])[:, 0]
        bounds = norm * np.cos(np.clip(away - away[at].max(), 0, np.pi))
        members = {"x": x[at], "id": ids[at], "label": labels[at], "cap": np.full((len(at), 1), INF), "floor": np.full((len(at), 1), -2.0 ** 1000)}
        slot, row, score, n = walk(x, ids, labels, np.argsort(-bounds, kind="stable"), bounds, members, True, 5)
        for k, a in enumerate(at):
            s = x @ x[a]
            ok = np.flatnonzero((labels == labels[a]) & (ids != a))
            best = ok[np.lexsort((ids[ok], -s[ok]))[:5]]
            assert row[slot == k].tolist() == best.tolist() and score[slot == k].tolist() == s[best].tolist()
            assert np.all(s <= (bounds * norm[a]) * (1 + 1e-9) + 1e-3)
        taken, rows = taken + n, rows + len(at) * len(x)
    assert taken < 0.4 * rows


def brute_whitening(rows, k=4):
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, _, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in kept}))
    n, sums = len(x), x.sum(axis=0)
    a = x - sums / n
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return kept, n, sums, e, v, np.trace(a.T @ a / n)


def check_whitening(got, rows, k=4):
    kept, n, sums, e, v, trace = brute_whitening(rows, k)
    assert len(got) == len(kept) * k and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, k + 1))
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for c in range(1, k + 1):
        mine, want = [], []
        for i, x in kept:
            away = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
            r = by[(i, away)][c]
            assert r.explained == pytest.approx(e[c - 1] / trace, rel=1e-9)
            mine.append(r.whitened)
            want.append(float((np.array(x) - sums / n) @ v[:, c - 1] / np.sqrt(e[c - 1])))
        sign = np.sign(np.dot(mine, want))
        assert np.allclose(np.array(mine) * sign, want, rtol=1e-7, atol=1e-8)


def whitened(df):
    return whitening.whiten(df).select("doc.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()


def test_whitening_equals_eigenvectors(spark):
    rnd = np.random.default_rng(5)
    x = (rnd.normal(size=(300, 6)) * [9, 5, 3, 2, 1, 0.5]).astype(np.float32).tolist()
    rows = [(i, 0, v) for i, v in enumerate(x)] + [(1000 + i, 0, x[0]) for i in range(150)]  # copies count once
    bad = [(2000, 0, None), (2001, 0, [None] * 6), (2002, 0, [float("nan")] * 6), (2003, 0, [-INF] * 6)]
    check_whitening(whitened(table(spark, rows + bad)), rows)
    check_whitening(whitened(table(spark, [*rows, *bad, (2004, 0, [1.0, 2.0]), (2005, 0, [])]).repartition(7)), rows)


def test_whitening_of_ill_conditioned_rows(spark):
    rnd = np.random.default_rng(6)
    base = rnd.normal(size=(400, 3)) * [3e5, 300, 1]
    mix = np.linalg.qr(rnd.normal(size=(5, 5)))[0][:3]
    x = np.floor(base @ mix * 64) / 256
    rows = [(i, 0, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame([(i, v, l) for i, l, v in rows], "vec_id long, embedding array<double>, label int")
    got = whitening.whiten(df).select("doc.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()
    a = np.floor(256 * x)
    a = a - a.mean(axis=0)
    s = np.linalg.svd(a, compute_uv=False)
    assert s[0] / s[3] > 1e5
    for r in got:
        assert r.explained == pytest.approx(s[r.component - 1] ** 2 / (s ** 2).sum(), rel=1e-4) and r.identity_error < 1e-6


def test_whitening_leaves_out_components_without_variance(spark):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(60, 2))
    rows = [(i, 0, [float(a), float(b), float(a), 0.25, -float(b)]) for i, (a, b) in enumerate(np.round(x * 256) / 256)]
    got = whitened(table(spark, rows))
    assert {r.component for r in got} == {1, 2}
    assert sum(r.explained for r in got if r.vec_id == 0) == pytest.approx(1)
    same = [(i, 0, [0.5, 0.25]) for i in range(9)]
    assert whitened(table(spark, same)) == [] and whitened(table(spark, rows).limit(0)) == [] and whitened(table(spark, [(1, 0, [])])) == []
    assert whitened(table(spark, [(1, 0, None), (2, 0, [0.5])])) == []


def test_exact_deviations():
    sums, n = [3 * 10 ** 9, -5], 10 ** 9
    x = np.array([[3, 1], [10, -1], [2 ** 40, 0]])
    assert whitening._deviation(x, n, sums)[:2] == [(n + 5) ** 2, (7 * n) ** 2 + (n - 5) ** 2 if (7 * n) ** 2 + (n - 5) ** 2 < 1 << 63 else None]
    assert whitening._deviation(x, n, sums)[2] is None
    assert whitening._deviation(np.array([[2, 4]]), 3, [7, 9]) == [1 + 9]


def test_triangular_solves():
    rnd = np.random.default_rng(8)
    upper = np.triu(rnd.normal(size=(7, 7))) + 4 * np.eye(7)
    q = rnd.normal(size=(50, 7))
    assert np.allclose(whitening.solve(q @ upper, upper), q)
