"""Neighbours by grid cells and triples of large jets against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from collide.operators import jets as J
from collide.operators import neighbours as NB

SCHEMA = "event_id long, idx long, pt double, eta double, phi double"


def _brute(rows, k, wrap):
    out = {}
    for g, i, _, u, v in rows:
        if not (math.isfinite(u) and math.isfinite(v)):
            continue
        cand = []
        for h, j, _, s, t in rows:
            if h != g or i == j or not (math.isfinite(s) and math.isfinite(t)):
                continue
            d = abs(v - t)
            if wrap:
                d = min(d, 2 * math.pi - d)
            cand.append(((u - s) ** 2 + d * d, j))
        out[g, i] = sorted(cand)[:k]
    return out


def _check(spark, rows, k, wrap):
    got = {}
    for r in NB.knn_cells(spark.createDataFrame(rows, SCHEMA), k, wrap=wrap).collect():
        got.setdefault((r["event_id"], r["src"]), []).append((r["rank"], r["d2"], r["dst"]))
    want = _brute(rows, k, wrap)
    assert set(got) == {x for x, near in want.items() if near}
    for x, near in got.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, len(want[x]) + 1))
        assert np.allclose([n[1] for n in near], [d for d, _ in want[x]], atol=1e-12)
        if not wrap:
            assert [n[2] for n in near] == [j for _, j in want[x]]


@pytest.mark.parametrize("wrap", [False, True])
def test_cells_equal_brute_force(spark, wrap):
    rng = np.random.default_rng(11)
    rows = []
    for g, n in ((1, 400), (2, 1), (3, 2), (4, 60)):
        rows += [(g, i, 1.0, float(rng.uniform(-4, 4)), float(rng.uniform(0, 6.28))) for i in range(n)]
    # a tight cluster with outliers, and nodes on both sides of the seam of the circle
    rows += [(5, i, 1.0, float(1 + rng.normal() * 1e-4), float(3 + rng.normal() * 1e-4)) for i in range(150)]
    rows += [(5, 150 + i, 1.0, float(rng.uniform(-4, 4)), float(rng.uniform(0, 6.28))) for i in range(5)]
    rows += [(6, i, 1.0, 0.01 * i, 0.01 * i if i % 2 else 6.27 - 0.01 * i) for i in range(30)]
    _check(spark, rows, 3, wrap)


def test_ties_and_missing_coordinates(spark):
    grid = [(1, 8 * a + b, 1.0, float(a), float(b)) for a in range(8) for b in range(8)]  # ties everywhere
    same = [(2, i, 1.0, 0.25, 0.5) for i in range(200)] + [(2, 200, 1.0, 0.5, 0.5)]       # one position
    odd = [(3, 0, 1.0, float("nan"), 0.0), (3, 1, 1.0, 0.0, float("inf")), (3, 2, 1.0, 0.0, 0.0), (3, 3, 1.0, 1.0, 0.0)]
    _check(spark, grid + same + odd, 4, False)
    extra = spark.createDataFrame([(None, 0, 1.0, 0.0, 0.0), (None, 1, 1.0, 0.0, 0.0), (1, 2, 1.0, None, 0.0)], SCHEMA)
    assert NB.knn_cells(extra, 2).count() == 0 and NB.knn_cells(extra.limit(0), 2, wrap=True).count() == 0
    with pytest.raises(ValueError):
        NB.knn_cells(extra, 0)


def test_one_position_makes_no_square(spark):
    df = spark.range(30_000).select(F.lit(1).alias("event_id"), F.col("id").alias("idx"), F.lit(0.5).alias("eta"), F.lit(0.5).alias("phi"))
    e = NB.knn_cells(df, 2).groupBy("src").agg(F.sort_array(F.collect_list("dst")).alias("d"))
    got = {r["src"]: r["d"] for r in e.collect()}
    assert len(got) == 30_000 and got[0] == [1, 2] and got[1] == [0, 2] and got[29_999] == [0, 1]


def test_edge_features_equal_in_row(spark):
    rng = np.random.default_rng(5)
    rows = [(g, i, float(rng.uniform(1, 9)), float(rng.uniform(-2, 2)), float(rng.uniform(-3, 3)))
            for g, n in ((1, 50), (2, 1), (3, 4)) for i in range(n)]
    flat = spark.createDataFrame(rows, SCHEMA)
    jets = flat.groupBy("event_id").agg(F.array_sort(F.collect_list(F.struct("idx", "pt", "eta", "phi"))).alias("jet"))
    a = {r[0]: r[1:] for r in J.edge_features(jets, 3).collect()}
    b = {r[0]: r[1:] for r in NB.edge_features_cells(flat, 3).collect()}
    assert set(a) == set(b)
    for g in a:
        assert np.allclose(a[g], b[g])


def test_ecf3_spread(spark):
    rng = np.random.default_rng(3)
    jets = [(g, [(float(rng.uniform(1, 50)), float(rng.uniform(-2, 2)), float(rng.uniform(-3.1, 3.1)), 1.0) for _ in range(n)])
            for g, n in ((1, 90), (2, 2), (3, 0), (4, 30), (5, 31))]
    jets += [(6, None), (7, [(0.0, 0.1 * i, 0.0, 0.0) for i in range(40)])]
    df = spark.createDataFrame(jets, "event_id long, jet array<struct<pt:double, eta:double, phi:double, E:double>>")
    want = dict(df.select("event_id", J.ecf(F.col("jet"), 3)).collect())
    got = dict(NB.ecf3_spread(df, large=30, triples=500).collect())
    assert set(got) == set(want)
    for g, v in want.items():
        assert (v is None) == (got[g] is None) and (v is None or abs(v - got[g]) <= 1e-9 * abs(v))
    assert got[3] is None and got[6] is None and got[7] is None and got[1] > 0


@pytest.mark.parametrize("wrap", [False, True])
def test_whole_groups_and_cells_agree(spark, wrap):
    rng = np.random.default_rng(5)
    rows = [(int(g), int(i), float(i), float(rng.integers(0, 12)) / 4, float(rng.uniform(-3, 3)))
            for g, n in enumerate((1, 2, 3, 40, 300)) for i in range(n)]
    rows += [(3, 7, 1.0, 0.5, 0.5), (3, 7, 1.0, 0.5, 0.5), (3, None, 1.0, 0.5, 0.5), (None, 1, 1.0, 0.0, 0.0)]
    d = spark.createDataFrame(rows, SCHEMA)
    cols = ["event_id", "src", "dst", "rank", "d2", "x_pt", "y_pt"]
    got = [sorted(map(tuple, NB.knn_cells(d, 3, wrap=wrap, carry=("pt",), small=small).select(cols).collect()))
           for small in (0, 50, 1024)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 900


def test_groups_of_some_hundred_nodes_are_not_copied_per_level(spark):
    d = spark.createDataFrame([(i % 3, i, 1.0, i * 0.01, i * 0.02) for i in range(300)], SCHEMA)
    plan = NB.knn_cells(d, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
