"""Validation gate (V), jet substructure vs NumPy brute force (J, N3), registry fold (R4), entry contract."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from collide import fixtures as FX
from collide.operators import jets as J
from collide.operators import registry as R
from collide.operators import validate as V
from tests.conftest import SF_SMALL


def test_gate_passes_clean_and_raises_dirty(spark):
    clean = V.validate_gate(FX.collisions(spark, SF_SMALL))
    assert dict(clean.dtypes)["lepton_pt"] == "double"
    with pytest.raises(V.ValidationError) as e:
        V.validate_gate(FX.view(spark, SF_SMALL, "dirty"))
    assert e.value.failures and e.value.summary["passed"] is False
    assert V.validate_gate(FX.view(spark, SF_SMALL, "dirty"), raise_on_failure=False) is not None


def _dr(a, b):
    d = a[2] - b[2]
    d = d - 2 * math.pi if d > math.pi else (d + 2 * math.pi if d < -math.pi else d)
    return math.sqrt((a[1] - b[1]) ** 2 + d * d)


def test_substructure_100_constituents_vs_numpy(spark):
    rng = np.random.default_rng(4)
    n = 100
    c = [(float(rng.uniform(1, 50)), float(rng.uniform(-2, 2)), float(rng.uniform(-3.1, 3.1))) for _ in range(n)]
    df = spark.createDataFrame([(1, [(p, e, f, p) for p, e, f in c])],
                               "event_id long, jet array<struct<pt:double, eta:double, phi:double, E:double>>")
    got = J.substructure(df).first()
    ptj = sum(x[0] for x in c)
    axes = sorted(range(n), key=lambda i: (-c[i][0], -i))
    for N, name in ((1, "tau1"), (2, "tau2"), (3, "tau3")):
        ax = [c[i] for i in axes[:N]]
        tau = sum(x[0] * min(_dr(x, a) for a in ax) for x in c) / (ptj * 0.4)
        assert abs(got[name] - tau) < 1e-9 * max(1, tau)
    e2 = sum(a[0] * b[0] * _dr(a, b) for a, b in itertools.combinations(c, 2)) / ptj ** 2
    e3 = sum(a[0] * b[0] * d[0] * _dr(a, b) * _dr(a, d) * _dr(b, d) for a, b, d in itertools.combinations(c, 3)) / ptj ** 3
    assert abs(got["ecf2"] - e2) < 1e-9 * e2 and abs(got["ecf3"] - e3) < 1e-9 * e3


def test_small_jets_give_nulls(spark):
    df = spark.createDataFrame([(1, [(10.0, 0.0, 0.0, 10.0)]), (2, [])],
                               "event_id long, jet array<struct<pt:double, eta:double, phi:double, E:double>>")
    r = {x["event_id"]: x for x in J.substructure(df).collect()}
    assert r[1]["ecf2"] is None and r[1]["ecf3"] is None and r[1]["tau1"] == 0.0
    assert r[2]["tau1"] is None and r[2]["jet_mass_j1"] is None


def test_knn_no_self_and_k_edges(spark):
    df = spark.createDataFrame([(1, [(1.0, 0.0, 0.0, 1.0), (1.0, 0.1, 0.0, 1.0), (1.0, 1.0, 0.0, 1.0)])],
                               "event_id long, jet array<struct<pt:double, eta:double, phi:double, E:double>>")
    e = J.knn_edges(df, 8).collect()
    assert all(r["src"] != r["dst"] for r in e) and len(e) == 6          # k = 8 on 3 nodes -> 2 each


def test_promotion_fold_sequence(spark):
    rows = [("m", "a", 1, 0.70), ("m", "b", 2, 0.703), ("m", "c", 3, 0.706), ("m", "d", 4, 0.71), ("n", "x", 1, 0.5)]
    df = spark.createDataFrame(rows, "model_name string, run_id string, t int, val_auc double") \
        .withColumn("registered_at", F.timestamp_seconds("t"))
    p = {r["model_name"]: r for r in R.promotion_fold(df).collect()}
    assert p["m"]["production_run_id"] == "c" and p["m"]["n_promotions"] == 2     # a, then c (0.706 - 0.70 >= 0.005)
    assert p["n"]["production_run_id"] == "x"
    b = {r["model_name"]: r["run_id"] for r in R.best_run(df).collect()}
    assert b["m"] == "d"


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "split" in df.columns
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs) and len(qs) >= 100
