"""Sampling, splitting, scaling, quantiles and prefix helpers (T1-T9, 4.2 item 1)."""
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from collide import fixtures as FX
from collide.operators import prefix as PX
from collide.operators import prepare as T
from collide.operators.quantiles import exact_quantiles
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def coll(spark):
    return FX.collisions(spark, SF_MID).select("event_id", "label", "lepton_pt", "jet4_pt")


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_split_and_sample_partition_invariant(spark, coll):
    a = rows(T.stratified_split(coll.repartition(1)), "event_id", "split")
    b = rows(T.stratified_split(coll.repartition(17)), "event_id", "split")
    assert a == b
    c = rows(T.balanced_sample(coll.repartition(1), 3000), "event_id")
    d = rows(T.balanced_sample(coll.repartition(17), 3000), "event_id")
    assert c == d and len(c) == 3000


def test_stratified_counts(spark, coll):
    s = T.stratified_split(coll).groupBy("label", "split").count().collect()
    got = {(r["label"], r["split"]): r["count"] for r in s}
    for lab in (0, 1):
        n = sum(v for (l, _), v in got.items() if l == lab)
        rest = int(np.ceil(n * 0.3))
        assert got[(lab, "train")] == n - rest
        assert got[(lab, "test")] == int(np.ceil(rest * 0.5))


def test_balanced_quota(spark, coll):
    s = T.balanced_sample(coll, 2000).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in s} == {0: 1000, 1: 1000}


def test_scalers_constant_column(spark):
    df = spark.createDataFrame([(i, 1, float(i), 5.0) for i in range(10)], "event_id long, label int, x double, c double")
    for method in ("standard", "robust", "minmax"):
        m = T.fit_scaler(df, ["x", "c"], method)
        out = m.transform(df).toPandas()
        assert (out.c == 0).all(), method
    m = T.fit_scaler(df, ["x"], "standard")
    assert abs(m.scale["x"] - np.std(np.arange(10))) < 1e-12            # population std
    mm = T.fit_scaler(df, ["x"], "minmax").transform(df).toPandas()
    assert mm.x.min() == 0 and mm.x.max() == 1
    with pytest.raises(ValueError):
        T.fit_scaler(df, ["x"], "bogus")


def test_exact_quantiles_vs_numpy(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.normal(0, 1e3, 3000), np.full(2000, 1.5), rng.uniform(-1e-8, 1e-8, 500), [0.0, -0.0]])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    q = exact_quantiles(df, ["v"], [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).orderBy("p").toPandas()
    ref = np.percentile(v, [0, 10, 25, 50, 90, 100])
    assert np.allclose(q.value.to_numpy(), ref, rtol=1e-12, atol=1e-15)


def test_monotone_bucket_is_monotone(spark):
    x = np.array([-np.inf, -1e300, -3.0, -2.0, -1.9999999, -1e-300, 0.0, 1e-300, 0.5, 0.9999999, 1.0, 1.0000001,
                  2.0, 3.5, 1e300, np.inf, np.nan])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    b = df.select("x", PX.monotone_bucket(F.col("x")).alias("b")).orderBy("x").toPandas().b.to_numpy()
    assert (np.diff(b) >= 0).all()


def test_two_level_prefix_equals_one_task_window(spark):
    rng = np.random.default_rng(11)
    s = np.unique(rng.uniform(0, 1, 5000).astype(np.float32)).astype(np.float64)
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(s)], "s double, w long")
    got = PX.cumulative(df, "s", ["w"], descending=True).select("s", "cum_w").toPandas().sort_values("s")
    ref = df.select("s", F.sum("w").over(Window.orderBy(F.col("s").desc())).alias("r")).toPandas().sort_values("s")
    assert (got.cum_w.to_numpy() == ref.r.to_numpy()).all()


def test_feature_matrix_query_returns_every_feature(spark):
    from collide import schema as S
    from tests.conftest import SF_SMALL
    from collide.catalog import ORACLES, QUERIES, load_all
    load_all()
    got = QUERIES["feature_matrix_all"](spark, SF_SMALL)
    assert len(S.FEATURES + S.DERIVED) == 35 and set(S.FEATURES + S.DERIVED) <= set(got.columns)
    assert all(f" as {c}" in ORACLES["feature_matrix_all"] for c in S.DERIVED)
