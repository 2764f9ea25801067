"""Null and NaN scores, null groups, the gate, real CSV files, nested settings, stores, quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from collide import fixtures as FX
from collide import schema as S
from collide.operators import metrics as M
from collide.operators import prepare as T
from collide.operators import validate as V
from collide.operators.quantiles import quantile_wide
from collide.plans import etl as X
from collide.session import fresh_dir
from collide.sources import io as IO

from .conftest import SF_SMALL


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


@pytest.mark.parametrize("rows,auc,ap", [
    ([(1, 0.9), (1, 0.8), (1, None), (0, 0.1)], 0.5, 0.75),
    ([(1, 0.9), (1, 0.8), (0, float("nan")), (0, 0.1)], 0.5, 0.5),
    ([(1, 0.9), (1, 0.8), (0, 0.1)], 1.0, 1.0),
    ([(1, 0.9), (1, 0.8)], 0.5, 1.0),
])
def test_missing_scores(spark, rows, auc, ap):
    st = M.score_table(M.prepared(scored(spark, rows)))
    assert M.roc_auc(st).first()["roc_auc"] == auc
    assert M.average_precision(st).first()["average_precision"] == ap


def test_no_scores(spark):
    assert M.roc_auc(M.score_table(M.prepared(scored(spark, [])))).first()["roc_auc"] == 0.5


def test_null_group_and_null_label_are_kept(spark):
    df = spark.createDataFrame([(None, 1, 0.9), (None, 0, 0.1), ("a", 1, 0.2), ("a", 0, 0.3)], "g string, label int, score double")
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(M.score_table(M.prepared(df, group_cols=["g"]), ["g"]), ["g"]).collect()}
    assert got == {None: 1.0, "a": 0.0}
    rows = spark.range(300).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 < 2, F.col("id") % 3).cast("int").alias("label"))
    assert T.stratified_split(rows).count() == 300


def test_gate(spark):
    df = FX.collisions(spark, SF_SMALL)
    with pytest.raises(V.ValidationError):
        V.validate_gate(df.drop("jet1_pt"))
    with pytest.raises(V.ValidationError):
        V.validate_gate(df.withColumn("extra", F.lit(float("inf"))))
    assert V.validate_gate(df).count() == df.count()
    bad = df.withColumn("lepton_pt", F.when(F.col("event_id") % 100 == 0, F.lit(-1.0)).otherwise(F.col("lepton_pt")))
    r = V.validation_report(bad, details=20).first()
    assert not r["passed"] and 0 < len(r["details"]) <= 20


def test_real_csv(spark):
    path = fresh_dir(spark, "csv")
    rows = [f"{y:.18e}," + ",".join(f"{i + y:.18e}" for i in range(len(S.FEATURES))) for y in (1, 0, 1)]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    got = IO.read_events_csv(spark, path, with_id=False)
    assert sorted(r["label"] for r in got.collect()) == [0, 1, 1]
    ids = sorted(r["event_id"] for r in got.collect())
    assert len(set(ids)) == 3 and ids == sorted(r["event_id"] for r in got.repartition(7).collect())
    bad = fresh_dir(spark, "csv")
    spark.createDataFrame([(rows[0].replace("1.0", "1.5", 1),)], "value string").write.text(bad)
    with pytest.raises(Exception, match="no integer"):
        IO.read_events_csv(spark, bad, with_id=False).collect()


def test_nested_settings():
    cfg = X.ETLConfig.from_dict({"paths": {"raw_dir": "x"}, "data": {
        "quality_cuts": {"apply": True, "lepton_pt_min": 25}, "split": {"train": 0.6, "val": 0.2, "test": 0.2},
        "normalization": "robust"}})
    assert (cfg.lepton_pt_min, cfg.train_frac, cfg.val_frac, cfg.normalization) == (25, 0.6, 0.2, "robust")
    with pytest.raises(ValueError):
        X.ETLConfig.from_dict({"data": {"quality_cuts": {"lepton_ptmin": 25}}})


def test_run_saves_and_skips(spark):
    root = fresh_dir(spark, "etl")
    df = FX.collisions(spark, SF_SMALL)
    v = X.run(spark, df, root)
    first = IO.read_json_marker(spark, f"{root}/{v}/_meta")["data"]
    assert X.run(spark, df.limit(0), root) == v and IO.latest_version(spark, root) == v
    assert IO.read_json_marker(spark, f"{root}/{v}/_meta")["data"] == first
    X.run(spark, df, root, force=True)
    assert IO.read_json_marker(spark, f"{root}/{v}/_meta")["data"] != first
    assert IO.read_split(spark, root).count() == IO.read_split(spark, root, v).count() > 0


def test_quantiles_inside_one_binade_slot(spark):
    df = spark.range(60000).select((F.lit(1000.0) + F.rand(1) * 0.1).alias("a"),
                                   F.when(F.col("id") % 2 == 0, -F.rand(2)).otherwise(F.lit(0.0)).alias("b"))
    df.write.parquet(path := fresh_dir(spark, "quantiles"))
    df = spark.read.parquet(path)
    q, p = quantile_wide(df, ["a", "b"], [0.25, 0.5, 0.75]).first(), df.toPandas()
    for c in ("a", "b"):
        assert [q[f"{c}__q{i}"] for i in (1, 2, 3)] == pytest.approx(np.quantile(p[c], [0.25, 0.5, 0.75]).tolist(), rel=1e-15)
