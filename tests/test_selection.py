"""Selection in place (T1, T2), bracketed quantiles, H_T of one event."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from collide.functions import kinematics as K
from collide.operators import features as D
from collide.operators import prefix as PX
from collide.operators import prepare as T
from collide.operators import quantiles as Q
from collide.session import fresh_dir


def stored(spark, df):
    path = fresh_dir(spark, "sel")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_selection_moves_no_row(spark):
    df = stored(spark, spark.range(20000).select(F.col("id").alias("event_id"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                                 F.rand(1).alias("lepton_pt")))
    for out in (T.stratified_split(df), T.balanced_sample(df, 3000)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "SinglePartition" not in plan
    h = df.withColumn("h", PX.hash32(42, "event_id")).toPandas()
    want = {}
    for _, g in h.groupby("label"):
        ids = g.sort_values(["h", "event_id"]).event_id.tolist()
        rest = math.ceil(len(ids) * 0.3)
        test = math.ceil(rest * 0.5)
        want |= dict.fromkeys(ids[:len(ids) - rest], "train") | dict.fromkeys(ids[len(ids) - rest:len(ids) - test], "val")
        want |= dict.fromkeys(ids[len(ids) - test:], "test")
    assert {r["event_id"]: r["split"] for r in T.stratified_split(df).collect()} == want


def test_selection_with_repeated_and_missing_keys(spark):
    """Counts stay exact if keys repeat or are missing: 5000 rows without a key, 3000 of one key."""
    rows = spark.range(9000).select(
        F.when(F.col("id") < 5000, F.lit(None)).when(F.col("id") < 8000, F.lit(7)).otherwise(F.col("id")).cast("long").alias("event_id"),
        F.lit(1).alias("label"), (F.col("id") % 11).cast("double").alias("x"))
    df = stored(spark, rows.union(rows.withColumn("label", F.lit(None).cast("int"))).union(rows.limit(50).withColumn("label", F.lit(0))))
    got = {(r["label"], r["split"]): r["count"] for r in T.stratified_split(df).groupBy("label", "split").count().collect()}
    for label, n in ((1, 9000), (None, 9000), (0, 50)):
        rest = math.ceil(n * 0.3)
        test = math.ceil(rest * 0.5)
        assert [got[label, s] for s in T.SPLITS] == [n - rest, rest - test, test]
    picked = {r["label"]: r["count"] for r in T.balanced_sample(df, 6000).groupBy("label").count().collect()}
    assert picked == {1: 3000, 0: 50}
    assert T.stratified_split(df.limit(0)).count() == 0 and T.balanced_sample(df.limit(0), 10).count() == 0


def test_brackets_give_exact_quantiles(spark):
    """Large groups go through the sketch's brackets: ties, infinities, missing values, null groups."""
    n = 120_000
    df = stored(spark, spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("g"),
        F.rand(3).alias("u"), F.randn(4).cast("float").alias("f"), (F.floor(F.rand(5) * 4)).cast("int").alias("ties"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.exp(F.randn(6) * 50)).alias("holes"),
        F.when(F.col("id") % 4 == 0, F.lit(float("inf"))).when(F.col("id") % 4 == 1, F.lit(float("-inf"))).otherwise(F.randn(7)).alias("ends")))
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    cols = ["u", "f", "ties", "holes"]
    pdf = df.toPandas()
    for small in (100, 1_000_000):
        got = {(r["g"], r["column"], r["p"]): r["value"] for r in Q.exact_quantiles(df, cols, ps, ["g"], small=small).collect()}
        for g, part in ((None, pdf[pdf.g.isna()]), (1, pdf[pdf.g == 1]), (2, pdf[pdf.g == 2])):
            for c in cols:
                v = part[c].astype(float).dropna().to_numpy()
                for p in ps:
                    assert got[g, c, p] == pytest.approx(np.quantile(v, p), rel=1e-12, abs=1e-300), (g, c, p)
        ends = Q.quantile_wide(df, ["ends"], [0.1, 0.5, 0.9], small=small).first()
        assert ends["ends__q1"] == float("-inf") and ends["ends__q3"] == float("inf")
        assert ends["ends__q2"] == pytest.approx(np.quantile(pdf.ends, 0.5))
    assert Q.exact_quantiles(df.limit(0), ["u"], [0.5]).collect() == []


def test_fill_reads_medians_of_columns_with_holes_only(spark):
    df = stored(spark, spark.range(4000).select(F.col("id").alias("event_id"), (F.col("id") % 2).cast("string").alias("split"),
                                                F.col("id").cast("double").alias("whole"),
                                                F.when(F.col("id") % 4 < 2, F.col("id").cast("float")).alias("holes")))
    out = D.fill(df, "median")
    assert "__med_1" not in out._jdf.queryExecution().optimizedPlan().toString()
    got, pdf = out.toPandas(), df.toPandas().sort_values("event_id")
    want = pdf.holes.fillna(pdf.groupby("split").holes.transform("median"))
    assert got.sort_values("event_id").holes.tolist() == want.tolist()
    assert D.fill(df.select("event_id", "split", "whole"), "median").columns == ["event_id", "split", "whole"]


def test_ht_of_one_event(spark):
    df = spark.createDataFrame([([30.0, float("nan"), -5.0, 0.0, 12.5, None],), ([],), ([float("nan")],)], "pts array<double>")
    assert [r[0] for r in df.select(K.ht_event("pts")).collect()] == [42.5, 0.0, 0.0]
