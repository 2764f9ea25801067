"""Sampling, splitting and scaling.

Every random choice is a pure function of (seed, event_id) -- the md5
prefix hash of ``prefix.hash32`` -- so results do not depend on
partitioning, executor loss or re-execution order (unlike ``randomSplit``
or ``sample``).

* ``hash_split`` (default): hash threshold, no shuffle, stable as data grows.
* ``stratified_split``: exact per-label counts by the cut points of
  ``selection.classes``; no row is moved.
* ``balanced_sample``: exact per-class quotas, same cut points.

Scalers fit on the train rows with one aggregate (a bounded summary: a few
numbers per column) and apply as a pure projection with the parameters as
literals: no join, whole-stage codegen.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collide import schema as S
from collide.operators.prefix import hash32
from collide.operators.quantiles import quantile_wide
from collide.operators.selection import classes, stratum_sizes

SPLITS = ("train", "val", "test")


def hash_split(df: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15, seed: int = 42,
               key: str = S.EVENT_ID, out: str = "split") -> DataFrame:
    """T2 (default): split by u = hash/2^32 against cumulative fractions; row-local, no shuffle."""
    u = hash32(seed, key).cast("double") / F.lit(4294967296.0)
    split = (F.when(u < F.lit(train_frac), F.lit("train"))
             .when(u < F.lit(train_frac + val_frac), F.lit("val"))
             .otherwise(F.lit("test")))
    return df.withColumn(out, split)


def stratified_split(df: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15,
                     test_frac: float = 0.15, seed: int = 42, label: str = S.LABEL,
                     key: str = S.EVENT_ID, out: str = "split") -> DataFrame:
    """T2 (exact): per label stratum of size n, rows in hash order; the last
    ceil(n * (val+test)) go to the hold-out, whose last ceil(n_rest * (1 - val/(val+test)))
    are test, the rest val -- the counts of a two-stage stratified split.  Rows are decided in
    place; three small jobs over label and key find the cuts."""
    rest_frac = val_frac + test_frac
    test_rel = 1.0 - val_frac / rest_frac

    def ranks(_, n: int) -> list[int]:
        n_rest = math.ceil(n * rest_frac)
        return [n - n_rest, n - math.ceil(n_rest * test_rel)]
    d = classes(df, ranks, label, seed, key, "__class")
    names = F.array(*[F.lit(s) for s in SPLITS])
    return d.withColumn(out, F.get(names, F.col("__class"))).drop("__class")


def balanced_sample(df: DataFrame, n: int, seed: int = 42, label: str = S.LABEL,
                    key: str = S.EVENT_ID) -> DataFrame:
    """min(n//2, #signal) signal rows and min(n - n_signal, #background) background rows,
    without replacement, chosen by the (seed, key) hash; exact quotas, any partitioning, rows
    decided in place."""
    sizes = stratum_sizes(df, label)
    n_sig = min(n // 2, sizes.get(1, 0))
    quota = {1: n_sig, 0: min(n - n_sig, sizes.get(0, 0))}
    d = classes(df, lambda g, _: [quota.get(g, 0)], label, seed, key, "__class", sizes)
    return d.where("__class = 0").drop("__class")


def split_balance(df: DataFrame, split: str = "split", label: str = S.LABEL) -> DataFrame:
    """Rows and signal share per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                 F.avg(F.col(label).cast("double")).alias("signal_share"))


def split_summary(df: DataFrame, n_features: int, split: str = "split") -> DataFrame:
    """A2: n_train, n_val, n_test, n_features in one row (pivot over known values)."""
    p = df.groupBy().pivot(split, list(SPLITS)).count()
    return p.select(*[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(f"n_{s}") for s in SPLITS],
                    F.lit(n_features).alias("n_features"))


# --------------------------------------------------------------------------- scalers
@dataclass
class ScalerModel:
    """Fitted scaler: per column (center, scale).  Persisted beside the splits (Q11)."""
    method: str
    columns: list[str]
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.method == "none":
            return df
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
            for c in self.columns})

    def to_json(self) -> str:
        return json.dumps({"method": self.method, "columns": self.columns,
                           "center": self.center, "scale": self.scale}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> ScalerModel:
        d = json.loads(text)
        return ScalerModel(d["method"], d["columns"], d["center"], d["scale"])


SCALERS = ("standard", "robust", "minmax", "none")


def fit_params(train: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """One-row DataFrame of fitted parameters: ``c__center`` and ``c__scale`` per column.

    standard: mean and population std (zero -> 1); robust: median and
    q75 - q25 with linear interpolation (zero -> 1); minmax: min and
    max - min (zero -> 1, so a constant column maps to 0).
    """
    cols = list(columns)
    if method == "none":
        return train.sparkSession.range(1).select(F.lit(True).alias("none"))
    if method not in SCALERS:
        raise ValueError(f"Unknown normalization: {method}")
    if method == "robust":
        # exact quartiles without a whole column in one aggregation buffer
        q = quantile_wide(train, cols, [0.25, 0.5, 0.75])
        out = []
        for c in cols:
            iqr = F.col(f"{c}__q3") - F.col(f"{c}__q1")
            out += [F.col(f"{c}__q2").alias(f"{c}__center"),
                    F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias(f"{c}__scale")]
        return q.select(*out)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        if method == "standard":
            aggs += [F.avg(x).alias(f"{c}__center"), F.stddev_pop(x).alias(f"{c}__s")]
        else:
            aggs += [F.min(x).alias(f"{c}__center"), F.max(x).alias(f"{c}__hi")]
    one = train.agg(*aggs)
    out = []
    for c in cols:
        if method == "standard":
            s = F.col(f"{c}__s")
            out += [F.col(f"{c}__center"), F.when(s == 0, F.lit(1.0)).otherwise(s).alias(f"{c}__scale")]
        else:
            r = F.col(f"{c}__hi") - F.col(f"{c}__center")
            out += [F.col(f"{c}__center"), F.when(r == 0, F.lit(1.0)).otherwise(r).alias(f"{c}__scale")]
    return one.select(*out)


def fit_scaler(train: DataFrame, columns: Sequence[str], method: str = "standard") -> ScalerModel:
    """Fit on the train rows (one aggregate; the one-row result is the only thing collected)."""
    cols = list(columns)
    if method == "none":
        return ScalerModel("none", cols)
    row = fit_params(train, cols, method).first()
    return ScalerModel(method, cols, {c: float(row[f"{c}__center"]) for c in cols},
                       {c: float(row[f"{c}__scale"]) for c in cols})


def scale_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range of column means and (sample) stds after scaling, one pass."""
    cols = list(columns)
    one = df.agg(*[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(F.col(c)).alias(f"s{i}") for i, c in enumerate(cols)])
    return one.select(F.least(*[F.col(f"m{i}") for i in range(len(cols))]).alias("mean_min"),
                      F.greatest(*[F.col(f"m{i}") for i in range(len(cols))]).alias("mean_max"),
                      F.least(*[F.col(f"s{i}") for i in range(len(cols))]).alias("std_min"),
                      F.greatest(*[F.col(f"s{i}") for i in range(len(cols))]).alias("std_max"))


def class_weights(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """T9: 'balanced' weights n / (n_classes * n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy(F.lit(0))
    return counts.select(label, F.col("n_class").cast("bigint").alias("n_class"),
                         (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"))
