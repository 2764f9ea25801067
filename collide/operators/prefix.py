"""Exact distributed running sums and ranks without a one-task window.

A window ordered over a whole table (``Window.orderBy(x)`` with no
partition) runs in a single task.  Both helpers here split the order key
into buckets that are monotone in the key, so:

1. per-bucket totals form a small table (bounded by the number of buckets,
   not by the data), whose exclusive running sum is cheap;
2. that table is broadcast back (its size bound is the bucket count);
3. the exact running value inside each bucket is a window partitioned by
   the bucket, so the work spreads over all tasks.

``cumulative`` buckets a DOUBLE key by its binary exponent and the top
``bits`` mantissa bits; for FLOAT-valued keys (scores are FLOAT, as in the
reference) a bucket holds at most 2^(23-bits) distinct values, so no bucket
can grow with the data.  ``hash_rank`` buckets a 32-bit hash by its top
bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ZERO_BUCKET = -1100
_NEG_SHIFT = -3000
_POS_INF = 4000
_NEG_INF = -5000
_NAN = 5000


def monotone_bucket(x: Column, bits: int = 8) -> Column:
    """Bucket id (BIGINT) that is non-decreasing in ``x`` under Spark's order (NaN last).

    bucket = e * K + floor((x / 2^e - 1) * K) with e = floor(log2 |x|), K = 2^bits.
    An off-by-one ``e`` from rounding in log2 gives the same bucket, so the
    map stays monotone.  Zero, negatives, +-inf and NaN get fixed bands.
    """
    k = float(2 ** bits)
    x = x.cast("double")
    ax = F.abs(x)
    e = F.floor(F.log2(ax))
    pos = e * F.lit(k) + F.floor((ax / F.pow(F.lit(2.0), e) - F.lit(1.0)) * F.lit(k))
    return (F.when(F.isnan(x), F.lit(_NAN * k))
            .when(x == F.lit(float("inf")), F.lit(_POS_INF * k))
            .when(x == F.lit(float("-inf")), F.lit(_NEG_INF * k))
            .when(x == F.lit(0.0), F.lit(_ZERO_BUCKET * k))
            .when(x > F.lit(0.0), pos)
            .otherwise(F.lit(_NEG_SHIFT * k) - pos)).cast("bigint")


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on ``keys`` where null meets null (no row with a null key is lost).  The right side is
    bounded, and broadcast, only without group columns (one key); else the optimizer decides."""
    named = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for c in keys:
        same = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        on = same if on is None else on & same
    named = F.broadcast(named) if len(keys) == 1 else named
    return left.join(named, on, "inner").drop(*[f"__r_{c}" for c in keys])


def cumulative(df: DataFrame, order_col: str, value_cols: Sequence[str], group_cols: Sequence[str] = (),
               descending: bool = True, bits: int = 8) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_col`` order, per group.

    ``df`` must have one row per (group, order value) -- e.g. the output of
    ``groupBy(group, score)``.  Adds ``cum_<v>`` (running, inclusive) and
    ``tot_<v>`` (group total) for every value column.
    """
    g = list(group_cols)
    b = monotone_bucket(F.col(order_col), bits)
    d = df.withColumn("__b", -b if descending else b)
    totals = d.groupBy(*g, "__b").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    w_prev = (Window.partitionBy(*g).orderBy("__b") if g else Window.orderBy("__b")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    offsets = totals.select(
        *g, "__b",
        *[F.coalesce(F.sum(f"__t_{v}").over(w_prev), F.lit(0)).alias(f"__o_{v}") for v in value_cols],
        *[F.sum(f"__t_{v}").over(w_all).alias(f"tot_{v}") for v in value_cols])
    # one row per populated bucket (at most ~2^bits per binade) and group
    joined = _meet(d, offsets, [*g, "__b"])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w_in = Window.partitionBy(*g, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *df.columns,
        *[(F.sum(v).over(w_in) + F.col(f"__o_{v}")).alias(f"cum_{v}") for v in value_cols],
        *[F.col(f"tot_{v}") for v in value_cols])


def hash32(seed: int | str, key: Column | str) -> Column:
    """Deterministic 32-bit hash of (seed, key): first 8 hex digits of md5('seed|key') as BIGINT.

    Equal in DuckDB as ('0x' || substr(md5(seed || '|' || key), 1, 8))::bigint.
    """
    k = F.col(key) if isinstance(key, str) else key
    s = F.md5(F.concat(F.lit(f"{seed}|"), k.cast("string")))
    return F.conv(F.substring(s, 1, 8), 16, 10).cast("bigint")


def hash_rank(df: DataFrame, hash_col: str, tie_col: str, group_cols: Sequence[str] = (),
              shift: int = 16) -> DataFrame:
    """Exact 1-based rank of each row by (hash, tie) within its group, plus the group size.

    Adds ``__rank`` and ``__n``.  Buckets are ``hash >> shift`` (at most
    2^(32-shift) per group), so the broadcast offsets table is bounded and
    the in-bucket windows are spread over all tasks.
    """
    g = list(group_cols)
    d = df.withColumn("__hb", F.shiftright(F.col(hash_col), shift))
    counts = d.groupBy(*g, "__hb").agg(F.count(F.lit(1)).alias("__c"))
    w_prev = (Window.partitionBy(*g).orderBy("__hb") if g else Window.orderBy("__hb")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    offsets = counts.select(*g, "__hb", F.coalesce(F.sum("__c").over(w_prev), F.lit(0)).alias("__off"),
                            F.sum("__c").over(w_all).alias("__n"))
    joined = _meet(d, offsets, [*g, "__hb"])
    w_in = Window.partitionBy(*g, "__hb").orderBy(F.col(hash_col), F.col(tie_col))
    return joined.withColumn("__rank", F.row_number().over(w_in) + F.col("__off")) \
        .drop("__hb", "__off")
