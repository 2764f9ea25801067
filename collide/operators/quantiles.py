"""Exact quantiles without holding or moving a whole column.

Spark's exact ``percentile`` keeps a map of every distinct value of a group
in one aggregation buffer, which cannot hold at scale.  Here every column
and probability is bracketed first:

1. one aggregate with mergeable sketches gives two values around every wanted
   rank (``SKETCH``: the rank error is at most 1 / SKETCH of the rows; the
   bracket leaves four times that on both sides).  Groups of at most ``SMALL``
   values take their minimum and maximum instead;
2. one aggregate counts the values below every bracket, so the wanted rank is known
   inside it;
3. only values inside a bracket (a few thousandths of the rows) are exchanged, counted per
   distinct value, and dealt into ``CELLS`` equal cells of the bracket; running counts over the
   cells and then inside the one cell that holds the rank find the value;
4. the result interpolates linearly between ranks floor(p(n-1)) and
   ceil(p(n-1)), exactly as ``percentile`` does.

A rank outside its bracket (which the sketch's bound rules out) fails the query rather than
giving a wrong value.  Null and NaN are skipped (pandas' notion of missing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH, SMALL, CELLS = 5000, 20_000, 4096
#: Brackets are broadcast to the rows of up to so many groups; beyond, they are joined by a shuffle.
MAX_GROUPS = 10_000


def few_groups(df: DataFrame, group_cols: Sequence[str], most: int = MAX_GROUPS) -> bool:
    """True if the group columns have at most ``most`` distinct values (one job over those columns only)."""
    return not group_cols or df.select(*group_cols).distinct().limit(most + 1).count() <= most


def _value(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _cell(v: Column, lo: Column, hi: Column) -> Column:
    """Cell of a value in its bracket: rises with the value; the edges have cells of their own."""
    width = hi - lo
    inner = F.least(F.greatest(F.floor((v - lo) / width * F.lit(float(CELLS))), F.lit(0)), F.lit(CELLS - 1)) + 1
    return (F.when(v <= lo, F.lit(0)).when(v >= hi, F.lit(CELLS + 1))
            .when((width > 0) & (width < float("inf")), inner).otherwise(F.lit(1))).cast("int")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), sketch: int = SKETCH, small: int = SMALL) -> DataFrame:
    """(group..., column, p, value): exact, linearly interpolated quantiles per group and column."""
    g, cols, ps = list(group_cols), list(columns), [float(p) for p in probs]
    key = F.struct(*[F.col(c) for c in g]) if g else F.struct(F.lit(0).alias("all"))
    long = df.select(key.alias("k"), F.posexplode(F.array(*[_value(c) for c in cols])).alias("i", "v")).where("v is not null")
    slack = 4.0 / sketch
    probes = [x for p in ps for x in (max(0.0, p - slack), min(1.0, p + slack))]
    v = F.col("v")
    sketched = long.groupBy("k", "i").agg(F.percentile_approx(v, probes, sketch).alias("q"), F.min(v).alias("a"), F.max(v).alias("z"),
                                          (F.count(v) <= small).alias("whole"))
    edges = [F.struct(F.when(F.col("whole") | F.lit(p <= slack), F.col("a")).otherwise(F.col("q")[2 * j]).alias("lo"),
                      F.when(F.col("whole") | F.lit(p >= 1.0 - slack), F.col("z")).otherwise(F.col("q")[2 * j + 1]).alias("hi"))
             for j, p in enumerate(ps)]
    bracket = sketched.select("k", "i", F.array(*edges).alias("e"))
    if few_groups(df, g):
        bracket = F.broadcast(bracket)  # a row per column and group
    held = long.join(bracket, ["k", "i"])

    counts = held.groupBy("k", "i").agg(F.count(v).alias("n"), *[
        F.sum((v < F.col("e")[j]["lo"]).cast("long")).alias(f"b{j}") for j in range(len(ps))])
    ranks = counts.select("k", "i", F.inline(F.array(*[F.struct(
        F.lit(j).alias("j"), (F.lit(p) * (F.col("n") - 1).cast("double")).alias("pos"), F.col(f"b{j}").alias("below"))
        for j, p in enumerate(ps)])))
    ranks = ranks.select("k", "i", "j", "pos", "below", F.explode(F.array_distinct(F.array(
        F.floor("pos").cast("long"), F.ceil("pos").cast("long")))).alias("r")) \
        .select("k", "i", "j", "pos", (F.col("r") - F.col("below")).alias("at"))

    inside = held.select("k", "i", "v", F.posexplode("e").alias("j", "e")).where("v between e.lo and e.hi") \
        .select("k", "i", "j", "v", "e.lo", "e.hi")
    own = ["k", "i", "j"]
    inside = inside.groupBy(*own, _cell(F.col("v"), F.col("lo"), F.col("hi")).alias("c"), "v").agg(F.count(F.lit(1)).alias("m"))
    cells = inside.groupBy(*own, "c").agg(F.sum("m").alias("cm"))
    upto = Window.partitionBy(*own).orderBy("c").rowsBetween(Window.unboundedPreceding, 0)  # at most CELLS + 2 rows
    cells = cells.select(*own, "c", "cm", F.sum("cm").over(upto).alias("upto"),
                         F.sum("cm").over(Window.partitionBy(*own)).alias("all"))
    missed = (F.col("at") < 0) | (F.col("at") >= F.col("all"))
    hit = (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("cm"))
    target = ranks.join(cells, own).where(F.when(missed, F.raise_error(F.lit("a rank lies outside its bracket")).cast("boolean"))
                                          .otherwise(hit))
    target = target.select(*own, "c", "pos", (F.col("at") - F.col("upto") + F.col("cm")).alias("at"))
    before = Window.partitionBy(*own, "c").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    values = (inside.join(target.select(*own, "c").distinct(), [*own, "c"], "left_semi")
              .withColumn("upto", F.sum("m").over(before)))
    found = (target.join(values, [*own, "c"]).where((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("m")))
             .groupBy(*own, "pos").agg(F.min("v").alias("lo"), F.max("v").alias("hi")))
    f, c = F.floor("pos"), F.ceil("pos")
    value = F.when(f == c, F.col("lo")).otherwise((c - F.col("pos")) * F.col("lo") + (F.col("pos") - f) * F.col("hi"))
    name, prob = F.array(*[F.lit(x) for x in cols]), F.array(*[F.lit(p) for p in ps])
    return found.select(*[F.col("k")[x].alias(x) for x in g], F.get(name, F.col("i")).alias("column"),
                        F.get(prob, F.col("j")).alias("p"), value.alias("value"))


def quantile_wide(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                  group_cols: Sequence[str] = (), sketch: int = SKETCH, small: int = SMALL) -> DataFrame:
    """One row per group with ``<column>__q<i>`` for each prob index i (bounded: columns x probs)."""
    g = list(group_cols)
    q = exact_quantiles(df, columns, probs, g, sketch, small)
    key = F.concat(F.col("column"), F.lit("__q"),
                   F.array_position(F.array(*[F.lit(float(p)) for p in probs]), F.col("p")).cast("string"))
    names = [f"{c}__q{i + 1}" for c in columns for i in range(len(probs))]
    return q.withColumn("name", key).groupBy(*g).pivot("name", names).agg(F.first("value"))
