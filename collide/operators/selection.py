"""Exact selection by hash rank without moving rows.

Rows of every stratum are ordered by (hash of seed and key, key).  The wanted
ranks of a stratum are turned into cut points -- the (hash, key) pair that
stands at the rank -- and every row is then decided in place by comparing its own
pair with them:

1. a histogram of the leading 16 bits of the hash per stratum tells the one bucket
   in which each rank lies (only stratum and key are read);
2. the pairs of those buckets alone, 1/65536 of a stratum each, are ranked;
3. the cuts, a few values per stratum, are broadcast to the rows.

No row of the input takes part in an exchange.  A key is meant to be unique;
rows that repeat the very key at a cut, and only those, are numbered among
themselves by the hash of their content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide.operators.prefix import hash32, hash_rank

#: Strata whose cuts may be broadcast.
MAX_STRATA = 10_000


def _hash(seed: int, key: str) -> Column:
    return F.coalesce(hash32(seed, key), F.lit(-1))  # rows without a key come first


def stratum_sizes(df: DataFrame, stratum: str) -> dict:
    """Rows per stratum (at most ``MAX_STRATA`` of them)."""
    rows = df.groupBy(F.col(stratum).alias("g")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    return {r["g"]: r["n"] for r in rows}


def _cuts(df: DataFrame, ranks: list[tuple], stratum: str, seed: int, key: str) -> list[tuple]:
    """(stratum, i, hash, key, take, of): the pair at each wanted rank, how many of its rows lie within the rank,
    and how many rows it has.  ``ranks`` are (stratum, i, rank) with ranks of one row or more."""
    spark, kind = df.sparkSession, df.schema[stratum].dataType
    narrow = df.select(F.struct(F.col(stratum).alias("g")).alias("s"), _hash(seed, key).alias("h"), F.col(key).alias("key"))
    narrow = narrow.withColumn("b", F.shiftright("h", 16))
    wanted = spark.createDataFrame([((g,), i, r) for g, i, r in ranks], T.StructType([
        T.StructField("s", T.StructType([T.StructField("g", kind)])), T.StructField("i", T.IntegerType()),
        T.StructField("r", T.LongType())]))
    upto = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)  # at most 65537 buckets
    hist = narrow.groupBy("s", "b").agg(F.count(F.lit(1)).alias("c")).withColumn("upto", F.sum("c").over(upto))
    where = (hist.join(F.broadcast(wanted), "s").where((F.col("r") <= F.col("upto")) & (F.col("r") > F.col("upto") - F.col("c")))
             .select("s", "b", "i", (F.col("r") - F.col("upto") + F.col("c")).alias("r")))
    rows = where.collect()  # one row per wanted rank
    target = spark.createDataFrame(rows, where.schema)
    pairs = (narrow.join(F.broadcast(target.select("s", "b").distinct()), ["s", "b"], "left_semi")
             .groupBy("s", "b", "h", "key").agg(F.count(F.lit(1)).alias("m")))
    order = Window.partitionBy("s", "b").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, 0)
    found = (pairs.withColumn("upto", F.sum("m").over(order)).join(F.broadcast(target), ["s", "b"])
             .where((F.col("r") <= F.col("upto")) & (F.col("r") > F.col("upto") - F.col("m"))))
    return [(x["s"]["g"], x["i"], x["h"], x["key"], x["r"] - x["upto"] + x["m"], x["m"])
            for x in found.select("s", "i", "h", "key", "r", "upto", "m").collect()]


def classes(df: DataFrame, ranks: Callable[[object, int], list[int]], stratum: str, seed: int, key: str,
            out: str, sizes: dict | None = None) -> DataFrame:
    """``df`` plus ``out``: 0 for the first ranks[0] rows of the stratum in hash order, 1 for the rows up to
    ranks[1], and so on.  ``ranks`` gives the rising ranks of a stratum from its value and size."""
    sizes = stratum_sizes(df, stratum) if sizes is None else sizes
    per = {g: ranks(g, n) for g, n in sizes.items()}
    width = max((len(r) for r in per.values()), default=0)
    if not width:
        return df.withColumn(out, F.lit(0))
    cuts = _cuts(df, [(g, i, r) for g, rs in per.items() for i, r in enumerate(rs) if r > 0], stratum, seed, key)
    own: dict = {g: [None] * width for g in per}
    for g, i, h, k, take, of in cuts:
        own[g][i] = (h, k, take, of)
    cell = T.StructType([T.StructField("h", T.LongType()), T.StructField("key", df.schema[key].dataType),
                         T.StructField("take", T.LongType()), T.StructField("of", T.LongType())])
    table = df.sparkSession.createDataFrame(
        [((g,), c) for g, c in own.items()], T.StructType([
            T.StructField("__s", T.StructType([T.StructField("g", df.schema[stratum].dataType)])),
            T.StructField("__cut", T.ArrayType(cell))]))
    rows = (df.withColumn("__s", F.struct(F.col(stratum).alias("g"))).withColumn("__h", _hash(seed, key))
            .join(F.broadcast(table), "__s"))  # at most MAX_STRATA rows
    h, k = F.col("__h"), F.col(key)

    def less(c: Column) -> Column:
        return (h < c["h"]) | ((h == c["h"]) & F.coalesce(k < c["key"], F.lit(False)))

    def tie(c: Column) -> Column:
        return (h == c["h"]) & k.eqNullSafe(c["key"])

    def number(within: Callable[[Column], Column]) -> Column:
        total = F.lit(0)
        for i in range(width):
            total = total + F.coalesce(within(F.col("__cut")[i]), F.lit(False)).cast("int")
        return F.lit(width) - total

    helpers = ["__s", "__h", "__cut"]
    sure = rows.withColumn(out, number(lambda c: less(c) | (tie(c) & (c["take"] == c["of"])))).drop(*helpers)
    if all(take == of for *_, take, of in cuts):
        return sure
    unsure = F.lit(False)
    for i in range(width):
        c = F.col("__cut")[i]
        unsure = unsure | F.coalesce(tie(c) & (c["take"] < c["of"]), F.lit(False))
    tied = rows.where(unsure).withColumn("__c", F.xxhash64(*[F.col(c) for c in df.columns]).bitwiseAND(F.lit(0xFFFFFFFF)))
    tied = hash_rank(tied, "__c", "__c", [stratum, key])
    tied = tied.withColumn(out, number(lambda c: less(c) | (tie(c) & (F.col("__rank") <= c["take"]))))
    rest = rows.where(~unsure).withColumn(out, number(lambda c: less(c) | (tie(c) & (c["take"] == c["of"])))).drop(*helpers)
    return rest.unionByName(tied.drop(*helpers, "__c", "__rank", "__n"))
