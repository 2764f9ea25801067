"""Neighbours by grid cells and triples of large jets (N3, L8, J5), for groups that are too large for one row.

``jets.knn_edges`` ranks all nodes of an event inside its row, and ``jets.ecf`` sums all triples there: right for jets of
tens of constituents.  Here nothing grows with the square of a group inside a row or a task.

Neighbours.  The plane is cut into cells at several levels; at level L a cell's side is ``span / 2^L``.  A node
searches at the finest level at which its own cell holds more than k nodes.  Then k others lie within the cell's
diagonal (1.42 sides), whereas whatever lies outside the two rings around the cell is more than two sides away: the 25
cells hold all k nearest nodes, ties included.  A cell one level finer holds k nodes at most, so at most 16 k positions of a cell search
at its level, and a cell is searched from 25 cells: the candidates of a level are at most 400 k times the nodes.  Nodes at
one position count k + 1 times at most as candidates (those with the smallest numbers), which changes no result.
The span is that of all nodes: where the nodes of a group differ by less than 2^-24 of it, they share the finest cell
and are compared with one another (the result is exact there too, the work is not linear).

Groups of at most ``SMALL`` nodes are searched whole, each in one Arrow table after one exchange by the key: at most ``SMALL``
comparisons a node, and no copies of the nodes per level.  Only larger groups are cut into cells.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide.operators import jets as J

LEVELS = tuple(range(0, 25, 2))  # sides from the whole span down to 2^-24 of it
RINGS = 2
SMALL = 1024  # nodes of a group that is searched whole


def _finite(c: str):
    x = F.col(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def knn_cells(nodes: DataFrame, k: int, key: str = "event_id", node: str = "idx", c1: str = "eta", c2: str = "phi",
              wrap: bool = False, carry: tuple[str, ...] = (), small: int = SMALL) -> DataFrame:
    """N3 for groups of any size: (key, src, dst, rank, d2) of the k nearest nodes of every node within its key.

    One input row per node; (``key``, ``node``) names it.  Ties go to the smaller ``node``.  With ``wrap`` the
    second coordinate is an angle: its difference is taken around the circle.  A node whose coordinate is null,
    NaN or infinite has no neighbours and is none; a node alone has none; with fewer than k others all are given.  Rows of a null
    key form no group.  ``carry`` adds ``x_<c>`` of the node and ``y_<c>`` of the neighbour.  Groups of more than
    ``small`` nodes go by cells; one row (their span) comes to the driver.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    flat = nodes.where(_finite(c1) & _finite(c2) & F.col(key).isNotNull() & F.col(node).isNotNull()).select(
        F.col(key).alias("g"), F.col(node).alias("i"), F.col(c1).cast("double").alias("u"),
        (F.pmod(F.col(c2).cast("double"), F.lit(2 * math.pi)) if wrap else F.col(c2).cast("double")).alias("v"),
        *[F.col(c).alias(f"y_{c}") for c in carry])
    sizes = flat.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > small).select("g")
    if large.isEmpty():
        out = _whole_groups(flat, k, wrap, carry)
    else:
        out = _whole_groups(flat.join(large, "g", "left_anti"), k, wrap, carry).unionByName(
            _by_cells(flat.join(large, "g", "left_semi"), k, wrap, carry))
    return out.withColumnRenamed("g", key)


def _whole_groups(flat: DataFrame, k: int, wrap: bool, carry: tuple[str, ...]) -> DataFrame:
    """(g, src, dst, rank, d2, ...) of groups that fit a table each: every node is compared with all of its group."""
    kind = {f.name: f.dataType for f in flat.schema.fields}
    schema = T.StructType([T.StructField("g", kind["g"]), T.StructField("src", kind["i"]), T.StructField("dst", kind["i"]),
                           T.StructField("rank", T.IntegerType()), T.StructField("d2", T.DoubleType()),
                           *[T.StructField(f"{s}_{c}", kind[f"y_{c}"]) for s in "xy" for c in carry]])

    def search(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("i")
        u, v, n = t["u"].to_numpy(), t["v"].to_numpy(), t.num_rows
        name = np.empty(n, np.int64)  # number of the node's name: rows may share one
        name[:] = pc.rank(t["i"], tiebreaker="dense").to_numpy()
        found = []
        for lo in range(0, n, 256):
            with np.errstate(over="ignore"):
                dv = v[lo:lo + 256, None] - v
                if wrap:
                    dv = np.abs(dv)
                    dv = np.minimum(dv, 2 * math.pi - dv)
                d2 = (u[lo:lo + 256, None] - u) ** 2 + dv * dv
            other = name[lo:lo + 256, None] != name
            d2[~other] = np.inf
            at = other if n <= k else other & (d2 <= np.partition(d2, k - 1, axis=1)[:, k - 1:k])
            src, dst = np.nonzero(at)
            found.append((src + lo, dst, d2[src, dst]))
        src, dst, d2 = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((dst, d2, name[src]))
        own = name[src[order]]
        first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
        rank = np.arange(len(own)) - np.flatnonzero(first)[np.cumsum(first) - 1] + 1 if len(own) else np.zeros(0, np.int64)
        best = order[rank <= k]
        a, b = pa.array(src[best]), pa.array(dst[best])
        cols = [t["g"].take(a), t["i"].take(a), t["i"].take(b), pa.array(rank[rank <= k].astype(np.int32)), pa.array(d2[best])]
        cols += [t[f"y_{c}"].take(x) for x in (a, b) for c in carry]
        return pa.table(cols, names=names)
    names = schema.names
    return flat.groupBy("g").applyInArrow(search, schema)


def _by_cells(flat: DataFrame, k: int, wrap: bool, carry: tuple[str, ...]) -> DataFrame:
    """(g, src, dst, rank, d2, ...) of groups of any size."""
    lo1, hi1, lo2, hi2 = flat.agg(F.min("u"), F.max("u"), F.min("v"), F.max("v")).first()
    if lo1 is None:  # no node
        lo1 = hi1 = lo2 = hi2 = 0.0
    span, turns = max(hi1 - lo1, hi2 - lo2) * 1.0001 or 1.0, 0
    if wrap:  # sides divide the circle
        lo2, turns = 0.0, max(0, math.ceil(math.log2(max(span / (2 * math.pi), 1.0))))
        span = 2 * math.pi * 2.0 ** turns

    def cell(x: str, low: float, side):
        return F.floor((F.col(x) - F.lit(low)) / side)

    level = F.explode(F.array(*[F.lit(lv) for lv in LEVELS])).alias("lv")
    side = F.lit(span) / F.pow(F.lit(2.0), F.col("lv"))
    cells = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.col("lv") - F.lit(turns))).cast("long")  # around the circle
    a, b = cell("u", lo1, side).alias("a"), cell("v", lo2, side)
    b = (F.pmod(b, cells) if wrap else b).alias("b")

    same = Window.partitionBy("g", "u", "v").orderBy("i")
    points = flat.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth")
    points = points.select("*", level).select("*", a, b)
    # Only cells of k nodes at most are looked up: the finest level of a node is the one before its first sparse cell.
    sparse = points.groupBy("g", "lv", "a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= k).drop("n")
    levels = flat.select("g", "i", "u", "v", level).select("*", a, b)
    first = levels.join(sparse, ["g", "lv", "a", "b"], "left_semi").groupBy("g", "i").agg(F.min("lv").alias("first"))
    step = LEVELS[1] - LEVELS[0]
    asks = flat.join(first, ["g", "i"], "left").withColumn(
        "lv", F.greatest(F.lit(LEVELS[0]), F.coalesce(F.col("first") - F.lit(step), F.lit(LEVELS[-1])))).drop("first")
    asks = asks.select(F.col("g"), F.col("i").alias("src"), F.col("u").alias("x1"), F.col("v").alias("x2"),
                       *[F.col(f"y_{c}").alias(f"x_{c}") for c in carry], "lv", a, b, cells.alias("around"))
    offsets = [F.lit(o) for o in range(-RINGS, RINGS + 1)]
    near1 = F.transform(F.array(*offsets), lambda o: F.col("a") + o)
    near2 = F.transform(F.array(*offsets), lambda o: F.col("b") + o)
    if wrap:
        near2 = F.array_distinct(F.transform(F.array(*offsets), lambda o: F.pmod(F.col("b") + o, F.col("around"))))
    asks = asks.withColumn("na", F.explode(near1)).withColumn("b", F.explode(near2)).withColumn("a", F.col("na").cast("long")).drop("na", "around")

    dv = F.col("x2") - F.col("v")
    if wrap:
        dv = F.abs(dv)
        dv = F.least(dv, F.lit(2 * math.pi) - dv)
    pairs = asks.join(points, ["g", "lv", "a", "b"]).where(F.col("src") != F.col("i"))
    pairs = pairs.withColumn("d2", F.pow(F.col("x1") - F.col("u"), 2) + F.pow(dv, 2))
    order = Window.partitionBy("g", "src").orderBy("d2", "i")
    best = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("g", "src", F.col("i").alias("dst"), "rank", "d2",
                       *[f"x_{c}" for c in carry], *[f"y_{c}" for c in carry])


def edge_features_cells(nodes: DataFrame, k: int, feats: tuple[str, ...] = ("pt", "eta", "phi"), key: str = "event_id",
                        node: str = "idx", c1: str = "eta", c2: str = "phi", wrap: bool = False) -> DataFrame:
    """L8 for groups of any size: per node h_i and max over its k nearest of (h_j - h_i), averaged over the nodes.

    A node without neighbours counts 0 for the maxima, a missing feature 0 for the means, as in
    ``jets.edge_features``.  One row per key that is not null.
    """
    edges = knn_cells(nodes, k, key, node, c1, c2, wrap, feats)
    tops = edges.groupBy(key, "src").agg(*[F.max(F.col(f"y_{f}") - F.col(f"x_{f}")).alias(f"m_{f}") for f in feats])
    sums = tops.groupBy(key).agg(*[F.sum(F.coalesce(F.col(f"m_{f}"), F.lit(0.0))).alias(f"m_{f}") for f in feats])
    own = nodes.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(F.coalesce(F.col(f).cast("double"), F.lit(0.0))).alias(f"s_{f}") for f in feats])
    both = own.join(sums, key, "left")
    return both.select(key, *[(F.col(f"s_{f}") / F.col("__n")).alias(f"mean_{f}") for f in feats],
                       *[(F.coalesce(F.col(f"m_{f}"), F.lit(0.0)) / F.col("__n")).alias(f"mean_max_d_{f}") for f in feats])


# --------------------------------------------------------------------------- J5, large jets
def ecf3_spread(df: DataFrame, jet_col: str = "jet", key: str = "event_id", beta: float = 1.0, large: int = 128,
                triples: int = 2_000_000) -> DataFrame:
    """J5 as (key, ecf3): a jet of more than ``large`` constituents is summed by several tasks.

    Such a jet's leading indices are dealt to blocks (index modulo the number of blocks, so that each holds long and short rests)
    of about ``triples`` triples, at most one block per index; blocks are spread over the tasks and their sums added.  The others are
    summed in their row.  ``key`` must name the jet; the value is that of ``jets.ecf(jet, 3, beta)`` up to the order of addition.
    """
    spark, j = df.sparkSession, F.col(jet_col)
    size = F.coalesce(F.size(j), F.lit(0))
    small = df.where(size <= large).select(key, J.ecf(j, 3, beta).alias("ecf3"))
    n = size.cast("double")
    blocks = F.least(size, F.ceil(n * (n - 1) * (n - 2) / F.lit(6.0 * triples)).cast("int"))
    wide = df.where(size > large).select(key, j.alias("jet"), blocks.alias("blocks"))
    wide = wide.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # blocks are small in bytes and long in work, so their number of tasks is given, not found from bytes
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    part = J.ecf3_sum(F.col("jet"), beta, lambda i: F.pmod(i, F.col("blocks")) == F.col("block"))
    pt = F.when(F.col("block") == 0, J.pt_sum(F.col("jet")))
    sums = (wide.repartition(tasks, key, "block").select(key, part.alias("part"), pt.alias("pt"))
            .groupBy(key).agg(F.sum("part").alias("total"), F.max("pt").alias("pt")))
    value = F.when(F.col("pt") < F.lit(1e-10), F.lit(None).cast("double")).otherwise(F.col("total") / (F.col("pt") * F.col("pt") * F.col("pt")))
    return small.unionByName(sums.select(key, value.alias("ecf3")))
