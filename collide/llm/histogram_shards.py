"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until the
splitters meet their tolerance, then one exchange.

Sort key: (64-bit hash of the text, id), so equal texts are neighbours and a group larger
than a shard can still be cut between ids.  A narrow table (hash, id, size) is staged once.
Each round sends a sorted list of probe keys; the tasks return rows, bytes and the smallest
and largest key of every interval between probes (partial sums first); intervals that hold
an unmet target get new probes inside their occupied range.  Targets are the shard limits
(tight tolerance) and the limits of equal pieces inside them (loose tolerance), so that the
one exchange deals pieces of bounded size whatever the keys are.

Law: bytes.  Shard sizes differ from total / shards by at most ``tolerance`` of it on either
limit, or by what one row or one run of rows with the same hash and id weighs.  Inside the
tolerance a limit between two texts is preferred to one inside a group of equal texts.

Defined results: null text counts 0 bytes and sorts as the empty text; null ids sort first;
an empty table has no rows; rows that agree in text and id stay together in one shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collide.llm.common import staged

SHARDS = 8
TOLERANCE = 0.001
FIRST_PROBES, PROBES = 4096, 32
MIN_ID = -(1 << 63)


def key_columns(key: Column, text: Column) -> tuple[Column, Column]:
    """The sort key: hash of the text and id, nulls defined."""
    return F.xxhash64(F.coalesce(text, F.lit(""))), F.coalesce(key.cast("long"), F.lit(MIN_ID))


def size_column(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def below(ph: np.ndarray, pi: np.ndarray, h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Number of probes (sorted by hash, then id) that are <= each key."""
    at = np.searchsorted(ph, h, side="right")
    lo = np.searchsorted(ph, h, side="left")
    tie = np.flatnonzero(at > lo)
    for v in np.unique(h[tie]):
        rows = tie[h[tie] == v]
        a, b = np.searchsorted(ph, v, side="left"), np.searchsorted(ph, v, side="right")
        at[rows] = a + np.searchsorted(pi[a:b], i[rows], side="right")
    return at


@dataclass
class Splitters:
    """Piece limits in key order; piece p has limit[p-1] <= key < limit[p]."""

    h: np.ndarray
    i: np.ndarray
    shard: np.ndarray      # of each piece
    start: np.ndarray      # rows of the same shard before each piece
    rounds: int


_HIST = "b long, n long, s long, lo_h long, lo_i long, hi_h long, hi_i long"


def histogram(keys: DataFrame, ph: np.ndarray, pi: np.ndarray) -> pd.DataFrame:
    """Rows, bytes and extreme keys of every interval between probes; at most one row per probe."""
    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf):
                b = below(ph, pi, pdf["h"].to_numpy(), pdf["i"].to_numpy())
                g = pdf.assign(b=b).sort_values(["b", "h", "i"], kind="stable").groupby("b")
                yield g.agg(n=("s", "size"), s=("s", "sum"), lo_h=("h", "first"), lo_i=("i", "first"),
                            hi_h=("h", "last"), hi_i=("i", "last")).reset_index()

    lo, hi = F.min(F.struct("lo_h", "lo_i")).alias("lo"), F.max(F.struct("hi_h", "hi_i")).alias("hi")
    return (keys.mapInPandas(count, _HIST).groupBy("b").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), lo, hi)
            .select("b", "n", "s", "lo.*", "hi.*").orderBy("b").toPandas())


def _between(lo: tuple[int, int], hi: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """About n keys spread over (lo, hi]: between hashes first, inside one hash between ids."""
    if lo[0] < hi[0]:
        step = max(1, (hi[0] - lo[0]) // n)
        return [(x, MIN_ID) for x in range(lo[0] + 1, hi[0] + 1, step)][:2 * n] + [(hi[0], MIN_ID)]
    step = max(1, (hi[1] - lo[1]) // n)
    return [(lo[0], x) for x in range(lo[1] + 1, hi[1] + 1, step)][:2 * n] + [(lo[0], hi[1])]


def find_splitters(keys: DataFrame, shards: int = SHARDS, pieces: int = 1, tolerance: float = TOLERANCE) -> Splitters:
    """Refine probes over the staged (h, i, s) table until every target is met or cannot be met better."""
    space = 1 << 64
    probes = {(-(space >> 1) + space * k // FIRST_PROBES, MIN_ID) for k in range(1, FIRST_PROBES)}
    rounds = 0
    while True:
        rounds += 1
        order = sorted(probes)
        ph = np.array([p[0] for p in order], np.int64)
        pi = np.array([p[1] for p in order], np.int64)
        hist = histogram(keys, ph, pi)
        rows, size = np.zeros(len(order) + 1, np.int64), np.zeros(len(order) + 1, np.int64)
        at = hist["b"].to_numpy(np.int64)
        rows[at], size[at] = hist["n"], hist["s"]
        ends = {int(r.b): ((int(r.lo_h), int(r.lo_i)), (int(r.hi_h), int(r.hi_i))) for r in hist.itertuples()}
        before = np.cumsum(size)[:-1]  # bytes below each probe
        total = int(size.sum())
        ideal = total / shards
        fresh: set[tuple[int, int]] = set()
        chosen: dict[int, int] = {}
        for t in range(1, shards * pieces):
            target = total * t / (shards * pieces)
            tol = ideal * tolerance if t % pieces == 0 else ideal / pieces / 2
            cell = int(np.searchsorted(before, target, side="right"))  # the interval that holds the target
            near = [p for p in (cell - 1, cell) if 0 <= p < len(order)]
            good = [p for p in near if abs(before[p] - target) <= tol]
            best = min(good or near, key=lambda p: (bool(good) and order[p][1] != MIN_ID, abs(before[p] - target)))
            chosen[t] = best
            if not good and cell in ends and ends[cell][0] < ends[cell][1]:
                fresh.update(_between(*ends[cell], PROBES))
        fresh -= probes
        if not fresh:
            break
        # probes far from every target are not needed any more
        keep = {order[q] for p in chosen.values() for q in (p - 1, p, p + 1) if 0 <= q < len(order)}
        probes = keep | fresh
    at = [chosen[t] for t in range(1, shards * pieces)]
    shard_of_cut = np.maximum.accumulate(np.array(at, np.int64)) if at else np.zeros(0, np.int64)
    row_before = np.cumsum(rows)[:-1]
    cuts = row_before[shard_of_cut]
    shard = np.arange(shards * pieces) // pieces
    piece_start = np.concatenate([[0], cuts])
    shard_start = piece_start[shard * pieces]
    return Splitters(ph[shard_of_cut], pi[shard_of_cut], shard.astype(np.int32), piece_start - shard_start, rounds)


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
           tolerance: float = TOLERANCE, pieces: int | None = None) -> DataFrame:
    """``docs`` plus ``size``, ``shard`` and ``slot`` (gapless from 0 inside a shard, in key order)."""
    spark = docs.sparkSession
    pieces = pieces or max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    h, i = key_columns(F.col(key), F.col(text))
    narrow = staged(docs.select(h.alias("h"), i.alias("i"), size_column(F.col(text)).alias("s")), "shard-keys")
    cut = find_splitters(narrow, shards, pieces, tolerance)

    @F.pandas_udf("int")
    def piece(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in it:
            yield pd.Series(below(cut.h, cut.i, a.to_numpy(), b.to_numpy()).astype(np.int32), index=a.index)

    def lookup(values) -> Column:
        return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("__piece"))

    order = Window.partitionBy("__piece").orderBy("__h", "__i")
    placed = (docs.withColumns({"size": size_column(F.col(text)), "__h": h, "__i": i})
              .withColumn("__piece", piece("__h", "__i"))
              .withColumn("slot", F.row_number().over(order) - 1 + lookup(cut.start))
              .withColumn("shard", lookup(cut.shard).cast("int")))
    return placed.drop("__h", "__i", "__piece")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; the rows of a task keep their key order."""
    sharded.write.partitionBy("shard").parquet(path)
