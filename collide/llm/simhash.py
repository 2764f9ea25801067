"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits; a bit is 1 if it is set in more than half of the XXH64 hashes (UTF-8,
seed 42) of the text's word shingles, repeats included.  Two fingerprints link if at most three
bits differ.  The steps, all exact, on distinct fingerprints (copies cost one row):

1. Pigeonhole: the bits are split into six blocks, so fingerprints that differ in three bits at
   most agree in three blocks or more.  Every choice of three blocks is one key, and a join on
   the keys gives the candidates, which are verified by their differing bits.
2. A key that more than ``PAIRS`` fingerprints share is not paired off.  Its members join through
   points instead: all members within one bit of a point are within two bits of each other, so
   each takes a link to the least of them (65 rows a member, no pairs).  That gives every link of
   two bits or fewer, up to connection.
3. What is left are links of exactly three bits between different groups of one key.  One of the two
   lies outside the key's largest group; such members look up the points two bits away (of the bits in
   which members of their keys differ), and link to the least member within one bit of the point (three bits, verified).

Steps 2 and 3 are linear in the members of a key, whatever its size, and lose no connection.

Defined results: text is lower-cased in A-Z; a text of fewer than k words is one shingle; null,
empty and wordless texts have fingerprint zero and are linked like any other; a null key is kept
and gets the smallest key of its component, null if that has none; repeated rows are kept; only the
key and the text are read, so extra columns of any name do not matter; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collide.llm.common import as_bytes, connected_components, keyed_join, staged

SEED, DISTANCE, PAIRS = 42, 3, 16
#: Width of each block; they tile the 64 bits.
BLOCKS = (11, 11, 11, 11, 10, 10)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_RUN = 1 << 16


def fingerprint(text: bytes, k: int = 3) -> int:
    """SimHash of the UTF-8 bytes of one text (whatever its length, ``_RUN`` shingles at a time)."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size).tolist()
    last = ends[min(k, len(words)) - 1:].tolist()
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, len(last), _RUN):
        part = last[lo:lo + _RUN]
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[lo:], part)), "<u8", len(part))
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3) -> DataFrame:
    """(key, fp): the fingerprint of every row as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, k) for t in as_bytes(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["key", "fp"])
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "key long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks() -> list[int]:
    """One mask per choice of three blocks."""
    at = np.concatenate([[0], np.cumsum(BLOCKS)]).tolist()
    block = [((1 << w) - 1) << a for a, w in zip(at, BLOCKS)]
    return [_signed(sum(c)) for c in combinations(block, 3)]


def _keys(fps: DataFrame) -> DataFrame:
    """(fp, c, part): every fingerprint under every choice of blocks."""
    each = F.array(*[F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
                     for c, m in enumerate(block_masks())])
    return fps.select("fp", F.explode(each).alias("e")).select("fp", "e.c", "e.part")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _points(fps: DataFrame, flips: list[int], within: Column | None = None) -> DataFrame:
    """(fp, p): the points that are the given flips (of the bits ``within`` only) away from each fingerprint."""
    each = F.lit(flips)
    if within is not None:
        each = F.filter(each, lambda x: x.bitwiseAND(F.bitwise_not(within)) == 0)
    return fps.select("fp", F.explode(each).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("p"))


ONE = [0] + [_signed(1 << i) for i in range(64)]
TWO = [_signed((1 << i) | (1 << j)) for i, j in combinations(range(64), 2)]


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fps`` (column fp) whose connected components
    are those of all links of at most three bits."""
    keys = _keys(fps)
    shared = staged(keys.groupBy("c", "part").agg(F.count(F.lit(1)).alias("m"), F.min("fp").alias("a"),
                                                  F.max("fp").alias("b")).where("m > 1"), "sim-shared")
    near = shared.where("m = 2").select("a", "b")
    more = staged(keys.join(shared.where("m > 2").select("c", "part", "m"), ["c", "part"]), "sim-more")
    few = more.where(F.col("m") <= PAIRS).select("c", "part", "fp")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["c", "part"])
             .where("a < b").select("a", "b"))
    close = near.union(pairs).where(_apart("a", "b") <= DISTANCE)
    crowd = more.where(F.col("m") > PAIRS)
    if crowd.isEmpty():
        return close.distinct()

    points = staged(_points(crowd.select("fp").distinct(), ONE), "sim-points")
    centre = staged(points.groupBy("p").agg(F.min("fp").alias("z"), F.count(F.lit(1)).alias("m")), "sim-centres")
    star = points.join(centre.where("m > 1"), "p").where("fp != z").select(F.col("fp").alias("a"), F.col("z").alias("b"))
    close = staged(close.union(star).distinct(), "sim-close")
    group = staged(connected_components(close, "a", "b", "sim-near"), "sim-groups")

    # members outside the largest group of a key look two bits further
    member = (crowd.join(group, crowd.fp == group.node, "left")
              .select("c", "part", "fp", F.coalesce("component", "fp").alias("g")))
    member = staged(member, "sim-members")
    tally = member.groupBy("c", "part", "g").agg(F.count(F.lit(1)).alias("m"), F.bit_or("fp").alias("o"), F.bit_and("fp").alias("e"))
    top = (tally.groupBy("c", "part").agg(F.max_by("g", F.struct("m", "g")).alias("top"), F.count(F.lit(1)).alias("gs"),
                                          F.bit_or("o").bitwiseXOR(F.bit_and("e")).alias("vary"))
           .where("gs > 1").select("c", "part", "top", "vary"))
    aside = member.join(top, ["c", "part"]).where("g != top").groupBy("fp").agg(F.bit_or("vary").alias("vary"))
    far = (_points(aside, TWO, F.col("vary")).join(centre.select("p", "z"), "p").where("fp != z")
           .select(F.col("fp").alias("a"), F.col("z").alias("b")).where(_apart("a", "b") <= DISTANCE))
    kept = group.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return kept.union(far.distinct())


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3) -> DataFrame:
    """(key, fp, component_id) per row: the smallest key reachable by links of at most three bits."""
    rows = staged(fingerprints(docs, key, text, k), "sim-docs")
    fps = staged(rows.groupBy("fp").agg(F.min("key").alias("lo"), F.count(F.lit(1)).alias("copies")), "sim-fps")
    comp = connected_components(links(fps.select("fp")), "a", "b", "sim-links")
    linked = staged(comp.join(fps, comp.node == fps.fp).select("fp", "component", "lo"), "sim-linked")
    least = linked.groupBy("component").agg(F.min("lo").alias("least"), F.count(F.lit(1)).alias("weight"))
    low = keyed_join(linked.select("fp", "component"), staged(least, "sim-least"), "component").select("fp", "least")
    label = fps.join(low, "fp", "left").select("fp", F.least("least", "lo").alias("component_id"),
                                               F.col("copies").alias("weight"))
    found = keyed_join(rows, staged(label, "sim-labels"), "fp")
    return found.select(F.col("key").alias(key), "fp", "component_id")


def hex16(fp: str) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
