"""Shared pieces of the training-data operators: table access, word hashing, staging.

Operators either read only the columns that they are told of, or draw working names that
the input does not have (``free_name``)."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide.session import shared_dir

#: Fixed by the contracts: a word is a maximal run of other bytes than these.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage is cut, and a
    lost executor costs a re-read only."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, rows: int) -> bool:
    """True if a staged table has at most ``rows`` rows (checked before any broadcast hint)."""
    return df.limit(rows + 1).count() <= rows


def free_name(columns: Iterable[str], base: str) -> str:
    """A column name that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def give_back() -> None:
    """Return a Python worker's freed memory to the system (workers outlive their tasks)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps its own counsel
        return


def keyed_join(rows: DataFrame, values: DataFrame, key: str, heavy: int = 1000) -> DataFrame:
    """``rows`` joined to ``values``, a staged table of one row per ``key`` with the number of rows
    that hold it in ``weight`` (dropped).

    Keys with more than 1/``heavy`` of all rows -- by that, fewer than ``heavy`` keys -- are joined
    from a broadcast, so their rows stay where they are; the others are shuffled by key."""
    total = values.agg(F.sum("weight")).first()[0] or 0
    hot = values.where(F.col("weight") * heavy > F.lit(total))
    rest = values.where(F.col("weight") * heavy <= F.lit(total)).drop("weight")
    near = rows.join(F.broadcast(hot.drop("weight")), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return near.unionByName(far)


def bind(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` plus a column that is worked out once per row: the optimizer moves neither filters nor
    later expressions through a generator, so a costly value is not repeated inside a lambda."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), elementwise on uint64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _classes() -> tuple[np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[list(SPACE_BYTES)] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return space, lower


_SPACE, _LOWER = _classes()
_POWERS = np.ones(1, _U)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 4096)
        _POWERS = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _ODD)]))
    return _POWERS


def word_spans(texts: list[bytes], space: np.ndarray = _SPACE):
    """(joined buffer, starts, ends, doc_of_word, words per text) of all words of all texts.

    The texts are joined by a newline, so no word crosses a text."""
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    edge = np.diff((~space[buf]).view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(np.cumsum(lens + 1), starts, side="right")
    return buf, starts, ends, doc, np.bincount(doc, minlength=len(texts))


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], _U)


def span_bytes_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of the bytes of each span (no empty spans), eight bytes at a step."""
    if not len(starts):
        return np.zeros(0, _U)
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = _LOWER[buf] if lower else buf
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(_U), (len(buf),), (1,), writeable=False)
    left = ends - starts
    h = mix((eight[starts] & _MASK[np.minimum(left, 8)]) + left.astype(_U) * _ODD)
    far, at = np.flatnonzero(left > 8), 8
    while len(far):
        rest = left[far] - at
        h[far] = mix(h[far] * _ODD + (eight[starts[far] + at] & _MASK[np.minimum(rest, 8)]))
        at += 8
        far = far[left[far] > at]
    return h


def word_hashes(texts: list[bytes], lower: bool = True):
    """(64-bit hashes of all words, doc_of_word, words per text), without a Python loop over words."""
    buf, starts, ends, doc, n = word_spans(texts)
    return span_bytes_hash(buf, starts, ends, lower), doc, n


def shingle_hashes(h: np.ndarray, doc: np.ndarray, n_words: np.ndarray, k: int):
    """Hashes of the k-word shingles; a text of 1 to k-1 words has its whole word sequence as one.

    Returns (hashes uint64, doc_of_shingle).  Repeats are kept.
    """
    if not len(h):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    first = np.cumsum(n_words) - n_words
    out, at = [], []
    n = len(h) - k + 1
    if n > 0:
        same = doc[:n] == doc[k - 1:]
        acc = h[:n].copy()
        for i in range(1, k):
            acc *= _ODD
            acc += h[i:n + i]
        out.append(mix(acc[same]))
        at.append(doc[:n][same])
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        acc = np.zeros(1, _U)
        for i in range(n_words[d]):
            acc = acc * _ODD + h[first[d] + i]
        out.append(mix(mix(acc) + _U(n_words[d])))
        at.append(np.full(1, d))
    if not out:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    s, d = np.concatenate(out), np.concatenate(at).astype(np.int64)
    if len(out) == 1:
        return s, d
    order = np.argsort(d, kind="stable")
    return s[order], d[order]


def slices(texts: list[bytes], budget: int = 1 << 20):
    """Cut a batch into runs of texts of about ``budget`` bytes (a longer text is a run of its
    own), so that working arrays stay small whatever the batch holds."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > budget:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def as_bytes(column) -> list[bytes]:
    """An Arrow or pandas string column as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.Array):
        return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in column]


def connected_components(edges: DataFrame, a: str, b: str, name: str = "cc") -> DataFrame:
    """(node, component) for every node of an edge: component = the smallest node reachable.

    Alternates large-star and small-star contractions until the edge set is a
    forest of stars.  Minima are combined before the shuffle, so a hub costs no
    more than its edges; every round is staged, so lineage stays short.
    """
    cur = staged(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .where("a != b").distinct(), f"{name}-edges")
    seen = None
    while True:
        state = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large-star: larger neighbours of a node move to the smallest of it and its neighbours
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, f"{name}-large")
        # small-star: a node and its smaller neighbours move to the smallest of those
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        cur = staged(small.where("a != b").distinct(), f"{name}-small")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
