"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than ``chunk`` code points is cut into windows that overlap by
``overlap`` code points on both sides.  Every window is pre-tokenised on its own;
two neighbours are stitched at the first boundary that both have inside their
overlap and that stands in any reading of the text: a blank after a letter or digit
(the split pattern never looks behind, so from there on both go on alike); the pieces between stitches are encoded in parallel, and their ids
are joined in order.  Where two windows share no boundary the piece runs on into
the next one.  Shorter texts are one piece and are never shuffled.

Defined results: null or empty text has no ids; rows are kept as they are
(repeated rows, null or repeated doc ids, extra columns of any name).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collide.llm.common import free_name, give_back, slices, staged
from collide.llm.pretok import LETTER, NUMBER, OTHER, WordTable, boundaries, classes, code_points, encode_all, known, newline_encoder

RANKS = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP = 1 << 16, 1 << 9


def load_ranks(name: str = RANKS) -> dict[bytes, int]:
    """Byte string -> id, from a rank file (a bare name is one of the installed public files)."""
    import public_tokenizers as P
    with open(name if "/" in name else P.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _encoder(name: str):
    """The library encoding and the word table of this worker (kept from task to task)."""
    import public_tokenizers as P
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(name), special_tokens={})
    return enc, WordTable(newline_encoder(enc.encode_ordinary))


@cache
def _spelled(name: str) -> pa.Array:
    """The bytes of every id (kept by a worker from task to task)."""
    ranks = load_ranks(name)
    out = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        out[i] = b
    return pa.array(out, pa.binary())


def _decoded(spelled: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of the ids, one after another."""
    if not len(ids):
        return b""
    taken = pc.take(spelled, pa.array(ids.astype(np.int64)))
    return taken.buffers()[2].to_pybytes()[:int(np.frombuffer(taken.buffers()[1], np.int32)[len(ids)])]


def _encode_udf(name: str):
    @F.arrow_udf("binary")
    def ids(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, words = _encoder(name)
        try:
            for s in it:
                size, out = pc.fill_null(pc.binary_length(s), 0).to_pylist(), []
                for lo, hi in slices([range(n) for n in size], 1 << 19):  # only a slice's texts and ids are Python objects
                    texts = [t or "" for t in s.slice(lo, hi - lo).to_pylist()]
                    out.append(pa.array([x.astype("<u4").tobytes() for x in encode_all(texts, words, enc.encode_ordinary)], pa.binary()))
                yield pa.concat_arrays(out) if out else pa.array([], pa.binary())
        finally:
            give_back()
    return ids


_DIGEST_DDL = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest(key, runs: list[np.ndarray], spelled: pa.Array) -> pa.RecordBatch:
    ids = [hashlib.sha256(" ".join(map(str, x.tolist())).encode()).hexdigest() for x in runs]
    back = [hashlib.sha256(_decoded(spelled, x)).hexdigest() for x in runs]
    return pa.RecordBatch.from_arrays([key, pa.array([len(x) for x in runs], pa.int64()), pa.array(ids, pa.string()),
                                       pa.array(back, pa.string())], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS,
               chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every text: encoded, decoded and digested in one
    pass (long texts: by overlapping chunks, then digested from their joined ids)."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (enc, words), spelled = _encoder(ranks), _spelled(ranks)
        try:
            for batch in batches:
                size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
                for lo, hi in slices([range(n) for n in size], 1 << 20):  # only a slice's texts become Python strings
                    texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                    yield _digest(batch.column(0).slice(lo, hi - lo), encode_all(texts, words, enc.encode_ordinary), spelled)
        finally:
            give_back()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _spelled(ranks)
        for batch in batches:
            for i in range(batch.num_rows):  # long texts: one at a time
                yield _digest(batch.column(0).slice(i, 1), [np.frombuffer(batch.column(1)[i].as_py(), "<u4")], spelled)

    own = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    size = F.coalesce(F.char_length("text"), F.lit(0))
    short = own.where(size <= chunk).mapInArrow(whole, _DIGEST_DDL)
    far = long_ids(own.where(size > chunk), "text", ranks, chunk, overlap).select("key", "ids").mapInArrow(packed, _DIGEST_DDL)
    return short.union(far).withColumnRenamed("key", key)


def window_boundaries(text: str, begins: bool, ends: bool, pattern=None) -> np.ndarray:
    """Boundaries of one window that hold whatever follows it: those of a run that touches a cut
    end of the window are left out.  Windows with code points of doubtful class use ``pattern``."""
    cps, offs = code_points([text])
    if known(cps).all():
        b = boundaries(cps, offs)
    else:
        b = np.fromiter((m.start() for m in pattern.finditer(text)), np.int64)
    if not ends and len(b):
        k = classes()[np.minimum(cps, len(classes()) - 1)]
        word = np.isin(k, (LETTER, NUMBER, OTHER))
        change = np.flatnonzero(word[1:] != word[:-1])
        b = b[b <= (change[-1] if len(change) else 0)]
    return b


def _sides_udf(chunk: int, overlap: int):
    @F.pandas_udf("left array<int>, right array<int>")
    def sides(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        import public_tokenizers as P
        import regex
        pattern = regex.compile(P.PATTERN)
        for text, i, n in it:
            left, right = [], []
            for t, k, size in zip(text, i, n):
                at = max(0, k * chunk - overlap)
                b = window_boundaries(t, k == 0, at + len(t) >= size, pattern) + at
                # only boundaries that stand in any reading of the text: a plain blank after a letter or digit
                b = [int(x) for x in b if x > at and t[x - at] in " \t\n\r" and t[x - at - 1].isalnum()]
                left.append([x for x in b if k * chunk <= x < k * chunk + overlap])
                right.append([x for x in b if (k + 1) * chunk <= x < (k + 1) * chunk + overlap])
            yield pd.DataFrame({"left": left, "right": right})
    return sides


def pieces(long_docs: DataFrame, text: str, row: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, place, piece): the texts of ``long_docs`` cut where neighbouring windows agree."""
    n = F.char_length(text)
    win = (long_docs.select(F.col(row).alias("r"), F.col(text).alias("t"), n.alias("n"))
           .select("r", "t", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / chunk).cast("int") - 1)).alias("i"))
           .select("r", "n", "i", F.substring("t", F.greatest(F.lit(0), F.col("i") * chunk - overlap) + 1,
                                              F.lit(chunk + overlap) + F.least(F.lit(overlap), F.col("i") * chunk)).alias("w")))
    side = win.select("r", "n", "i", _sides_udf(chunk, overlap)("w", "i", "n").alias("s"))
    order = Window.partitionBy("r").orderBy("i")
    cut = F.when(F.col("i") == 0, F.lit(0)).otherwise(
        F.array_min(F.array_intersect(F.col("s.left"), F.lag("s.right").over(order))))
    cuts = (side.withColumn("c", cut).where("c is not null")
            .groupBy("r").agg(F.array_sort(F.collect_list("c")).alias("cuts"), F.max("n").alias("n")))
    spans = cuts.select("r", F.posexplode(F.transform("cuts", lambda c, k: F.struct(
        c.alias("lo"), F.coalesce(F.get("cuts", k + 1), F.col("n")).alias("hi")))).alias("place", "p"))
    return (long_docs.select(F.col(row).alias("r"), F.col(text).alias("t")).join(spans, "r")
            .select("r", "place", F.substring("t", F.col("p.lo") + 1, F.col("p.hi") - F.col("p.lo")).alias("piece")))


def _join_udf():
    @F.pandas_udf("binary")
    def joined(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for parts in it:
            yield pd.Series([b"".join(p) for p in parts], index=parts.index, dtype=object)
    return joined


def long_ids(far: DataFrame, text: str, ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP,
             ids: str = "ids") -> DataFrame:
    """``far`` plus ``ids``, by overlapping chunks."""
    row = free_name([*far.columns, ids], "row")
    kept = staged(far.withColumn(row, F.monotonically_increasing_id()), "bpe-long")
    got = (pieces(kept, text, row, chunk, overlap).withColumn("x", _encode_udf(ranks)("piece"))
           .groupBy("r").agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("xs"))
           .select(F.col("r").alias(row), _join_udf()("xs.x").alias(ids)))
    return kept.join(got, row).drop(row)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", ranks: str = RANKS,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` plus ``ids``: the ids of the whole text as little-endian unsigned 32-bit integers."""
    size = F.coalesce(F.char_length(text), F.lit(0))
    short = docs.where(size <= chunk).withColumn(ids, _encode_udf(ranks)(F.col(text)))
    return short.unionByName(long_ids(docs.where(size > chunk), text, ranks, chunk, overlap, ids))


def decode_udf(ranks: str = RANKS):
    """Column of packed ids -> the bytes they stand for."""
    @F.pandas_udf("binary")
    def decoded(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spelled = _spelled(ranks)
        for s in it:
            yield pd.Series([_decoded(spelled, np.frombuffer(x, "<u4")) for x in s], index=s.index, dtype=object)
    return decoded


def ids_digest_udf():
    """SHA-256 of the decimal ids joined by one space."""
    @F.pandas_udf("string")
    def digest(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield pd.Series([hashlib.sha256(" ".join(map(str, np.frombuffer(x, "<u4").tolist())).encode()).hexdigest()
                             for x in s], index=s.index, dtype=object)
    return digest


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
