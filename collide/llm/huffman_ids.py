"""Token-id files: canonical length-limited Huffman code, independent blocks, bit-offset checkpoints.

File format (a folder of Parquet tables, so Spark's writers commit it and lost tasks
are simply run again):

* ``code``: id, length -- the canonical code is fixed by the lengths (shorter first,
  then by id), at most ``limit`` bits each;
* ``blocks``: part, block, first (ids before it in its part), doc_ids, n_tokens (per
  document, end id included), n_bits, payload (codes, most significant bit first),
  checkpoints (unsigned 32-bit little-endian bit offset of every ``stride``-th id).

Parts are ranges of the order key in ascending order; a block holds whole documents
and about ``block_ids`` ids.  Blocks decode independently; inside a block all
checkpoint lanes are decoded side by side through one table of 2**limit entries.

Defined results: null and empty texts hold the end id only; null keys come first;
rows with equal keys stay neighbours in any order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide.llm.common import give_back, slices
from collide.llm.pretok import WordTable, encode_all, newline_encoder
from collide.session import shared_dir

VOCAB = "byte_bpe_50k.json"
END_ID = 2
LIMIT, STRIDE, BLOCK_IDS = 16, 256, 1 << 17

_RAW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
                  ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int32())), ("ids", pa.binary()),
                  ("counts", pa.map_(pa.int32(), pa.int64()))])
_RAW_DDL = ("part int, block int, first long, doc_ids array<long>, n_tokens array<int>, ids binary, "
            "counts map<int,long>")
_CODED_DDL = ("part int, block int, first long, doc_ids array<long>, n_tokens array<int>, n_bits long, "
              "payload binary, checkpoints binary")


# --- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for absent symbols."""
    out = np.zeros(len(counts), np.uint8)
    live = np.flatnonzero(counts > 0)
    if len(live) == 0:
        return out
    if len(live) > 1 << limit:
        raise ValueError(f"{len(live)} symbols need codes of more than {limit} bits")
    if len(live) == 1:
        out[live] = 1
        return out
    order = live[np.argsort(counts[live], kind="stable")]
    w = counts[order].astype(np.float64)
    n, levels, pack = len(w), [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([w, pack])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank]
        merged = merged[:len(merged) // 2 * 2]
        pack = merged[::2] + merged[1::2]
    take, bits = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(levels):  # the leaves among the first ``take`` items are always the lightest ones
        leaves = int(leaf[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = bits
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Canonical code words of the given lengths."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for s in order[np.searchsorted(lengths[order], 1):].tolist():
        code <<= int(lengths[s]) - last
        last = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, length) of every ``limit``-bit window."""
    codes, sym, size = canonical(lengths), np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
    live = np.flatnonzero(lengths)
    order = live[np.lexsort((live, lengths[live]))]
    span = np.left_shift(1, limit - lengths[order].astype(np.int64))
    lo = codes[order].astype(np.int64) << (limit - lengths[order].astype(np.int64))
    if len(order):
        at = int(lo[0])
        filled = int(span.sum())
        sym[at:at + filled] = np.repeat(order, span)
        size[at:at + filled] = np.repeat(lengths[order], span)
    return sym, size


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, stride: int = STRIDE) -> tuple[bytes, int, bytes]:
    """(payload, bits, checkpoints) of a block of ids."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    bits = int(end[-1]) if len(ids) else 0
    at = end - size
    words = np.zeros(bits // 32 + 2, np.float64)
    shifted = codes[ids].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
    word = at >> 5
    # fields of one word never overlap, so sums (exact below 2**53) put them together
    words += np.bincount(word, weights=(shifted >> np.uint64(32)).astype(np.float64), minlength=len(words))
    words += np.bincount(word + 1, weights=(shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=len(words))
    payload = words.astype(">u4").tobytes()[:-(-bits // 8)]
    if bits >= 1 << 32:
        raise ValueError("a block of more than 2**32 bits")
    return payload, bits, at[::stride].astype("<u4").tobytes()


def unpack(payload: bytes, n: int, checkpoints: bytes, sym: np.ndarray, size: np.ndarray,
           limit: int = LIMIT, stride: int = STRIDE) -> np.ndarray:
    """Ids of a block: all checkpoint lanes step together, one table lookup per id."""
    at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
    lanes = len(at)
    if not lanes:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(payload + bytes(8 + limit * stride), np.uint8).astype(np.uint64)
    out = np.zeros((stride, lanes), np.uint32)
    for i in range(min(stride, n)):
        k = at >> 3
        window = (raw[k] << np.uint64(16)) | (raw[k + 1] << np.uint64(8)) | raw[k + 2]
        window = (window >> (np.uint64(24 - limit) - (at & 7).astype(np.uint64))) & np.uint64((1 << limit) - 1)
        out[i] = sym[window]
        at = at + size[window]
    return out.T.ravel()[:n]


# --- Spark --------------------------------------------------------------------

@cache
def _tokenizer(vocab: str):
    """(special strings, encode a whole text, word table) of this worker, kept from task to task."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocab if "/" in vocab else P.path(vocab))

    def whole(t):
        return tok.encode_batch_fast([t], add_special_tokens=False)[0].ids

    return [t.content for t in tok.get_added_tokens_decoder().values()], whole, WordTable(newline_encoder(whole))


def _blocks_of(vocab: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials, whole, words = _tokenizer(vocab)
        part = TaskContext.get().partitionId()
        block = first = 0
        keys: list = []
        runs: list[np.ndarray] = []
        have, total = 0, np.zeros(0, np.int64)

        def row(number: int, counts: list) -> pa.RecordBatch:
            flat = np.concatenate([*runs, np.zeros(0, np.uint32)]).astype("<u4")
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                pa.array([keys], pa.list_(pa.int64())), pa.array([[len(r) for r in runs]], pa.list_(pa.int32())),
                pa.array([flat.tobytes()], pa.binary()), pa.array([counts], _RAW.field("counts").type)], schema=_RAW)

        try:
            for b in batches:
                size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
                ks = b.column(0).to_pylist()
                for lo, hi in slices([range(n) for n in size], 1 << 20):  # only a slice's texts become Python strings
                    texts = [t or "" for t in b.column(1).slice(lo, hi - lo).to_pylist()]
                    plain = [t if not any(s in t for s in specials) else "" for t in texts]
                    ids = encode_all(plain, words, whole)
                    for j, t in enumerate(texts):
                        x = ids[j] if plain[j] or not t else np.asarray(whole(t), np.uint32)
                        keys.append(ks[lo + j])
                        runs.append(np.append(x, np.uint32(end_id)))
                        have += len(runs[-1])
                        if have >= block_ids:
                            total = _add(total, np.concatenate(runs))
                            yield row(block, [])
                            block, first, keys, runs, have = block + 1, first + have, [], [], 0
            if runs:
                total = _add(total, np.concatenate(runs))
                yield row(block, [])
                keys, runs = [], []
            live = np.flatnonzero(total)
            if len(live):  # the counts of this task, as a block without documents
                yield row(-1, list(zip(live.tolist(), total[live].tolist())))
        finally:
            give_back()
    return run


def _add(total: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Running counts of ids."""
    c = np.bincount(ids, minlength=len(total))
    c[:len(total)] += total
    return c


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of all blocks that a task reads, added up as arrays: one row per id and reading task, not per writing task."""
    total = np.zeros(1, np.int64)
    for b in batches:
        pairs = pc.list_flatten(b.column(0))
        if len(pairs):
            ids = pc.struct_field(pairs, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.append(total, np.zeros(max(0, int(ids.max()) + 1 - len(total)), np.int64))
            np.add.at(total, ids, pc.struct_field(pairs, 1).to_numpy(zero_copy_only=False).astype(np.int64))
    live = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(live, pa.int64()), pa.array(total[live], pa.int64())], names=["id", "n"])


def _coded(lengths: np.ndarray, stride: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical(lengths)
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                payload, bits, marks = pack(np.frombuffer(one.column(5)[0].as_py(), "<u4"), codes, lengths, stride)
                yield pa.RecordBatch.from_arrays(
                    [one.column(k) for k in range(5)] + [pa.array([bits], pa.int64()), pa.array([payload], pa.binary()),
                                                         pa.array([marks], pa.binary())],
                    names=["part", "block", "first", "doc_ids", "n_tokens", "n_bits", "payload", "checkpoints"])
    return run


def write_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", vocab: str = VOCAB,
                 end_id: int = END_ID, limit: int = LIMIT, parts: int | None = None,
                 block_ids: int = BLOCK_IDS, stride: int = STRIDE) -> None:
    """Tokenize, append ``end_id`` to each document and write the ids in ascending ``key`` order."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = f"{path}/_ids"
    (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
     .repartitionByRange(parts, "key").sortWithinPartitions("key")
     .mapInArrow(_blocks_of(vocab, end_id, block_ids), _RAW_DDL)
     .write.option("compression", "zstd").parquet(raw))
    stored = spark.read.schema(_RAW_DDL).parquet(raw)
    counts = (stored.where("block < 0").select(F.map_entries("counts")).mapInArrow(_summed, "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).toPandas())  # at most one row per id of the vocabulary
    ids = stored.where("block >= 0").drop("counts")
    dense = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    dense[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = code_lengths(dense, limit)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int") \
        .coalesce(1).write.parquet(f"{path}/code")
    ids.mapInArrow(_coded(lengths, stride), _CODED_DDL).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _decoded(lengths: np.ndarray, limit: int, stride: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sym, size = decode_table(lengths, limit)
        for b in batches:
            for r in b.to_pylist():
                n = np.asarray(r["n_tokens"], np.int64)
                ids = unpack(r["payload"], int(n.sum()), r["checkpoints"], sym, size, limit, stride).astype("<u4")
                end = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["part"]] * len(n), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                    pa.array(end - n + r["first"], pa.int64()), pa.array(n, pa.int64()),
                    pa.array([ids[e - k:e].tobytes() for e, k in zip(end.tolist(), n.tolist())], pa.binary())],
                    names=["part", "key", "at", "n_tokens", "ids"])
    return run


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", limit: int = LIMIT,
                stride: int = STRIDE) -> DataFrame:
    """(key, start, n_tokens, ids) per document; ids packed as little-endian unsigned 32-bit integers."""
    code = spark.read.schema("id long, length int").parquet(f"{path}/code").toPandas()  # one row per id
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.uint8)
    lengths[code["id"].to_numpy(np.int64)] = code["length"].to_numpy(np.uint8)
    blocks = spark.read.schema(_CODED_DDL).parquet(f"{path}/blocks")
    sizes = (blocks.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
             .orderBy("part").collect())  # one row per part of the file
    before, total = [0] * (1 + max((r["part"] for r in sizes), default=0)), 0
    for r in sizes:
        before[r["part"]] = total
        total += r["n"]
    docs = blocks.select("part", "first", "doc_ids", "n_tokens", "payload", "checkpoints").mapInArrow(
        _decoded(lengths, limit, stride), "part int, key long, at long, n_tokens long, ids binary")
    offsets = F.array(*[F.lit(x).cast("long") for x in before])
    return docs.select(F.col("key").alias(key), (F.get(offsets, F.col("part")) + F.col("at")).alias("start"),
                       "n_tokens", "ids")


def fresh_path(spark: SparkSession) -> str:
    """A new folder for one set of token files inside the shared folder."""
    return shared_dir(spark, "llm", f"tokens-{uuid.uuid4().hex[:12]}")
