"""Cross-tokenizer alignment in Arrow.

Every text is encoded twice, with a blank in front: by a byte-level vocabulary (A) and by a piece
model (B).  Both token lists spell the same bytes, so byte offsets where a token of either ends
cut them into groups, and the two tokens that end there are linked.  Inside a task all of it is Arrow
work on runs of texts: list flatten and parent indices, a cumulative sum of the token sizes minus its
value at the text's start, an Acero hash join on (text, end), and ``Table.group_by`` for partial counts of the
linked id pairs, which Spark adds up.

A second pass gives every text the counts of its links.  The most frequent pairs (whole powers of two of the
count, ``KNOWN`` pairs at most) go to the tasks as one table; all others, which are rare, are joined by a
shuffle.  So what is broadcast has a fixed bound and no frequent pair is a shuffle key.

B never merges across the place where a blank follows another character (no piece holds a blank there; the
vocabulary is checked when it is loaded), so it encodes each distinct blank-led run once per worker.
Pre-tokens are told apart by 64-bit hashes of their code points (n distinct ones: chance n * n / 2**65
of one wrong match).

Defined results: texts that are null, empty, or not spelled exactly by both token lists have no
tokens, only zeros and an empty ``groups_sha256``; null or repeated keys and repeated rows are kept row by row;
only key and text are read, so extra columns of any name do not matter; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collide.llm.common import slices, staged
from collide.llm.pretok import WordTable, code_points, encode_all, list_encoder, newline_encoder, spans_hash

VOCAB_A, VOCAB_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
KNOWN, WORDS = 1 << 20, 400_000
_BLANK = "▁"


def _path(name: str) -> str:
    import public_tokenizers as P
    return name if "/" in name else P.path(name)


class Side:
    """One tokenizer: ids of a run of texts, and the bytes and decimal digits of every id."""

    def __init__(self, spelled: list[bytes]):
        if len(spelled) > 1 << 16:
            raise ValueError("ids are packed in 16 bits")
        self.bytes = pa.array(spelled, pa.binary())
        self.size = pa.array(np.fromiter(map(len, spelled), np.int64, len(spelled)))
        self.digits = pa.array([str(i) for i in range(len(spelled))], pa.string())


class ByteSide(Side):
    def __init__(self, name: str):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(_path(name))
        tok.encode_special_tokens = True
        keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # these stand for themselves, in order
        rest = [b for b in range(256) if b not in keep]
        back = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}
        super().__init__([bytes(back[c] for c in tok.id_to_token(i)) for i in range(tok.get_vocab_size())])
        self._whole = lambda t: tok.encode_batch_fast([t], add_special_tokens=False)[0].ids
        self._words = WordTable(newline_encoder(self._whole), WORDS)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return encode_all(texts, self._words, self._whole)


class PieceSide(Side):
    def __init__(self, name: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=_path(name))
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError("a piece holds a blank after another character")
        super().__init__([bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_BLANK, " ").encode()
                          for i, p in enumerate(pieces)])
        alone = [model.piece_to_id(_BLANK)]

        def runs(words: list[str]) -> list[list[int]]:  # the model puts the first blank there itself
            ids = model.encode([w[1:] for w in words], num_threads=1)
            return [x if len(w) > 1 else alone for w, x in zip(words, ids)]
        self._words = WordTable(list_encoder(runs), WORDS)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that are empty or begin with a blank."""
        cps, offs = code_points(texts)
        if not len(cps):
            return [np.zeros(0, np.uint32)] * len(texts)
        blank = cps == 0x20
        lead = blank.copy()
        lead[1:] &= ~blank[:-1]
        lead[offs[:-1][offs[:-1] < len(cps)]] = True
        starts = np.flatnonzero(lead)
        ends = np.append(starts[1:], len(cps))
        rows = self._words.ranks("".join(texts), spans_hash(cps, starts, ends), starts, ends)
        flat, n = self._words.ids(rows)
        return np.split(flat, np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, offs[1:-1])])


@cache
def _sides(a: str, b: str) -> tuple[ByteSide, PieceSide]:
    """Both tokenizers of this worker (kept from task to task)."""
    return ByteSide(a), PieceSide(b)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)))


def _spelled(side: Side, tokens: pa.ListArray, texts: list[bytes]) -> np.ndarray:
    """Which token lists spell their text."""
    spelled = pc.take(side.bytes, tokens.flatten())
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.concatenate([[0], np.cumsum(pc.take(side.size, tokens.flatten()).to_numpy())])[np.asarray(tokens.offsets)]
    raw = b"".join(spelled.to_pylist()) if spelled.offset else spelled.buffers()[2].to_pybytes()[:int(ends[-1])] if len(spelled) else b""
    if raw == b"".join(texts) and (np.diff(ends) == size).all():
        return np.ones(len(texts), bool)
    return np.fromiter((raw[s:e] == t for s, e, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts)), bool, len(texts))


def _ends(side: Side, tokens: pa.ListArray, index: str) -> pa.Table:
    """(doc, end, token number) of every token: a cumulative sum of the sizes, started anew in every text."""
    flat, parent = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    upto = pc.cumulative_sum(pc.take(side.size, flat))
    first = pa.concat_arrays([pa.array([0], pa.int64()), upto]).take(tokens.offsets.slice(0, len(tokens)))
    return pa.table({"doc": parent, "end": pc.subtract(upto, pc.take(first, parent)), index: pa.array(np.arange(len(flat)))})


def _joined(side: Side, tokens: pa.ListArray, last: np.ndarray) -> pa.Array:
    """Decimal ids of every group, comma-joined; ``last`` are the last tokens of the groups."""
    offsets = pa.array(np.concatenate([[0], last + 1]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.take(side.digits, tokens.flatten())), ",")


def align(texts: list[str], a: ByteSide, b: PieceSide) -> dict[str, pa.Array]:
    """Alignment of a run of texts: n_a, n_b, n_groups, n_links, groups_sha256 and the linked pairs
    (id of A * 65536 + id of B) in order."""
    full = [f" {t}" if t and _BLANK not in t else "" for t in texts]
    ids = [a.encode(full), b.encode(full)]
    raw = [t.encode() for t in full]
    lists = [_lists(x) for x in ids]
    good = _spelled(a, lists[0], raw) & _spelled(b, lists[1], raw)
    if not good.all():
        lists = [_lists([x if ok else x[:0] for x, ok in zip(side, good)]) for side in ids]
    links = (_ends(a, lists[0], "i").join(_ends(b, lists[1], "j"), ["doc", "end"], join_type="inner", use_threads=False)
             .sort_by([("i", "ascending"), ("j", "ascending")]))
    doc, i, j = (links[c].to_numpy() for c in ("doc", "i", "j"))
    n = np.bincount(doc, minlength=len(texts))
    new = np.ones(len(doc), bool)  # the first link of its group
    new[1:] = (i[1:] != i[:-1]) & (j[1:] != j[:-1])
    groups = np.bincount(doc[new], minlength=len(texts))
    close = np.append(np.flatnonzero(new)[1:], len(doc)) - 1 if len(doc) else np.zeros(0, np.int64)
    each = pc.binary_join_element_wise(_joined(a, lists[0], i[close]), _joined(b, lists[1], j[close]), "|")
    lines = pc.binary_join(pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(groups)]).astype(np.int32)), each), ";")
    sizes = [pc.list_value_length(x).to_numpy() for x in lists]
    pair = (pc.take(lists[0].flatten(), pa.array(i)).to_numpy().astype(np.uint32) << np.uint32(16)) | pc.take(
        lists[1].flatten(), pa.array(j)).to_numpy().astype(np.uint32)
    at = np.cumsum(n)
    return {"n_a": pa.array(sizes[0].astype(np.int64)), "n_b": pa.array(sizes[1].astype(np.int64)),
            "n_groups": pa.array(groups.astype(np.int64)), "n_links": pa.array(n.astype(np.int64)),
            "groups_sha256": pa.array([hashlib.sha256(x.as_buffer()).hexdigest() if k else "" for x, k in zip(lines, sizes[0].tolist())]),
            "pairs": pa.array([pair[e - k:e].astype("<u4").tobytes() for e, k in zip(at.tolist(), n.tolist())], pa.binary())}


_DDL = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def alignments(docs: DataFrame, key: str = "doc_id", text: str = "text", a: str = VOCAB_A, b: str = VOCAB_B) -> DataFrame:
    """One row per document: sizes, groups and the linked id pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(a, b)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts, 1 << 20):
                yield pa.RecordBatch.from_pydict({"key": batch.column(0).slice(lo, hi - lo), **align(texts[lo:hi], *sides)})
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, _DDL)


def _pairs_of(column: pa.Array) -> pa.ListArray:
    """Packed pairs as lists."""
    raw = [np.frombuffer(x or b"", "<u4") for x in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*raw, np.zeros(0, "<u4")]).astype(np.int64)))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of every id pair in all documents, and whether no pair of its B id has more."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                flat = pa.table({"pair": pc.list_flatten(_pairs_of(batch.column(0).slice(lo, 1000)))})
                got = flat.group_by("pair", use_threads=False).aggregate([([], "count_all")])
                held.append(got.rename_columns(["pair", "n"]))
            if sum(map(len, held)) > 1 << 19:
                yield from _summed(held)
                held = []
        if held:
            yield from _summed(held)

    def _summed(held: list[pa.Table]) -> list[pa.RecordBatch]:
        return (pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")])
                .rename_columns(["pair", "n"]).to_batches())

    pairs = staged(aligned.select("pairs").mapInArrow(partial, "pair long, n long")
                   .groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFF))
    most = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # one row per id of B
    return pairs.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def known_bound(counts: DataFrame, known: int) -> int:
    """The least power of two so that at most ``known`` pairs are linked at least as often."""
    level = (F.length(F.bin("n")) - 1).alias("level")
    rows = sorted(((r["level"], r["m"]) for r in counts.groupBy(level).agg(F.count(F.lit(1)).alias("m")).collect()),
                  reverse=True)  # at most 63 rows
    bound, held = 1 << 62, 0
    for at, m in rows:
        held += m
        if held > known:
            break
        bound = 1 << at
    return bound


def counted(aligned: DataFrame, counts: DataFrame, known: int = KNOWN) -> DataFrame:
    """``aligned`` (staged, with a row number ``row``) plus n_best and count_sum of the links of every row."""
    bound = known_bound(counts, known)
    often = counts.where(F.col("n") >= bound).toArrow()  # at most ``known`` rows
    order = pc.sort_indices(often["pair"])
    pair, n, best = (often[c].take(order).to_numpy() for c in ("pair", "n", "best"))
    columns = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                lists = _pairs_of(batch.column(len(columns)))
                got = (pa.table({"doc": pc.list_parent_indices(lists), "pair": pc.list_flatten(lists)})
                       .group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc"))
                doc, p, m = (got[c].to_numpy() for c in ("doc", "pair", "count_all"))
                at = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
                have = pair[at] == p if len(pair) else np.zeros(len(p), bool)
                n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                np.add.at(n_best, doc[have], m[have] * best[at[have]])
                np.add.at(total, doc[have], m[have] * n[at[have]])
                left = ~have
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[left], minlength=batch.num_rows))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in range(len(columns))] + [
                        pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(offsets, pa.array(p[left].astype(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(m[left].astype(np.int64)))],
                    names=[*columns, "n_best", "count_sum", "rare", "times"])

    ddl = "row long, " + _DDL.rsplit(",", 1)[0] + ", n_best long, count_sum long, rare array<long>, times array<long>"
    first = staged(aligned.select(*columns, "pairs").mapInArrow(run, ddl), "align-first")
    rare = (first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", "r.rare", "r.times")
            .join(counts.where(F.col("n") < bound), F.col("rare") == F.col("pair"))
            .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"),
                                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    out = first.drop("rare", "times").join(rare, "row", "left")
    return out.select(*columns, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"))


def alignment_report(docs: DataFrame, key: str = "doc_id", text: str = "text", a: str = VOCAB_A, b: str = VOCAB_B,
                     known: int = KNOWN) -> DataFrame:
    """One row per document: (key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum)."""
    aligned = staged(alignments(docs, key, text, a, b).withColumn("row", F.monotonically_increasing_id()), "align-docs")
    counts = staged(pair_counts(aligned), "align-counts")
    return counted(aligned, counts, known).drop("row").withColumnRenamed("key", key)
