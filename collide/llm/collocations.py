"""Phrase collocations from weighted acyclic automata.

Phrases of one to four words are counted by transducers over words: a path spells language, word,
word, ..., and the arc that ends a phrase emits its count.  States with the same right side (arcs,
counts and targets) are one state, so endings that many phrases share are stored once.

1. Every shard (about ``SHARD`` bytes of text) sorts its n-grams, level by level; a task unites shards
   until they hold ``CUT_ARCS`` arcs, cuts them into prefix ranges (ranges of a hash of language and first
   two words, so no common word fills a range) and builds the minimal transducer of each piece.
2. The pieces of one prefix range meet in one task, which unites them one after another: paths are
   merged in sorted order and their counts summed; phrases below the least count leave.
   The first run counts words and pairs.  The frequent pairs go into a Bloom filter of fixed
   size, and the second run counts phrases of three and four words of whose pairs none is
   ruled out (false positives of the filter add work, never results).
3. For the parts of the candidates an acceptor is built per prefix range and composed with the
   range's transducers; the paths that both have give the parts' counts.  Parts of a frequent phrase
   are frequent, so the pruned transducers hold them all.

Scores, drops and ranks are DataFrame work.  Products are taken in 38-digit decimals.

Defined results: A-Z is lower-cased; null texts are empty; a null language is ``und``; repeated rows
count each time; only text and language are read, so further columns of any name do not matter; an
empty table gives no row.  Ties of the score go by count, then by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collide.llm.common import as_bytes, give_back, keyed_join, mix, slices, span_bytes_hash, staged

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
SHARD, RANGE_BYTES, RANGES = 2 << 20, 16 << 20, 24
#: A task unites shards until they hold so many arcs before it cuts them into ranges: with more text there are more
#: ranges, and a piece for every shard and range would make their number grow with the square of the text.
CUT_ARCS = 1_000_000
BLOOM_BITS, BLOOM_HASHES = 1 << 25, 3
#: Fixed by the contract: these end a piece, and blank and tab part its words.
PIECE_ENDS, WORD_ENDS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(WORD_ENDS)] = 1
_CLASS[list(PIECE_ENDS)] = 2


# --- automata -----------------------------------------------------------------

@dataclass
class Counts:
    """Sorted phrases as levels of a prefix tree: the arcs of level k are (parent arc in level k - 1,
    label, count), sorted by parent and label; labels are places in the sorted ``symbols``."""
    symbols: pa.Array
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @property
    def arcs(self) -> int:
        return sum(len(label) for _, label, _ in self.levels)

    def pruned(self, least: int) -> Counts:
        """Phrases counted ``least`` times or more, with their prefixes."""
        need = [w >= least for _, _, w in self.levels]
        for k in range(len(need) - 1, 0, -1):
            need[k - 1][self.levels[k][0][need[k]]] = True
        rows = [np.flatnonzero(n) for n in need]
        return self.picked(rows, [w[at] >= least for (_, _, w), at in zip(self.levels, rows)])

    def picked(self, rows: list[np.ndarray], counted: list[np.ndarray]) -> Counts:
        """The arcs ``rows`` (closed under parents); counts of those that are not ``counted`` become zero."""
        levels, back = [], np.zeros(1, np.int64)
        for (parent, label, weight), at, own in zip(self.levels, rows, counted):
            levels.append((np.searchsorted(back, parent[at]) if levels else np.zeros(len(at), np.int64),
                           label[at], np.where(own, weight[at], 0)))
            back = at
        while levels and not len(levels[-1][0]):
            levels.pop()
        used = np.unique(np.concatenate([lab for _, lab, _ in levels])) if levels else np.zeros(0, np.int64)
        return Counts(self.symbols.take(pa.array(used)), [(p, np.searchsorted(used, lab), w) for p, lab, w in levels])

    def paths(self) -> list[np.ndarray]:
        """Per level the labels of every path: an array of (arcs, level + 1)."""
        out: list[np.ndarray] = []
        for parent, label, _ in self.levels:
            out.append(np.column_stack([out[-1][parent], label]) if out else label[:, None])
        return out


@dataclass
class Transducer:
    """Minimal acyclic automaton in layers; state s of a layer has the arcs first[s] to first[s + 1] - 1, each
    with (label, emitted count, state of the next layer or -1)."""
    symbols: pa.Array
    layers: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def expanded(self) -> Counts:
        """The tree of all paths."""
        levels, state, parent = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
        for first, label, weight, target in self.layers:
            n = first[state + 1] - first[state]
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - first[state], n)
            levels.append((np.repeat(parent, n), label[at], weight[at]))
            parent = np.flatnonzero(target[at] >= 0)
            state = target[at][parent]
        return Counts(self.symbols, levels)

    def compose(self, acceptor: Transducer) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]:
        """Paths that both automata have: per layer (labels of the path, this automaton's count)."""
        sym, size = self.symbols, len(self.symbols) + 1
        where = pc.index_in(acceptor.symbols, value_set=sym).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        mine, theirs, path = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, 0), np.int64)
        for (first, label, weight, target), (a_first, a_label, _, a_target) in zip(self.layers, acceptor.layers):
            n = a_first[theirs + 1] - a_first[theirs]
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - a_first[theirs], n)
            want, came = where[a_label[at]], np.repeat(np.arange(len(n)), n)
            arcs = np.repeat(np.arange(len(first) - 1), np.diff(first)) * size + label
            pos = np.searchsorted(arcs, mine[came] * size + want)
            hit = want >= 0
            hit[pos >= len(arcs)] = False
            hit[hit] = arcs[pos[hit]] == (mine[came] * size + want)[hit]
            pos, came, at = pos[hit], came[hit], at[hit]
            path = np.column_stack([path[came], label[pos]])
            out.append((path, weight[pos]))
            on = (target[pos] >= 0) & (a_target[at] >= 0)
            mine, theirs, path = target[pos][on], a_target[at][on], path[on]
        return sym, out

    def to_bytes(self) -> bytes:
        """The automaton as one compressed Arrow row."""
        def cell(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = {"symbols": cell(self.symbols)}
        for k, layer in enumerate(self.layers):
            for name, values in zip(_FIELDS, layer):
                columns[f"{name}{k}"] = cell(pa.array(values if name == "weight" else values.astype(np.int32)))
        row = pa.RecordBatch.from_pydict(columns)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(row)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def from_bytes(raw: bytes) -> Transducer:
        row = pa.ipc.open_stream(raw).read_next_batch()
        layers = [tuple(row.column(f"{name}{k}").flatten().to_numpy(zero_copy_only=False).astype(np.int64) for name in _FIELDS)
                  for k in range((row.num_columns - 1) // len(_FIELDS))]
        return Transducer(row.column("symbols").flatten(), layers)


_FIELDS = ("first", "label", "weight", "target")


def minimal(counts: Counts) -> Transducer:
    """The minimal transducer of sorted phrases: states with equal arcs become one, from the last layer up."""
    layers: list = []
    target = np.full(len(counts.levels[-1][0]) if counts.levels else 0, -1, np.int64)
    for k in range(len(counts.levels) - 1, -1, -1):
        parent, label, weight = counts.levels[k]
        above = len(counts.levels[k - 1][0]) if k else 1
        start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(parent) else np.zeros(0, np.int64)
        n = np.diff(np.append(start, len(parent)))
        sign = mix(mix(label.astype(_U) + _U(1)) ^ mix(weight.astype(_U) + _U(7) * mix(target.astype(_U))))
        total = np.add.reduceat(sign, start) if len(start) else np.zeros(0, _U)
        _, one, state = np.unique(total, return_index=True, return_inverse=True)
        # equal signatures must mean equal arcs: compare each state with the one that stands for it
        twin = one[state]
        same = n == n[twin]
        arcs = np.repeat(same, n)
        place = (np.arange(len(parent)) - np.repeat(start, n) + np.repeat(start[twin], n))[arcs]
        own = np.flatnonzero(arcs)
        equal = np.ones(len(parent), bool)
        equal[own] = (label[own] == label[place]) & (weight[own] == weight[place]) & (target[own] == target[place])
        if len(start):
            same &= np.minimum.reduceat(equal, start)
        odd = np.flatnonzero(~same)  # a signature met by chance: such a state stays on its own
        state[odd] = len(one) + np.arange(len(odd))
        stands = np.concatenate([one, odd])
        size = n[stands]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - start[stands], size)
        layers.append((np.concatenate([[0], np.cumsum(size)]), label[at], weight[at], target[at]))
        target = np.full(above, -1, np.int64)
        target[parent[start]] = state
    return Transducer(counts.symbols, layers[::-1])


def _grouped(key: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, place of every key among them, sum of the weights or number of rows of each)."""
    order = np.argsort(key)
    sorted_ = key[order]
    new = np.ones(len(key), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    start = np.flatnonzero(new)
    back = np.empty(len(key), np.int64)
    back[order] = np.cumsum(new) - 1
    if weight is None:
        total = np.diff(np.append(start, len(key)))
    else:
        total = np.add.reduceat(weight[order], start) if len(start) else np.zeros(0, np.int64)
    return sorted_[start], back, total


def union(parts: list[Counts]) -> Counts:
    """All phrases of the parts, counts of equal ones summed."""
    parts = [p for p in parts if p.levels]
    if not parts:
        return Counts(pa.array([], pa.binary()), [])
    symbols, ids = _symbols(pa.concat_arrays([p.symbols for p in parts]))
    renamed = np.split(ids, np.cumsum([len(p.symbols) for p in parts])[:-1])
    levels, place = [], [np.zeros(1, np.int64) for _ in parts]
    for k in range(max(len(p.levels) for p in parts)):
        have = [i for i, p in enumerate(parts) if k < len(p.levels)]
        key = np.concatenate([place[i][parts[i].levels[k][0]] * len(symbols) + renamed[i][parts[i].levels[k][1]] for i in have])
        weight = np.concatenate([parts[i].levels[k][2] for i in have])
        uniq, back, total = _grouped(key, weight)
        levels.append((uniq // len(symbols), uniq % len(symbols), total))
        cut = np.cumsum([len(parts[i].levels[k][0]) for i in have])[:-1]
        for i, at in zip(have, np.split(back, cut)):
            place[i] = at
    return Counts(symbols, levels)


def of_paths(languages: list, phrases: list) -> Counts:
    """The tree of given phrases (blank-separated words), each counted as often as it is listed."""
    split = pc.split_pattern(pa.array(phrases, pa.string()).cast(pa.string()), " ")
    n = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    symbols, ids = _symbols(pa.concat_arrays([pc.list_flatten(split).cast(pa.binary()),
                                              pa.array(languages, pa.string()).cast(pa.binary())]))
    words, lang = ids[:int(n.sum())], ids[int(n.sum()):]
    first = np.cumsum(n) - n
    levels, code = [], np.zeros(len(n), np.int64)
    for k in range(int(n.max()) + 1 if len(n) else 0):
        live = np.flatnonzero(n >= k)
        key = code[live] * len(symbols) + (words[first[live] + k - 1] if k else lang[live])
        uniq, back = np.unique(key, return_inverse=True)
        weight = np.bincount(back, weights=n[live] == k, minlength=len(uniq)).astype(np.int64)
        levels.append((uniq // len(symbols), uniq % len(symbols), weight))
        code[live] = back
    return Counts(symbols, levels)


# --- texts --------------------------------------------------------------------

def _symbols(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(sorted distinct words, place of each word among them)."""
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


def read_words(texts: list[bytes], languages: list[str]):
    """(symbols, language of each word, word, piece of each word) of a run of texts, in order."""
    buf = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _CLASS[buf]
    word = kind == 0
    edge = np.diff(word.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    doc = np.searchsorted(np.cumsum(lens + 1), starts, side="right")
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[word])])
    names = pa.array(languages, pa.string()).cast(pa.binary())
    symbols, ids = _symbols(pa.concat_arrays([words, names]))
    return symbols, ids[len(starts):][doc], ids[:len(starts)], piece


def _hashes(symbols: pa.Array) -> np.ndarray:
    """A 64-bit hash of every symbol."""
    size = pc.binary_length(symbols).to_numpy(zero_copy_only=False).astype(np.int64)
    out, some = np.zeros(len(size), _U), np.flatnonzero(size)
    if len(some):
        ends = np.cumsum(size)
        buf = np.frombuffer(pa.concat_arrays([symbols]).buffers()[2], np.uint8)[:ends[-1]]
        out[some] = span_bytes_hash(buf, (ends - size)[some], ends[some], lower=False)
    return out


def _prefix_hash(h: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Hash of language and first two words of each path (language, word, ...)."""
    x = mix(h[path[:, 0]] + _U(1))
    for k in range(1, min(path.shape[1], 3)):
        x = mix(x * _U(0x9E3779B97F4A7C15) + h[path[:, k]])
    return x


def ranges_of(counts: Counts, ranges: int) -> list[np.ndarray]:
    """Prefix range (of ``_prefix_hash``) of every path of one word or more (-1 for the language level)."""
    h, x, out = _hashes(counts.symbols), np.zeros(0, _U), []
    for k, (parent, label, _) in enumerate(counts.levels):
        if k < 3:
            x = mix(x[parent] * _U(0x9E3779B97F4A7C15) + h[label]) if k else mix(h[label] + _U(1))
            top = ((x >> _U(32)).astype(np.int64) * ranges) >> 32 if k else np.full(len(label), -1, np.int64)
        else:  # as the path of two words that it begins with
            top = out[-1][parent]
        out.append(top)
    return out


def shard(texts: list[bytes], languages: list[str], lengths: range, bloom: np.ndarray | None) -> Counts:
    """The counted phrases of ``lengths`` words of one shard; longer ones only where the filter allows every pair."""
    symbols, lang, word, piece = read_words(texts, languages)
    size = len(symbols)
    code, at = lang, np.arange(len(word))
    present = np.unique(lang)
    levels = [(np.zeros(len(present), np.int64), present, np.zeros(len(present), np.int64))]
    code = np.searchsorted(present, lang)
    pair = np.ones(len(word), bool)  # does a pair that the filter allows begin at this word?
    pair[-1:] = False
    if len(word) > 1:
        pair[:-1] = piece[1:] == piece[:-1]
    if bloom is not None and pair.any():
        h, b = _hashes(symbols), np.flatnonzero(pair)
        path = np.column_stack([lang[b], word[b], word[b + 1]])
        pair[b] = in_bloom(bloom, _prefix_hash(h, path))
    run = np.ones(len(word), bool)  # do phrases of the current length begin here?
    if bloom is not None:  # only the beginnings of counted phrases are wanted
        run[:] = pair
        run[:-1] &= pair[1:]
        run[-1:] = False
        at = np.flatnonzero(run)
        code = code[at]
    for k in range(1, lengths.stop):
        if k > 1:
            on = pair[at + k - 2]
            at, code = at[on], code[on]
        key = code * size + word[at + k - 1]
        uniq, code, weight = _grouped(key)
        levels.append((uniq // size, uniq % size, weight if k in lengths else np.zeros_like(weight)))
        if not len(at):
            break
    return Counts(symbols, levels)


def cut(counts: Counts, ranges: int) -> Iterator[tuple[int, Counts]]:
    """(range, its phrases), each with the prefixes that lead to them."""
    if len(counts.levels) < 2:
        return
    of = ranges_of(counts, ranges)
    own = [np.where(w > 0, r, -1).astype(np.int16 if ranges < 1 << 15 else np.int64) for r, (_, _, w) in zip(of, counts.levels)]
    order = [np.argsort(o, kind="stable") for o in own]
    edges = [np.searchsorted(o[i], np.arange(ranges + 1)) for o, i in zip(own, order)]
    for b in range(ranges):
        rows: list = [None] * len(own)
        lead = np.zeros(0, np.int64)
        for k in range(len(own) - 1, -1, -1):
            mine = order[k][edges[k][b]:edges[k][b + 1]]
            rows[k] = np.unique(np.concatenate([mine, lead])) if len(lead) else mine
            lead = counts.levels[k][0][rows[k]]
        if len(rows[0]):
            yield b, counts.picked(rows, [o[at] == b for o, at in zip(own, rows)])


# --- the filter of frequent pairs ---------------------------------------------

def _bloom_places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(h + _U(i + 1)) % _U(bits)).astype(np.int64) for i in range(BLOOM_HASHES)]


def in_bloom(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for at in _bloom_places(h, 8 * len(bloom)):
        ok &= (bloom[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return ok


def pair_filter(pairs: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """Bloom filter, of ``bits`` bits whatever the input, of the phrases of two words in (lang, phrase)."""
    def places(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            tree = of_paths(pdf["lang"].tolist(), pdf["phrase"].tolist())
            h = _prefix_hash(_hashes(tree.symbols), tree.paths()[2]) if len(tree.levels) > 2 else np.zeros(0, _U)
            at = np.concatenate(_bloom_places(h, bits))
            yield pd.DataFrame({"byte": at >> 3, "bit": np.left_shift(1, at & 7)})
    rows = (pairs.select("lang", "phrase").mapInPandas(places, "byte long, bit long")
            .groupBy((F.col("byte") / 8).cast("long").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(bit, cast(8 * (byte % 8) as int))")).alias("x")))
    got = rows.toArrow()  # at most bits / 64 rows
    bloom = np.zeros(bits // 64, np.int64)
    bloom[got["word"].to_numpy()] = got["x"].to_numpy()
    return bloom.view(np.uint8)


# --- Spark --------------------------------------------------------------------

def _unite(pending: list[Counts], most: int = 1 << 18) -> list[Counts]:
    """Unite the pieces so far once the new ones hold as many arcs as the first (the union of all before), and
    ``most`` at least: every arc takes part in few unions."""
    size = [len(p.levels[-1][0]) if p.levels else 0 for p in pending]
    return [union(pending)] if sum(size[1:]) > max(most, size[0]) else pending


def pieces(docs: DataFrame, lengths: range, ranges: int, bloom: np.ndarray | None = None, lang: str = "lang",
           text: str = "text", shard_bytes: int = SHARD, cut_arcs: int = CUT_ARCS) -> DataFrame:
    """(range, automaton): the phrases of ``lengths`` words that a task counted, cut by prefix range."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(whole):
            found = [(b, minimal(c).to_bytes()) for b, c in cut(whole, ranges)]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()),
                                               pa.array([x for _, x in found], pa.binary())], names=["range", "automaton"])
        texts: list[bytes] = []
        langs: list[str] = []
        pending: list[Counts] = []
        held = 0
        try:
            for batch in batches:
                size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
                for lo, hi in slices([range(n) for n in size], shard_bytes):  # only a shard's texts leave Arrow
                    texts += as_bytes(batch.column(1).slice(lo, hi - lo))
                    langs += batch.column(0).slice(lo, hi - lo).to_pylist()
                    held += sum(size[lo:hi])
                    if held >= shard_bytes // 2:
                        pending.append(shard(texts, langs, lengths, bloom))
                        texts, langs, held = [], [], 0
                        if sum(p.arcs for p in pending) >= cut_arcs:
                            pending = [union(pending)]
                            if pending[0].arcs >= cut_arcs // 2:
                                yield out(pending[0])
                                pending = []
                            give_back()
            if texts:
                pending.append(shard(texts, langs, lengths, bloom))
            if pending:
                yield out(union(pending))
        finally:
            give_back()

    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).cast("string").alias("text")).mapInArrow(shards, "range int, automaton binary")


def transducers(docs: DataFrame, lengths: range, ranges: int, bloom: np.ndarray | None = None, least: int = LEAST,
                **options) -> DataFrame:
    """(range, totals, automaton): per prefix range the united transducer of the phrases of ``lengths`` words
    that are counted ``least`` times or more, and the words counted per language; ``options`` are those of ``pieces``."""
    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pending = None, []

        def out():
            whole = union(pending)
            totals: dict[str, int] = {}
            if len(whole.levels) > 1:
                names = whole.symbols.take(pa.array(whole.levels[0][1])).cast(pa.string()).to_pylist()
                parent, _, weight = whole.levels[1]
                totals = dict(zip(names, np.bincount(parent, weights=weight, minlength=len(names)).astype(np.int64).tolist()))
            return pa.RecordBatch.from_arrays([
                pa.array([now], pa.int32()), pa.array([list(totals.items())], pa.map_(pa.string(), pa.int64())),
                pa.array([minimal(whole.pruned(least)).to_bytes()], pa.binary())], names=["range", "totals", "automaton"])

        try:
            for batch in batches:
                for b, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if b != now and pending:
                        yield out()
                        pending = []
                    now = b
                    pending = _unite([*pending, Transducer.from_bytes(raw.as_py()).expanded()])
            if pending:
                yield out()
        finally:
            give_back()

    return (pieces(docs, lengths, ranges, bloom, **options).repartition(ranges, "range").sortWithinPartitions("range")
            .mapInArrow(unite, "range int, totals map<string,long>, automaton binary"))


def _phrases(symbols: pa.Array, path: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(language, phrase) of paths."""
    part = [symbols.take(pa.array(path[:, k])) for k in range(path.shape[1])]
    return part[0].cast(pa.string()), pc.binary_join_element_wise(*part[1:], pa.scalar(b" ", pa.binary())).cast(pa.string())


_COUNT_DDL = "lang string, phrase string, n_words int, f long"


def _rows(found: Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for symbols, path, weight in found:
        lang, phrase = _phrases(symbols, path)
        yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(weight), path.shape[1] - 1, np.int32)),
                                          pa.array(weight, pa.int64())], names=["lang", "phrase", "n_words", "f"])


def phrases(automata: DataFrame) -> DataFrame:
    """(lang, phrase, n_words, f): every counted phrase of stored transducers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for batch in batches:
                for raw in batch.column(0):
                    tree = Transducer.from_bytes(raw.as_py()).expanded()
                    for path, (_, _, w) in list(zip(tree.paths(), tree.levels))[1:]:
                        yield tree.symbols, path[w > 0], w[w > 0]
        yield from _rows(found())
    return automata.select("automaton").mapInArrow(run, _COUNT_DDL)


def lookups(parts: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """(lang, phrase, n_words, f) of the distinct (lang, part) rows, by composing an acceptor of the parts of each
    prefix range with the transducers of that range."""
    def placed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            tree = of_paths(pdf["lang"].tolist(), pdf["part"].tolist())
            of = ranges_of(tree, ranges)
            for symbols, path, weight, r in ((tree.symbols, p, w, o) for p, (_, _, w), o in
                                             list(zip(tree.paths(), tree.levels, of))[1:]):
                if not (weight > 0).any():  # an empty frame has no string columns
                    continue
                lang, phrase = _phrases(symbols, path[weight > 0])
                yield pd.DataFrame({"lang": lang.to_pylist(), "part": phrase.to_pylist(), "range": r[weight > 0].astype(np.int32)})

    def composed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        acceptor = minimal(of_paths(left["lang"].tolist(), left["part"].tolist())) if len(left) else None
        out = []
        for raw in right["automaton"] if acceptor else []:
            sym, layers = Transducer.from_bytes(raw).compose(acceptor)
            wanted = [(sym, path[w > 0], w[w > 0]) for path, w in layers[1:]]
            out += [b.to_pandas() for b in _rows(iter(wanted))]
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "phrase": [], "n_words": [], "f": []}).astype(
            {"lang": object, "phrase": object, "n_words": "int32", "f": "int64"})

    asked = parts.mapInPandas(placed, "lang string, part string, range int")
    return asked.groupBy("range").cogroup(automata.select("range", "automaton").groupBy("range")).applyInPandas(composed, _COUNT_DDL)


def _ranges(docs: DataFrame, text: str, ranges: int | None) -> int:
    if ranges:
        return ranges
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(RANGES, -(-size // RANGE_BYTES))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP,
                 covered: int = COVERED, ranges: int | None = None, shard_bytes: int = SHARD,
                 bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """The ``top`` phrases per language: (lang, rank, phrase, a, l, r, n, score)."""
    ranges = _ranges(docs, text, ranges)
    own = {"least": least, "lang": lang, "text": text, "shard_bytes": shard_bytes}
    short = staged(transducers(docs, range(1, 3), ranges, **own), "col-short")
    n_words = (short.select(F.explode("totals").alias("lang", "n")).groupBy("lang").agg(F.sum("n").alias("n")))
    few = phrases(short)
    bloom = pair_filter(few.where("n_words = 2"), bloom_bits)
    long = staged(transducers(docs, range(3, LONGEST + 1), ranges, bloom, **own), "col-long")
    automata = short.select("range", "automaton").union(long.select("range", "automaton"))
    found = staged(phrases(automata), "col-phrases")
    cand = found.where("n_words > 1").withColumnRenamed("f", "a")

    # cuts: the parts' counts by composition, then the lowest score
    words = F.split("phrase", " ")
    cuts = (cand.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.explode(F.array(
                F.struct(F.lit(0).alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("part")),
                F.struct(F.lit(1).alias("side"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("part"))))
                .alias("p")).select("lang", "phrase", "a", "k", "p.side", F.struct("lang", "p.part").alias("part")))
    asked = staged(cuts.groupBy("part").agg(F.count(F.lit(1)).alias("weight")), "col-parts")
    counted = lookups(asked.select("part.lang", "part.part"), automata, ranges)
    counted = counted.select(F.struct("lang", F.col("phrase").alias("part")).alias("part"), "f").join(asked, "part")
    cut_rows = keyed_join(cuts, staged(counted, "col-counted"), "part")
    score = F.expr("cast((cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r) as long)")
    scored = (cut_rows.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
                                                               F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
              .withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
              .select("lang", "phrase", "a", "s.*"))

    # phrases that a longer one covers
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n_words") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    over = (found.where("n_words > 2").select("lang", F.explode(inner).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(over, ["lang", "phrase"], "left")
            .where(F.expr(f"longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {covered}")))
    return _top(staged(kept.drop("longer", "k"), "col-scored"), n_words, top)


def _top(scored: DataFrame, n_words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language.  A histogram of the scores (at most a thousand classes a
    language) first finds the class in which the last of them lies, so the ranking sees few rows more."""
    step = F.floor(F.col("score") / 1000)
    by = scored.groupBy("lang", step.alias("c")).agg(F.count(F.lit(1)).alias("m"))
    by = by.select("lang", "c", "m", F.expr("sum(m) over (partition by lang order by c desc)").alias("upto"))
    last = by.where(F.col("upto") - F.col("m") < top).groupBy("lang").agg(F.min("c").alias("last"))
    ranked = (scored.join(last, "lang").where(step >= F.col("last"))
              .withColumn("rank", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)"))
              .where(F.col("rank") <= top))
    return ranked.join(n_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS p1, array_to_string(w[c + 1:], ' ') AS p2
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT u.lang, u.phrase, u.a, u.c, x.f AS l, y.f AS r, (2000000::HUGEINT * u.a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.p1 JOIN f y ON y.lang = u.lang AND y.phrase = u.p2),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))
  GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept k JOIN n ON n.lang = k.lang
QUALIFY rank <= 2000
"""
