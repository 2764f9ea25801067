"""Quality rules: fixed base rules, and a hashed word and character n-gram logistic regression.

The classifier reads the relative frequencies of hashed word 1- and 2-grams and of
hashed byte 3- and 5-grams of the whole text, is trained on labelled rows
(at most ``per_class`` rows of each label, taken by a hash of the id), calibrated by
Platt scaling on rows it was not trained on, shifted to the label prior of all labelled
rows, and scored in Arrow batches against one fixed threshold.

Defined results: null or empty text has no words, fails the base rules and is not
kept; with labels, or labelled documents, of one class only the verdict is "kept" for that
class 1 and "not kept" for class 0; without labels, or without a labelled document, everything
that passes the base rules is kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collide.llm.common import _SPACE, as_bytes, give_back, mix, shingle_hashes, slices, span_bytes_hash, word_spans

DIM_BITS = 16
PER_CLASS = 1500
THRESHOLD = 0.5
#: Bytes of text that a task turns into Python strings and arrays at a time (about a hundred times as much memory).
SLICE = 1 << 18
#: Fixed by the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_STRIP = " \t\n\x0b\x0c\r"
_U = np.uint64
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


def _per_doc(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


def _repeat_words(h: np.ndarray, doc: np.ndarray, n: int, docs: int, k: int = 3) -> np.ndarray:
    """Words per text that lie in a k-word window found twice or more in that text."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(docs, np.int64)
    odd = _U(0x9E3779B97F4A7C15)
    acc = mix(doc[:m].astype(_U))
    for i in range(k):
        acc = mix(acc * odd + h[i:m + i])
    acc[doc[:m] != doc[k - 1:]] = 0
    order = np.argsort(acc, kind="stable")
    a = acc[order]
    same = np.zeros(m, bool)
    eq = (a[1:] == a[:-1]) & (a[1:] != 0)
    same[1:] |= eq
    same[:-1] |= eq
    hit = np.zeros(len(h), bool)
    for i in range(k):
        hit[order[same] + i] = True
    return np.bincount(doc[hit], minlength=docs)


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    seen = Counter(line for line in text.split("\n") if line.strip(_STRIP))
    return sum(seen.values()) - len(seen)


@dataclass
class Features:
    """Of a run of texts: base columns, and hashed n-gram indices with their text."""

    base: np.ndarray
    words: np.ndarray
    word_doc: np.ndarray
    chars: np.ndarray
    char_doc: np.ndarray


def features(texts: list[str], raw: list[bytes], dim_bits: int = DIM_BITS, grams: bool = True) -> Features:
    docs = len(texts)
    buf, starts, ends, doc, n_words = word_spans(raw)
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in raw), np.int64, docs))
    h = span_bytes_hash(buf, starts, ends, lower=False)
    lead = (buf & 0xC0) != 0x80
    base = np.stack([n_words, _per_doc(lead & ~_SPACE[buf], stops), _per_doc(_IS_SYMBOL[buf], stops),
                     np.fromiter((_dup_lines(t) for t in texts), np.int64, docs),
                     _repeat_words(h, doc, 3, docs)])
    if not grams:
        none = np.zeros(0, np.uint32)
        return Features(base, none, none, none, none)
    shift = _U(64 - dim_bits + 1)  # words use the lower half of the table, signs the upper half
    two, two_doc = shingle_hashes(h, doc, n_words, 2)
    words = np.concatenate([mix(h) >> shift, two >> shift]).astype(np.uint32)
    word_doc = np.concatenate([doc, two_doc])
    chars, char_doc = [], []
    byte_doc = np.repeat(np.arange(docs), np.diff(np.concatenate([[0], stops])))
    for k in (3, 5):
        m = len(buf) - k + 1
        if m <= 0:
            continue
        acc = np.full(m, _U(k))
        for i in range(k):
            acc = (acc << _U(8)) | buf[i:m + i]
        ok = (byte_doc[:m] == byte_doc[k - 1:]) & (buf[k - 1:] != 10) if k > 1 else slice(None)
        chars.append(((mix(acc[ok]) >> shift) + _U(1 << (dim_bits - 1))).astype(np.uint32))
        char_doc.append(byte_doc[:m][ok])
    if not chars:
        chars, char_doc = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    return Features(base, words, word_doc, np.concatenate(chars), np.concatenate(char_doc))


def margins(f: Features, docs: int, weight: np.ndarray, bias: float) -> np.ndarray:
    """Linear score: mean weight of the word grams plus mean weight of the character grams."""
    out = np.full(docs, bias)
    for idx, doc in ((f.words, f.word_doc), (f.chars, f.char_doc)):
        n = np.bincount(doc, minlength=docs)
        out += np.bincount(doc, weights=weight[idx], minlength=docs) / np.maximum(n, 1)
    return out


@dataclass
class Model:
    """weight, bias: the regression; slope, shift: its calibration (the prior included)."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def _fit_logistic(rows: list[np.ndarray], value: list[np.ndarray], y: np.ndarray, dim: int, l2: float, steps: int,
                  block: int = 250):
    """Full-batch Adam on sparse rows (indices, values), read in blocks so that temporaries stay small.
    Both lists are emptied as the blocks are made, so that no row is held twice."""
    parts = []
    for lo in range(0, len(y), block):
        size = np.array([len(r) for r in rows[lo:lo + block]])
        parts.append((slice(lo, lo + len(size)), np.concatenate(rows[lo:lo + block]), np.concatenate(value[lo:lo + block]),
                      np.repeat(np.arange(len(size), dtype=np.int16), size)))
        rows[lo:lo + block] = value[lo:lo + block] = [None] * len(size)
    give_back()
    w, b = np.zeros(dim), 0.0
    m1, m2, c1, c2 = np.zeros(dim), np.zeros(dim), 0.0, 0.0
    for t in range(1, steps + 1):
        g, gb = l2 * w, 0.0
        for at, idx, val, doc in parts:
            z = np.bincount(doc, weights=w[idx] * val, minlength=at.stop - at.start) + b
            r = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[at]) / len(y)
            g += np.bincount(idx, weights=val * r[doc], minlength=dim)
            gb += r.sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        c1, c2 = 0.9 * c1 + 0.1 * gb, 0.999 * c2 + 0.001 * gb * gb
        k1, k2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - 2.0 * (m1 / k1) / (np.sqrt(m2 / k2) + 1e-8)
        b = b - 0.1 * (c1 / k1) / (np.sqrt(c2 / k2) + 1e-8)
    return w, b


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic calibration, by Newton steps on Platt's smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([z, np.ones_like(z)])
    scale = max(np.abs(z).std(), 1e-9)
    a = np.array([1 / scale, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ x, -30, 30)))
        grad = x @ (p - target)
        hess = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a = a - np.clip(step, -2 / scale - 2, 2 / scale + 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(a[0]), float(a[1])


def _sampled(labelled: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each label, the first in the order of a hash of the key."""
    order = F.xxhash64(F.lit("quality"), F.col(key))
    parts = [labelled.where(F.col(label) == v).orderBy(order, key).limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def _constant(dim_bits: int, keep: bool) -> Model:
    return Model(np.zeros(1 << dim_bits), 0.0, 0.0, 40.0 if keep else -40.0)


def _text_slices(column: pa.Array, budget: int | None = None) -> Iterator[tuple[int, list[str], list[bytes]]]:
    """(first row, texts, their bytes) of runs of about ``budget`` bytes: the other rows stay in Arrow."""
    size = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for lo, hi in slices([range(n) for n in size], budget or SLICE):
        part = column.slice(lo, hi - lo)
        yield lo, [t or "" for t in part.to_pylist()], as_bytes(part)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = PER_CLASS, dim_bits: int = DIM_BITS, l2: float = 1e-7, steps: int = 120) -> Model:
    """Train and calibrate.  The sample (at most 2 * ``per_class`` rows) is featurised on the
    executors; only its n-gram indices (two bytes each) come to the driver."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    prior = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(prior) < 2:
        return _constant(dim_bits, not prior or 1 in prior)
    picked = F.broadcast(_sampled(known, "y", "k", per_class))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(picked, "k")

    index = "<u2" if dim_bits <= 16 else "<u4"

    def grams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in it:
                for lo, texts, raw in _text_slices(b.column("t")):
                    f, n = features(texts, raw, dim_bits), len(texts)
                    out = [[] for _ in range(n)]
                    for idx, doc in ((f.words, f.word_doc), (f.chars, f.char_doc)):
                        ends = np.cumsum(np.bincount(doc, minlength=n))
                        for row, own in zip(out, np.split(idx[np.argsort(doc, kind="stable")], ends[:-1])):
                            u, c = np.unique(own, return_counts=True)
                            row += [u.astype(index).tobytes(), (c / max(c.sum(), 1)).astype("<f4").tobytes()]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in zip(*out)), b.column("k").slice(lo, n),
                                                      b.column("y").slice(lo, n)], names=["wi", "wv", "ci", "cv", "k", "y"])
        finally:
            give_back()

    got = rows.select(F.col("k").cast("long"), F.col("t").cast("string"), "y").mapInArrow(
        grams, "wi binary, wv binary, ci binary, cv binary, k long, y int").toPandas()
    got = got.sort_values("k", kind="stable").drop_duplicates("k").reset_index(drop=True)
    y, idx, val = got["y"].to_numpy(float), [], []
    wi, wv, ci, cv = (got.pop(c).tolist() for c in ("wi", "wv", "ci", "cv"))
    for i in range(len(y)):  # a row's bytes go as soon as its arrays are made
        idx.append(np.concatenate([np.frombuffer(wi[i], index), np.frombuffer(ci[i], index)]))
        val.append(np.concatenate([np.frombuffer(wv[i], "<f4"), np.frombuffer(cv[i], "<f4")]))
        wi[i] = ci[i] = wv[i] = cv[i] = None
    del got
    if len(set(y)) < 2:  # no labelled document, or documents of one label only
        return _constant(dim_bits, not len(y) or y[0] == 1)
    held = mix(np.arange(len(y), dtype=_U)) % _U(4) == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    cal = np.flatnonzero(held) if held.any() else train
    judged = [(idx[i], val[i]) for i in cal]
    rows, value = [idx[i] for i in train], [val[i] for i in train]
    del idx, val
    w, b = _fit_logistic(rows, value, y[train], 1 << dim_bits, l2, steps)
    z = np.array([float((w[i] * v).sum()) for i, v in judged]) + b
    slope, shift = platt(z, y[cal])
    pos, neg = y[cal].sum(), len(cal) - y[cal].sum()
    shift += np.log(prior[1] / prior[0]) - np.log(pos / neg)  # from the balanced sample to all labels
    return Model(w, b, slope, float(shift))


_OUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, p_good double"


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` plus a struct of the base columns and the calibrated probability of good quality."""
    @F.arrow_udf(_OUT)
    def scored(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = int(np.log2(len(model.weight)))
        names = [c.split()[0] for c in _OUT.split(", ")]
        try:
            for s in it:
                parts = []
                for _, texts, raw in _text_slices(s):
                    f = features(texts, raw, bits)
                    parts.append(np.vstack([f.base, model.probability(margins(f, len(texts), model.weight, model.bias))]))
                got = np.hstack(parts) if parts else np.zeros((6, 0))
                yield pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in got[:5]] + [pa.array(got[5])], names=names)
        finally:
            give_back()
    return docs.withColumn(out, scored(F.col(text).cast("string")))


def verdict(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD,
            out: str = "quality") -> DataFrame:
    """``score`` plus ``base_failed`` and ``kept`` inside the struct."""
    q = F.col(out)
    failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    return (score(docs, model, text, out).withColumn(out, q.withField("base_failed", failed))
            .withColumn(out, q.withField("kept", ~q["base_failed"] & (q["p_good"] >= threshold))))
