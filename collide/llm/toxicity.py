"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence's score is p = sigmoid(bias + sum of the weights of its hashed word 1- and
2-grams and word beginnings); a document's score is the noisy-or 1 - prod(1 - p) of its sentences.  Only
document labels are seen in training; the gradient of the noisy-or spreads a document's
label over its sentences, so afterwards the sentences themselves can be judged and
the offending ones located.

Training rows: at most ``per_class`` labelled documents of each label, the first by a hash
of the id.  An L1 penalty leaves grams without broad evidence at weight 0.  Words are runs
of letters, digits and apostrophes, lower-cased in ASCII; sentences end at . ! ? and at
line ends.

Defined results: null and empty texts have no sentence and score the smallest value (0.0);
labels of one class only give a constant model; without labels every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collide.llm.common import as_bytes, mix, slices, span_bytes_hash, word_spans

DIM_BITS = 18
PER_CLASS = 1200
PREFIXES = (3, 4, 5, 6)
_U = np.uint64
_B = np.arange(256)
_GAP = ~(((_B >= 48) & (_B < 58)) | ((_B >= 65) & (_B < 91)) | ((_B >= 97) & (_B < 123)) | (_B >= 128) | (_B == 39))
_STOP = np.isin(_B, np.frombuffer(b".!?\n", np.uint8))


@dataclass
class Bags:
    """Of a run of texts: hashed grams, the sentence of each gram, the text of each sentence, and
    the byte span of each sentence (its first to its last word) in the joined buffer."""

    gram: np.ndarray
    sentence: np.ndarray
    doc: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    buf: np.ndarray


def bags(raw: list[bytes], dim_bits: int = DIM_BITS) -> Bags:
    buf, starts, ends, doc, _ = word_spans(raw, _GAP)
    shift = _U(64 - dim_bits)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return Bags(z, z, z, z, z, buf)
    h = span_bytes_hash(buf, starts, ends)
    stop = np.searchsorted(np.flatnonzero(_STOP[buf]), starts)
    new = np.concatenate([[True], stop[1:] != stop[:-1]])
    sent = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    two = mix(h[:-1] * _U(0x9E3779B97F4A7C15) + h[1:])[~new[1:]]
    grams, owner = [mix(h), two], [sent, sent[1:][~new[1:]]]
    for k in PREFIXES:  # compounds and inflected forms share the beginning of a word
        far = np.flatnonzero(ends - starts > k)
        grams.append(mix(span_bytes_hash(buf, starts[far], starts[far] + k) + _U(k)))
        owner.append(sent[far])
    gram = (np.concatenate(grams) >> shift).astype(np.int64)
    sentence = np.concatenate(owner)
    return Bags(gram, sentence, doc[first], starts[first], np.append(ends[first[1:] - 1], ends[-1]), buf)


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def sentences(self, b: Bags) -> np.ndarray:
        return self.bias + np.bincount(b.sentence, weights=self.weight[b.gram], minlength=len(b.doc))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def noisy_or(z: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """1 - prod(1 - sigmoid(z)) per document: the sum of -log(1 - p) is the sum of softplus(z)."""
    return -np.expm1(-np.bincount(doc, weights=softplus(z), minlength=docs))


def train(gram: np.ndarray, sentence: np.ndarray, doc: np.ndarray, y: np.ndarray, dim: int, min_docs: int = 3,
          l1: float = 3e-4, l2: float = 2e-5, steps: int = 100, share: float = 0.5) -> Model:
    """Proximal gradient steps (per-gram step sizes) on the noisy-or log likelihood of the document
    labels; the toxic label weighs ``share`` in all, as in the whole of the labels.  A first run with an L1 penalty picks the grams that
    have evidence; a second run fits these alone under a slight L2 penalty."""
    pair = np.unique(gram.astype(np.int64) * len(y) + doc[sentence])
    usable = np.bincount(pair // len(y), minlength=dim) >= min_docs
    pos = max(y.sum(), 1)
    weight = np.where(y > 0, share / pos, (1 - share) / max(len(y) - pos, 1))

    def run(pick: np.ndarray, b: float, lam: float, l2: float, rounds: int):
        """Fit the grams of ``pick`` (the others keep weight 0)."""
        place = np.full(dim, -1)
        place[pick] = np.arange(len(pick))
        held = place[gram] >= 0
        g_of, s_of = place[gram[held]], sentence[held]
        w = np.zeros(len(pick))
        m1, m2, c1, c2 = np.zeros(len(pick)), np.zeros(len(pick)), 0.0, 0.0
        for t in range(1, rounds + 1):
            z = b + np.bincount(s_of, weights=w[g_of], minlength=len(doc))
            s = np.maximum(np.bincount(doc, weights=softplus(z), minlength=len(y)), 1e-12)
            outer = np.where(y > 0, -1 / np.expm1(np.minimum(s, 500)), 1.0) * weight  # d loss / d s
            gz = outer[doc] / (1 + np.exp(-np.clip(z, -40, 40)))
            g, gb = np.bincount(g_of, weights=gz[s_of], minlength=len(pick)) + l2 * w, gz.sum()
            m1, m2 = 0.8 * m1 + 0.2 * g, 0.99 * m2 + 0.01 * g * g
            c1, c2 = 0.8 * c1 + 0.2 * gb, 0.99 * c2 + 0.01 * gb * gb
            k1, k2 = 1 - 0.8 ** t, 1 - 0.99 ** t
            rate = 0.5 * (1 - t / (rounds + 1))
            step = rate / (np.sqrt(m2 / k2) + 1e-6)
            w = w - step * m1 / k1
            w = np.sign(w) * np.maximum(np.abs(w) - step * lam, 0)
            b = b - rate * (c1 / k1) / (np.sqrt(c2 / k2) + 1e-6)
        return w, float(b)

    pick = np.flatnonzero(usable)
    w, b = run(pick, -5.0, max(l1, 0.5 * share / pos), 0.0, steps)
    pick = pick[w != 0]
    w, b = run(pick, b, 0.0, l2, 2 * steps)
    out = np.zeros(dim)
    out[pick] = w
    return Model(out, b)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = PER_CLASS, dim_bits: int = DIM_BITS, **options) -> Model:
    """Train on a bounded sample: executors make the bags, their gram numbers come to the driver."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    share = known.agg(F.avg("y")).first()[0]
    order = F.xxhash64(F.lit("toxic"), F.col("k"))
    parts = [known.where(F.col("y") == v).orderBy(order, "k").limit(per_class) for v in (0, 1)]
    picked = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * per_class rows

    def bagged(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            raw, out = as_bytes(pdf["t"]), []
            for t in raw:
                b = bags([t], dim_bits)
                out.append((b.gram.astype("<u4").tobytes(), b.sentence.astype("<u4").tobytes(), len(b.doc)))
            yield pd.DataFrame(out, columns=["g", "s", "n"]).assign(k=pdf["k"].to_numpy(), y=pdf["y"].to_numpy())

    got = (docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(picked, "k")
           .mapInPandas(bagged, "g binary, s binary, n long, k long, y int").toPandas())
    got = got.sort_values("k", kind="stable").drop_duplicates("k").reset_index(drop=True)
    dim = 1 << dim_bits
    y = got["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(dim), 10.0 if len(y) and y.max() > 0 else -np.inf)
    # grams of fewer than three documents get no weight: they are left out before the arrays are joined
    held = np.zeros(dim, np.int32)
    for g in got["g"]:
        held[np.unique(np.frombuffer(g, "<u4"))] += 1
    keep = [held[np.frombuffer(g, "<u4")] >= 3 for g in got["g"]]
    first = (got["n"].cumsum() - got["n"]).to_numpy(np.int32)
    gram = np.concatenate([np.frombuffer(g, "<u4")[k].astype(np.int32) for g, k in zip(got["g"], keep)])
    sentence = np.concatenate([np.frombuffer(s, "<u4")[k].astype(np.int32) + o for s, o, k in zip(got["s"], first, keep)])
    n = got["n"].to_numpy()
    del got, keep
    return train(gram, sentence, np.repeat(np.arange(len(y)), n), y, dim, share=share, **options)


_OUT = "score double, sentences array<struct<lo:int,hi:int,p:double>>"


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity", threshold: float = 0.5) -> DataFrame:
    """``docs`` plus a struct: the document score, and the offending sentences (code-point spans
    [lo, hi) and their p >= ``threshold``)."""
    @F.pandas_udf(_OUT)
    def scored(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits = int(np.log2(len(model.weight)))
        for s in it:
            raw, scores, found = as_bytes(s), [], []
            for a, e in slices(raw):
                b = bags(raw[a:e], bits)
                z = model.sentences(b)
                scores.append(noisy_or(z, b.doc, e - a))
                rows: list[list] = [[] for _ in range(e - a)]
                hot = np.flatnonzero(z >= np.log(threshold / (1 - threshold)))
                if len(hot):
                    points = np.concatenate([[0], np.cumsum((b.buf & 0xC0) != 0x80)])
                    begin = np.cumsum([0] + [len(t) + 1 for t in raw[a:e]])
                    for i in hot.tolist():
                        base = points[begin[b.doc[i]]]
                        rows[b.doc[i]].append({"lo": int(points[b.lo[i]] - base), "hi": int(points[b.hi[i]] - base),
                                               "p": float(1 / (1 + np.exp(-z[i])))})
                found += rows
            yield pd.DataFrame({"score": np.concatenate(scores) if scores else np.zeros(0), "sentences": found})
    return docs.withColumn(out, scored(F.col(text)))
