"""Exact token counts by a compiled finite-state tokenizer (lower-casing word BPE).

The split pattern is compiled to a deterministic transducer over character
classes: a transition says whether a pre-token starts at this sign or at the one
before (a contraction that did not come about).  The text of a batch is cut into
equal lanes; for every lane the map entry state -> exit state is computed for all
entry states at once, the maps are composed by a parallel prefix scan, and a
second run with the now known entry states gives the marks.  Closing a pre-token
emits as many tokens as the library gives that pre-token; these weights are
compiled once per distinct pre-token.

Defined results: null and empty texts count 0; special strings inside a text count
as the library counts them; a text with code points whose class differs between
Unicode versions, or whose lower case depends on its neighbours, goes whole to the
library.  Rows and extra columns stay as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collide.llm.common import slices
from collide.llm.pretok import (CONTRACTIONS, LETTER, NUMBER, OTHER, _LIMIT, WordTable, classes, code_points, known,
                                spans_hash, word_end_encoder)

MODEL = "word_bpe_49k.json"
LANE = 512

# input signs of the transducer
_WHITE, _LET, _NUM, _OTH, _APO = range(5)


def compile_transducer(contractions=CONTRACTIONS):
    """(step, mark, signs): transition table, marks and the sign of each contraction letter.

    States: gap, in letters, after a digit, in other signs, after an opening
    apostrophe, one state per proper prefix of a longer contraction, contraction done.
    ``mark`` bit 1: a pre-token starts here; bit 2: one started at the previous sign.
    """
    letters = sorted({c for w in contractions for c in w[1:]})
    signs = {c: 5 + i for i, c in enumerate(letters)}
    width = 5 + len(letters)
    gap, let, num, oth, apo, done = range(6)
    pending = {w[1]: 6 + i for i, w in enumerate(w for w in contractions if len(w) == 3)}
    final = {w[1:]: w for w in contractions}
    step = np.zeros((6 + len(pending), width), np.uint8)
    mark = np.zeros_like(step)

    def arc(state, sign, to, m=0):
        step[state, sign], mark[state, sign] = to, m

    letter_signs = [_LET, *signs.values()]
    for st in (gap, let, num, oth, done):
        arc(st, _WHITE, gap)
        arc(st, _NUM, num, 1)
        for s in letter_signs:
            arc(st, s, let, 0 if st == let else 1)
        arc(st, _OTH, oth, 0 if st == oth else 1)
        arc(st, _APO, oth if st == oth else apo, 0 if st == oth else 1)
    arc(apo, _WHITE, gap)
    arc(apo, _NUM, num, 1)
    arc(apo, _OTH, oth)
    arc(apo, _APO, oth)
    for s in letter_signs:
        arc(apo, s, let, 1)
    for c, s in signs.items():
        if c in final:
            arc(apo, s, done)
        elif c in pending:
            arc(apo, s, pending[c])
    for c, st in pending.items():  # not completed: the letter before opened a word
        for s in range(width):
            step[st, s], mark[st, s] = step[let, s], mark[let, s] | 2
        for d, s in signs.items():
            if c + d in final:
                arc(st, s, done)
    return step, mark, signs


def run_transducer(signs: np.ndarray, step: np.ndarray, mark: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Marks of a sign sequence (entry state: gap), by lanes, state maps and a prefix scan."""
    n, q = len(signs), len(step)
    lanes = -(-n // lane)
    grid = np.zeros(lanes * lane, np.uint8)
    grid[:n] = signs
    grid = np.ascontiguousarray(grid.reshape(lanes, lane).T)
    width = step.shape[1]
    flat_step, flat_mark = step.ravel(), mark.ravel()
    state = np.repeat(np.arange(q, dtype=np.int64)[:, None], lanes, axis=1)
    for row in grid:  # every entry state at once; stop once all maps are constant
        state = flat_step[state * width + row].astype(np.int64)
    maps = state.T  # lanes x q
    hop = 1
    while hop < lanes:  # inclusive scan: maps[i] becomes the map of lanes 0..i
        maps = np.concatenate([maps[:hop], np.take_along_axis(maps[hop:], maps[:-hop], axis=1)])
        hop *= 2
    entry = np.concatenate([[0], maps[:-1, 0]]).astype(np.int64)
    out = np.empty_like(grid)
    for i, row in enumerate(grid):
        at = entry * width + row
        out[i] = flat_mark[at]
        entry = flat_step[at].astype(np.int64)
    return out.T.ravel()[:n]


class Counter:
    """Counts tokens of texts; one per Python worker."""

    def __init__(self, model: str = MODEL):
        import public_tokenizers as P
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(model if "/" in model else P.path(model))
        self.specials = sorted((t.content for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.step, self.mark, self.signs = compile_transducer()
        ends = np.zeros(self.tok.get_vocab_size(), bool)
        for token, i in self.tok.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.words = WordTable(word_end_encoder(
            lambda t: self.tok.encode_batch_fast([t], add_special_tokens=False)[0].ids, ends))
        base = np.full(_LIMIT, _WHITE, np.uint8)
        k = classes()
        base[k == LETTER], base[k == NUMBER], base[k == OTHER] = _LET, _NUM, _OTH
        base[ord("'")] = _APO
        for c, s in self.signs.items():
            base[ord(c)] = s
        self.sign = base

    def whole(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def normal(self, text: str) -> str:
        return (text if text.isascii() else unicodedata.normalize("NFC", text)).lower()

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        plain = [not (any(s in t for s in self.specials) or "Σ" in t) for t in texts]
        norm = [self.normal(t) if ok else "" for t, ok in zip(texts, plain)]
        joined = "\n".join(norm) + "\n"
        cps, _ = code_points([joined])
        offs = np.concatenate([[0], np.cumsum([len(t) + 1 for t in norm])])
        bad = np.unique(np.searchsorted(offs, np.flatnonzero(~known(cps)), side="right") - 1)
        for i in bad:
            plain[i] = False
        marks = run_transducer(self.sign[np.minimum(cps, _LIMIT - 1)], self.step, self.mark)
        start = (marks & 1).astype(bool)
        start[:-1] |= (marks[1:] & 2).astype(bool)
        white = self.sign[np.minimum(cps, _LIMIT - 1)] == _WHITE
        edge = start | (white & np.concatenate([[True], ~white[:-1]]))
        edge[0] = True
        at = np.flatnonzero(edge)
        ends = np.append(at[1:], len(cps))
        h = spans_hash(cps, at, ends)
        word = ~white[at]
        rows = self.words.ranks(joined, h[word], at[word], ends[word])
        doc = np.searchsorted(offs, at[word], side="right") - 1
        out += np.bincount(doc, weights=self.words.n[rows], minlength=len(texts)).astype(np.int64)[:len(texts)]
        for i, ok in enumerate(plain):
            if not ok:
                out[i] = self.whole(texts[i])
        return out


@cache
def _counter(model: str) -> Counter:
    """The counter of this worker, kept from task to task."""
    return Counter(model)


def count_tokens(docs: DataFrame, text: str = "text", n_tokens: str = "n_tokens", model: str = MODEL) -> DataFrame:
    """``docs`` plus the token count of each whole text (long)."""
    @F.pandas_udf("long")
    def counted(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = _counter(model)
        for s in it:
            texts = [t or "" for t in s]
            parts = [c.count(texts[lo:hi]) for lo, hi in slices(texts, 1 << 20)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0, np.int64), index=s.index)
    return docs.withColumn(n_tokens, counted(F.col(text)))
