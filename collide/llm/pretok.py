"""Pre-tokenisation of whole Arrow batches, and word tables over a tokenizer library.

Two split patterns are compiled to array code over code-point classes:

* ``gpt``: the pattern of byte-level vocabularies (``public_tokenizers.PATTERN``);
* ``clip``: contractions | letters | one digit | other signs, white space dropped.

The result is the set of pre-token boundaries of every text.  A ``WordTable``
then maps each distinct pre-token (by a 64-bit hash of its code points) to the
ids that the tokenizer library gives it, so the library runs once per distinct
pre-token and worker, and every text is assembled by array gathers.

Only code points whose class is the same in every Unicode version since 3.2 are
handled here; a text with any other code point goes whole to the library.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from collide.llm.common import _powers, mix

_U = np.uint64
UNKNOWN, LETTER, NUMBER, OTHER, BLANK, SPACE = range(6)
#: The contractions of both patterns, in the order in which they are tried.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: White space on which regex engines disagree, or that older ones miss.
_DOUBTFUL = {0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x180E, 0x200B, 0xFEFF}
_LIMIT = 0x30000
_TABLE: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of each code point below 0x30000 (built once per worker from Unicode 3.2 and the current one)."""
    global _TABLE
    if _TABLE is None:
        old, t = unicodedata.ucd_3_2_0, np.zeros(_LIMIT, np.uint8)
        for cp in range(_LIMIT):
            c = chr(cp)
            k = old.category(c)
            if k in ("Cn", "Cs", "Co") or cp in _DOUBTFUL or unicodedata.category(c)[0] != k[0]:
                continue
            if cp == 0x20:
                t[cp] = SPACE
            elif k[0] == "Z" or 0x09 <= cp <= 0x0D:
                t[cp] = BLANK
            else:
                t[cp] = LETTER if k[0] == "L" else NUMBER if k[0] == "N" else OTHER
        _TABLE = t
    return _TABLE


def known(cps: np.ndarray) -> np.ndarray:
    t = classes()
    return (cps < _LIMIT) & (t[np.minimum(cps, _LIMIT - 1)] != UNKNOWN)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of the joined texts, start offset of each text plus the end)."""
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return cps, np.concatenate([[0], np.cumsum(lens)])


def _contractions(cps: np.ndarray, at: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of apostrophes at positions ``at`` (text ends at ``last``): those that open a contraction, and its length."""
    n = len(cps)
    c1 = np.where(at + 1 < last, cps[np.minimum(at + 1, n - 1)], 0)
    c2 = np.where(at + 2 < last, cps[np.minimum(at + 2, n - 1)], 0)
    size = np.zeros(len(at), np.int64)
    for word in CONTRACTIONS:
        hit = (c1 == ord(word[1])) & (size == 0)
        if len(word) == 3:
            hit &= c2 == ord(word[2])
        size[hit] = len(word)
    return at[size > 0], size[size > 0]


def boundaries(cps: np.ndarray, offs: np.ndarray, pattern: str = "gpt") -> np.ndarray:
    """Sorted start positions of all pre-tokens (white-space tokens included for ``gpt``;
    for ``clip`` white-space runs also appear and are told apart by their class)."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    k = classes()[np.minimum(cps, _LIMIT - 1)]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    white = k >= BLANK
    kind = np.where(white, np.uint8(BLANK), k)
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start |= first
    if pattern == "clip":
        start[:n] |= k == NUMBER
    else:
        # the last white-space sign of a run before a word stands alone, or joins the word if it is a blank
        lead = np.flatnonzero(start[1:n] & ~first[1:n] & ~white[1:] & white[:-1]) + 1
        start[lead - 1] = True
        joined = lead[cps[lead - 1] == 0x20]
        start[joined] = False
    mark = np.flatnonzero((cps == 0x27) & start[:n])
    if len(mark):
        last = offs[np.searchsorted(offs, mark, side="right")]
        at, size = _contractions(cps, mark, last)
        start[at + 1] = first[at + 1]
        end = at + size
        start[end] = True
    return np.flatnonzero(start[:n])


def spans_hash(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the code points of each span; spans must tile [starts[0], ends[-1])."""
    size = ends - starts
    place = np.arange(starts[0], ends[-1]) - np.repeat(starts, size)
    val = (cps[starts[0]:ends[-1]].astype(_U) + _U(1)) * _powers(int(size.max()) + 1)[place]
    return mix(np.add.reduceat(val, starts - starts[0]) + size.astype(_U))


def newline_encoder(encode, run: int = 2000):
    """Encoder of pre-token lists over a byte-level library call ``encode(text) -> ids``.

    Pre-tokens of one call are joined by newlines (a newline before a word is a pre-token of its
    own under the ``gpt`` pattern) and their ids cut apart at its id; white-space pre-tokens, and
    runs that do not come apart as they went in, are encoded one by one.
    """
    mark = list(encode("\n"))

    def ids(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32)
        flat, held = [], 0
        plain = [i for i, w in enumerate(words) if len(mark) == 1 and not w.isspace()]
        alone = [i for i, w in enumerate(words) if len(mark) != 1 or w.isspace()]
        for lo in range(0, len(plain), run):
            part = plain[lo:lo + run]
            got = np.asarray(encode("\n".join([words[i] for i in part])), np.uint32)
            edge = np.flatnonzero(got == mark[0])
            if len(edge) != len(part) - 1:
                alone += part
                continue
            n[part] = np.diff(edge, prepend=-1, append=len(got)) - 1
            at[part] = held + np.cumsum(n[part]) - n[part]
            flat.append(got[got != mark[0]])
            held += len(flat[-1])
        for i in alone:
            flat.append(np.asarray(encode(words[i]), np.uint32))
            at[i], n[i] = held, len(flat[-1])
            held += len(flat[-1])
        return np.concatenate([*flat, np.zeros(0, np.uint32)]), at, n
    return ids


def list_encoder(encode_lists):
    """Encoder of pre-token lists over a library call that gives one id list per pre-token."""
    def ids(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = encode_lists(words)
        n = np.fromiter(map(len, got), np.int32, len(got))
        flat = np.fromiter((i for x in got for i in x), np.uint32, int(n.sum()))
        return flat, np.cumsum(n, dtype=np.int64) - n, n
    return ids


def word_end_encoder(encode, ends_word: np.ndarray, run: int = 2000):
    """Token counts (no ids) of pre-token lists under the ``clip`` pattern: pre-tokens are joined
    by blanks (which give no token) and counted up to each id that ends a word."""
    def ids(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.zeros(len(words), np.int32)
        for lo in range(0, len(words), run):
            part = words[lo:lo + run]
            stop = np.flatnonzero(ends_word[np.asarray(encode(" ".join(part)), np.int64)])
            n[lo:lo + len(part)] = np.diff(stop, prepend=-1) if len(stop) == len(part) else [len(encode(w)) for w in part]
        return np.zeros(0, np.uint32), np.zeros(len(words), np.int64), n
    return ids


class WordTable:
    """Distinct pre-tokens seen by this worker -> their ids, as flat arrays.

    ``encode`` gets a list of pre-token strings and returns (flat ids, first id and number of ids
    of each).  Pre-tokens are told apart by 64-bit hashes of their code points alone: among n
    distinct ones the chance of one wrong match is n * n / 2**65.  The table holds at most ``most`` words and starts anew beyond that (a cache:
    dropping it costs time, never results).
    """

    def __init__(self, encode, most: int = 1_000_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self):
        self.key = np.zeros(0, _U)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def ranks(self, joined: str, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row in the table of each span, adding the new ones."""
        uniq, where, back = np.unique(h, return_index=True, return_inverse=True)
        pos = np.searchsorted(self.key, uniq)
        have = pos < len(self.key)
        have[have] = self.key[pos[have]] == uniq[have]
        if not have.all():
            if len(self.key) + len(uniq) > self.most:
                self._clear()
                have = np.zeros(len(uniq), bool)
            fresh = where[~have]
            flat, at, n = self.encode([joined[s:e] for s, e in zip(starts[fresh].tolist(), ends[fresh].tolist())])
            at = at + len(self.flat)
            key = np.concatenate([self.key, uniq[~have]])
            order = np.argsort(key, kind="stable")
            self.key = key[order]
            self.at = np.concatenate([self.at, at])[order]
            self.n = np.concatenate([self.n, n])[order]
            self.flat = np.concatenate([self.flat, flat])
            pos = np.searchsorted(self.key, uniq)
        return pos[back]

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids of these table rows in order, ids per row)."""
        n = self.n[rows].astype(np.int64)
        total = int(n.sum())
        if not total:
            return np.zeros(0, np.uint32), n
        first = np.cumsum(n) - n
        return self.flat[np.arange(total) - np.repeat(first - self.at[rows], n)], n


def encode_all(texts: list[str], words: WordTable, whole, pattern: str = "gpt") -> list[np.ndarray]:
    """Ids of every text: by pre-token through ``words``, or by ``whole(text)`` for texts with
    code points of doubtful class."""
    out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
    cps, offs = code_points(texts)
    bad = np.zeros(len(texts), bool)
    doubt = np.flatnonzero(~known(cps))
    bad[np.searchsorted(offs, doubt, side="right") - 1] = True
    for i in np.flatnonzero(bad):
        out[i] = np.asarray(whole(texts[i]), np.uint32)
    good = [i for i in range(len(texts)) if not bad[i]]
    if bad.any():
        cps, offs = code_points([texts[i] for i in good])
    if len(cps):
        joined = "".join(texts[i] for i in good)
        starts = boundaries(cps, offs, pattern)
        ends = np.append(starts[1:], len(cps))
        rows = words.ranks(joined, spans_hash(cps, starts, ends), starts, ends)
        flat, n = words.ids(rows)
        cut = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, offs)]
        for j, i in enumerate(good):
            out[i] = flat[cut[j]:cut[j + 1]]
    else:
        for i in good:
            out[i] = np.zeros(0, np.uint32)
    return out
