"""Cross-tokenizer alignment against the libraries and plain counting."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from collide.llm import token_alignment as T
from collide.llm.queries import QUERIES

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def brute():
    tok = Tokenizer.from_file(P.path(T.VOCAB_A))
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=P.path(T.VOCAB_B))
    size_a = T.ByteSide(T.VOCAB_A).bytes.to_pylist()

    def spelled(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    def one(text):
        if not text:
            return [], [], []
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        sa, sb = [size_a[i] for i in a], [spelled(i) for i in b]
        if not b"".join(sa) == b"".join(sb) == (" " + text).encode():
            return [], [], []
        ends = [0, 0]
        at = [{}, {}]
        for side, parts in enumerate((sa, sb)):
            for k, p in enumerate(parts):
                ends[side] += len(p)
                at[side][ends[side]] = k
        return a, b, [(at[0][e], at[1][e]) for e in sorted(at[0].keys() & at[1].keys())]

    def report(rows):
        found = [(key, *one(text)) for key, text in rows]
        count = Counter((a[i], b[j]) for _, a, b, links in found for i, j in links)
        most = Counter()
        for (_, y), n in count.items():
            most[y] = max(most[y], n)
        out = []
        for key, a, b, links in found:
            groups, x, y = [], 0, 0
            for i, j in links:
                groups.append(",".join(map(str, a[x:i + 1])) + "|" + ",".join(map(str, b[y:j + 1])))
                x, y = i + 1, j + 1
            n = [count[a[i], b[j]] for i, j in links]
            out.append((key, len(a), len(b), len(links), len(links), sum(c == most[b[j]] for c, (_, j) in zip(n, links)), sum(n),
                        hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        return sorted(out, key=repr)
    return report


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                       "groups_sha256").collect()), key=repr)


def test_query_equals_plain_counting(spark, brute):
    d = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    assert _got(QUERIES["op13_token_alignment"](spark, SF_SMALL)) == brute(list(zip(d["doc_id"], d["text"])))


def test_odd_rows_and_rare_pairs(spark, brute):
    """Nulls, empty, long and unspellable texts, repeats, clashing columns; few pairs known, the rest joined."""
    long = "lorem  ipsum, dolor's 12 sit\n" * 5000 + "  "
    rows = [(1, None), (2, ""), (3, " "), (4, "  two  spaces  "), (5, "a▁b"), (6, "x<|endoftext|>y <s>z</s> <0x41>"),
            (7, "é🙂 ß 中文 　wide\tTab"), (7, "é🙂 ß 中文 　wide\tTab"), (None, "no key"), (8, long), (9, "nul\x00 x\r\n"),
            (10, "a b​ ﻿c \u0085d"), (11, "'s 'S can't  won't 2024 3.14")]
    df = spark.createDataFrame([(k, t, 5, "p", 1) for k, t in rows], "doc_id long, text string, row int, pairs string, n long")
    want = brute(rows)
    for known in (T.KNOWN, 3, 0):
        assert _got(T.alignment_report(df.repartition(3), known=known)) == want
    assert T.alignment_report(df.limit(0)).collect() == []
