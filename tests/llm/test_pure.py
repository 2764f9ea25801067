"""Brute-force tests of the array kernels, without Spark."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from collide.llm import byte_bpe, histogram_shards, html_text, huffman_ids, jaccard_join, pretok, quality, token_counts, toxicity
from collide.llm.common import shingle_hashes, slices, word_hashes

SIGNS = ["'", "s", "t", "re", "ll", "d", " ", "  ", "\n", "\t", "a", "B", "é", "1", "23", ".", "!", "''", "\xa0", "ß",
         "中", "🙂", "Σ", "<|endoftext|>", "x"]


def texts(n=3000, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_boundaries_equal_the_pattern():
    import public_tokenizers as P
    import regex
    pattern = regex.compile(P.PATTERN)
    for t in texts():
        cps, offs = pretok.code_points([t])
        if t and pretok.known(cps).all():
            assert pretok.boundaries(cps, offs).tolist() == [m.start() for m in pattern.finditer(t)], t


def test_ids_equal_the_library():
    enc, words = byte_bpe._encoder(byte_bpe.RANKS)
    ts = texts()
    for i in range(0, len(ts), 700):
        got = pretok.encode_all(ts[i:i + 700], words, enc.encode_ordinary)
        assert [x.tolist() for x in got] == [enc.encode_ordinary(t) for t in ts[i:i + 700]]


def test_counts_equal_the_library():
    c, ts = token_counts.Counter(), texts()
    assert c.count(ts).tolist() == [c.whole(t) for t in ts]
    assert c.count([]).tolist() == []


def test_transducer_lanes_agree_with_one_lane():
    step, mark, signs = token_counts.compile_transducer()
    seq = np.random.default_rng(1).integers(0, step.shape[1], 5000).astype(np.uint8)
    assert (token_counts.run_transducer(seq, step, mark, 7) == token_counts.run_transducer(seq, step, mark, 5000)).all()


@pytest.mark.parametrize("n,symbols", [(0, 5), (1, 5), (1000, 1), (5000, 7), (60000, 50257)])
def test_huffman_round_trip(n, symbols):
    ids = (np.random.default_rng(0).zipf(1.2, n) % symbols).astype(np.uint32)
    counts = np.bincount(ids, minlength=symbols)
    lengths = huffman_ids.code_lengths(counts)
    assert lengths.max(initial=0) <= huffman_ids.LIMIT
    assert (0.5 ** lengths[lengths > 0].astype(float)).sum() <= 1
    payload, bits, marks = huffman_ids.pack(ids, huffman_ids.canonical(lengths), lengths)
    assert bits == int(lengths[ids].astype(int).sum()) and len(payload) == -(-bits // 8)
    sym, size = huffman_ids.decode_table(lengths)
    assert (huffman_ids.unpack(payload, n, marks, sym, size) == ids).all()


def test_huffman_limit_is_optimal_where_it_does_not_bind():
    lengths = huffman_ids.code_lengths(np.array([5, 9, 12, 13, 16, 45]))
    assert lengths.tolist() == [4, 4, 3, 3, 3, 1]
    with pytest.raises(ValueError):
        huffman_ids.code_lengths(np.ones(9, int), 3)


def test_below_counts_probes():
    probes = sorted({(random.Random(i).randint(-3, 3), random.Random(-i).randint(-3, 3)) for i in range(30)})
    ph, pi = np.array([p[0] for p in probes]), np.array([p[1] for p in probes])
    keys = [(h, i) for h in range(-4, 5) for i in range(-4, 5)]
    got = histogram_shards.below(ph, pi, np.array([k[0] for k in keys]), np.array([k[1] for k in keys]))
    assert got.tolist() == [sum(p <= k for p in probes) for k in keys]


def test_word_and_shingle_hashes():
    raw = [b"", b"  ", b"A b\x0bc", b"a B C", b"a b c d e", b"x" * 5000]
    h, doc, n = word_hashes(raw)
    assert n.tolist() == [0, 0, 3, 3, 5, 1]
    assert (h[doc == 2] == h[doc == 3]).all()
    s, d = shingle_hashes(h, doc, n, 4)
    assert np.bincount(d, minlength=6).tolist() == [0, 0, 1, 1, 2, 1]
    assert s[d == 2] == s[d == 3]
    assert list(slices([b"aaaa"] * 5, 8)) == [(0, 2), (2, 4), (4, 5)]
    assert list(slices([], 8)) == []


def test_quality_base_columns():
    ts = ["", "la la la la x", "a b\na b\n\n \nc#|", "é à b c d e f g"]
    f = quality.features(ts, [t.encode() for t in ts])
    assert f.base.tolist() == [[0, 5, 5, 8], [0, 9, 7, 8], [0, 0, 2, 0], [0, 0, 1, 0], [0, 4, 0, 0]]


def test_noisy_or_learns_the_offending_sentence():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    docs, y = [], []
    for i in range(400):
        sents = [" ".join(rnd.choice(words) for _ in range(6)) for _ in range(rnd.randint(1, 12))]
        if i % 5 == 0:
            sents[rnd.randrange(len(sents))] += " vile"
        docs.append((". ".join(sents)).encode())
        y.append(float(i % 5 == 0))
    b = toxicity.bags(docs)
    m = toxicity.train(b.gram, b.sentence, b.doc, np.array(y), 1 << toxicity.DIM_BITS, share=0.2)
    z = m.sentences(b)
    p = toxicity.noisy_or(z, b.doc, len(docs))
    assert ((p >= 0.5) == np.array(y)).mean() > 0.97
    hot = [b.buf[lo:hi].tobytes() for lo, hi, s in zip(b.lo, b.hi, z) if s > 0]
    assert hot and sum(b"vile" in t for t in hot) / len(hot) > 0.95


def test_quality_reads_a_batch_by_slices():
    """Whatever an Arrow batch holds, only a slice of its texts is Python strings and work arrays at a time."""
    texts = [f"document {i} has many words of its own " * 100 for i in range(1500)] + [None, ""]
    column, weight = pa.array(texts), np.random.default_rng(1).normal(size=1 << quality.DIM_BITS)
    raw = [(t or "").encode() for t in texts]
    whole = quality.features([t or "" for t in texts], raw)
    want = np.vstack([whole.base, quality.margins(whole, len(texts), weight, 0.5)])
    got, first = [], []
    tracemalloc.start()
    for lo, part, own in quality._text_slices(column):
        f = quality.features(part, own)
        got.append(np.vstack([f.base, quality.margins(f, len(part), weight, 0.5)]))
        first.append(lo)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(first) > 10 and np.array_equal(np.hstack(got), want)
    assert peak < 60 << 20, peak


def test_html_blocks():
    page = ("<!DOCTYPE html><html><head><title>no</title><script>var t='</p>';</script></head><body><nav><a>menu</a></nav>"
            "<div class='ad'>buy <div>now</div></div><article><h1>T &amp; x</h1><p>one\n <b>two<br>three<p hidden>gone"
            "<p>four</p><div id=comments>me</div><aside>side</aside></article><footer>f</footer>")
    assert html_text.page_blocks(page) == (["T & x", "one two three", "four"], True)
    assert html_text.page_blocks("") == ([], False)
    assert html_text.page_blocks("a < b <i>c</i> <!-- open") == (["a < b c"], False)
    assert html_text.page_blocks("<p>x<p class=ad>y<p>z") == (["x", "z"], False)


def test_html_names_of_wrappers():
    """Names that say what an element has, wrappers that hold the only article, text beside teasers."""
    read = html_text.page_blocks
    for wrap in ("<div class='page no-sidebar'>%s</div>", "<section id='post-with-comments'>%s</section>",
                 "<div class='cookie-page'><p>menu</p>%s</div>", "<div class=widget><div id=popup>%s</div></div>"):
        assert read(wrap % "<article><p>one two</p></article>") == (["one two"], True), wrap
    assert read("<article class='post has-sidebar'><p>one</p></article>") == (["one"], True)
    assert read("<article class='post type-post category-search'><p>one</p></article>") == (["one"], True)
    # comments and related pieces stay out, also where they are articles
    comments = "<div class=comments><article id=c1><p>nice</p></article></div><article class='comment-body'><p>x</p></article>"
    assert read("<article><p>one two</p></article>" + comments) == (["one two"], True)
    assert read("<div class='has-ad'><p>one</p><div class='ad-slot'>buy</div></div>") == (["one"], False)
    teaser = "<article><p>teaser</p></article>"
    assert read(f"<main><p>the long text of this page</p>{teaser}<p>goes on</p></main>") == (
        ["the long text of this page", "teaser", "goes on"], True)
    assert read("<main><p>by me</p><article><p>the long text of this page</p></article></main>") == (
        ["the long text of this page"], True)
    # hidden parts and parts whose kind leaves them out are never taken back
    assert read("<div hidden><article><p>x</p></article></div><p>y</p>") == (["y"], False)
    assert read("<nav class=menu><article><p>x</p></article></nav><p>y</p>") == (["y"], False)


def test_prefixes_never_lose_a_partner():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randint(1, 120)
        a = set(rnd.sample(range(1000), n))
        b = set(a)
        for _ in range(rnd.randint(0, 6)):
            b.discard(rnd.choice(sorted(b)) if len(b) > 1 else -1)
            b.add(rnd.randrange(1000))
        if 100 * len(a & b) < 85 * len(a | b):
            continue
        for order in (lambda x: x, lambda x: (x * 7919) % 1009):
            cut = [set(sorted(s, key=order)[:len(s) - jaccard_join.needed(len(s), 85) + 1]) for s in (a, b)]
            assert cut[0] & cut[1]
