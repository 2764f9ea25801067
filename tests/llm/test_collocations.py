"""Phrase collocations: automata against counters, and the whole operator against brute force."""

import re
from collections import Counter

import numpy as np

from collide.llm import collocations as C


def _dict(tree):
    out = {}
    for path, (_, _, w) in list(zip(tree.paths(), tree.levels))[1:]:
        for p, n in zip(path.tolist(), w.tolist()):
            if n:
                lang, *words = [tree.symbols[i].as_py().decode() for i in p]
                out[lang, " ".join(words)] = n
    return out


def _random(rng, size):
    words = ["a", "b", "c", "é", "dd"]
    rows = [(str(rng.choice(["x", "y"])), " ".join(rng.choice(words, rng.integers(1, 5)))) for _ in range(size)]
    return rows, C.of_paths([r[0] for r in rows], [r[1] for r in rows])


def test_automata_keep_counts():
    rng = np.random.default_rng(3)
    parts, total = [], Counter()
    for size in (300, 40, 1, 500):
        rows, tree = _random(rng, size)
        assert _dict(tree) == Counter(rows)
        small = C.minimal(tree)
        again = C.Transducer.from_bytes(small.to_bytes())
        assert _dict(again.expanded()) == Counter(rows)
        assert sum(len(x[1]) for x in small.layers) <= sum(len(x[1]) for x in tree.levels)
        parts.append(again.expanded())
        total += Counter(rows)
    whole = C.union(parts)
    assert _dict(whole) == total
    assert _dict(whole.pruned(9)) == {k: v for k, v in total.items() if v >= 9}
    pieces = Counter()
    for _, piece in C.cut(whole, 7):
        assert not pieces.keys() & _dict(piece).keys()
        pieces.update(_dict(piece))
    assert pieces == total


def test_shards_of_a_task_are_united_before_they_are_cut(spark):
    """Not one piece for every shard and range; what a task holds stays bounded by arcs."""
    rows = [("en", f"a{i % 7} b{i % 5} c{i % 3} d{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    want = None
    for arcs, most in ((1 << 20, 4), (300, 60)):
        got = C.pieces(docs, range(1, 3), 4, shard_bytes=100, cut_arcs=arcs).collect()
        assert (4 if most == 4 else 5) <= len(got) <= most
        total = Counter()
        for r in got:
            total.update(_dict(C.Transducer.from_bytes(r["automaton"]).expanded()))
        assert want is None or total == want
        want = total
    assert sum(n for (_, p), n in want.items() if " " not in p) == 800


def test_parts_of_one_length_are_looked_up(spark):
    docs = spark.createDataFrame([("en", "a b c"), ("en", "a b")], "lang string, text string")
    automata = C.transducers(docs, range(1, 3), 2, least=1)
    parts = spark.createDataFrame([("en", "a b"), ("en", "b c")], "lang string, part string").coalesce(1)
    assert sorted(map(tuple, C.lookups(parts, automata, 2).collect())) == [("en", "a b", 2, 2), ("en", "b c", 2, 1)]


def test_states_with_one_right_side_are_one():
    rows = [(w, f"{v} end") for w in "abc" for v in ("p", "q")]
    small = C.minimal(C.of_paths([r[0] for r in rows], [r[1] for r in rows]))
    assert [len(x[1]) for x in small.layers] == [3, 2, 1]


def test_composition_finds_the_parts():
    rng = np.random.default_rng(4)
    rows, tree = _random(rng, 400)
    asked, acceptor = _random(rng, 60)
    sym, layers = C.minimal(tree).compose(C.minimal(acceptor))
    got = {(sym[p[0]].as_py().decode(), " ".join(sym[i].as_py().decode() for i in p[1:])): n
           for path, w in layers[1:] for p, n in zip(path.tolist(), w.tolist())}
    count = Counter(rows)
    for a in asked:
        assert got.get(a, 0) == count[a]


def _brute(rows, least, top, covered):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    out = {}
    for (lang, w), a in cand.items():
        cuts = []
        for k in range(1, len(w)):
            x, y = f[lang, w[:k]], f[lang, w[k:]]
            cuts.append((2000000 * a // (x + y), k, x, y))
        score, _, x, y = min(cuts)
        if any(g[0] == lang and len(g[1]) > len(w) and 100 * b >= covered * a
               and any(g[1][i:i + len(w)] == w for i in range(len(g[1]) - len(w) + 1)) for g, b in cand.items()):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), x, y))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                  for lang, got in out.items() for i, (s, a, p, x, y) in enumerate(sorted(got)[:top]))


def test_operator_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    words = ["the", "New", "york", "City", "of", "é", "zz", "in", "a\x85b", "x y"]
    marks = [" ", "  ", "\t", ", ", ".", "\n", "; ", "\x0b", " - "]
    rows = []
    for i in range(400):
        text = "".join(str(rng.choice(words)) + str(rng.choice(marks, p=[.6, .06, .04, .06, .06, .06, .04, .02, .06])) for _ in range(rng.integers(0, 60)))
        rows.append((["en", "fr", None, "und"][i % 4], text))
    rows += [("en", None), (None, None), ("de", ""), ("de", " .\n"), ("en", "new york city of the " * 3000), ("en", "the")]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "lang string, text string, n long, range string, phrase string")
    for least, top, covered, extra in ((30, 40, 80, {}), (4, 25, 60, {"bloom_bits": 1 << 9, "shard_bytes": 5000, "ranges": 3})):
        got = C.collocations(df.repartition(5), least=least, top=top, covered=covered, **extra).collect()
        assert sorted(map(tuple, got)) == _brute(rows, least, top, covered)
    assert C.collocations(df.limit(0)).collect() == []
