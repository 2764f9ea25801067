"""SimHash components against brute force over all pairs."""

import numpy as np
import xxhash

from collide.llm import simhash as S


def _signed(x):
    return int(np.uint64(x).astype(np.int64))


def _brute(fps):
    """Smallest member of the component of every distinct fingerprint."""
    u = np.unique(np.asarray(fps, np.uint64))
    lab = np.arange(len(u))

    def find(x):
        while lab[x] != x:
            x = lab[x]
        return x
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= S.DISTANCE):
            lab[find(i + 1 + j)] = find(i)
    return {int(x): find(i) for i, x in enumerate(u)}


def _components(links):
    lab = {}

    def find(x):
        while lab.setdefault(x, x) != x:
            x = lab[x]
        return x
    for a, b in links:
        lab[find(a)] = find(b)
    return find


def test_fingerprint_follows_its_definition(monkeypatch):
    monkeypatch.setattr(S, "_RUN", 7)
    text = "The  quick\tbrown fox\njumps over THE quick brown fox again É"
    words = text.replace("T", "t").replace("H", "h").replace("E", "e").split()
    words = [w.replace("É", "É") for w in words]
    shingles = [" ".join(words[i:i + 3]).encode() for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert S.fingerprint(text.encode()) == want
    assert S.fingerprint(b"two Words") == xxhash.xxh64_intdigest(b"two words", 42)
    assert S.fingerprint(b"") == S.fingerprint(b" \n\t") == 0


def test_links_of_dense_and_sparse_fingerprints(spark):
    """Crowded keys take the points' way; every connection of all pairs must come out, none else."""
    rng = np.random.default_rng(5)
    out = [rng.integers(0, 1 << 64, 300, dtype=np.uint64)]
    for size, reach in ((400, 5), (150, 12), (60, 3)):  # crowds around a centre, from tight to loose
        centre, bits = rng.integers(0, 1 << 64, dtype=np.uint64), rng.choice(64, 14, replace=False)
        flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.choice(bits, rng.integers(0, reach)).astype(np.uint64),
                                       initial=np.uint64(0)) for _ in range(size)]
        out.append(np.array(flips, np.uint64) ^ centre)
    chain = [rng.integers(0, 1 << 64, dtype=np.uint64)]
    for i in range(18):  # steps of exactly three bits
        step = sum(1 << int(b) for b in ((3 * i) % 64, (3 * i + 1) % 64, (3 * i + 2) % 64))
        chain.append(chain[-1] ^ np.uint64(step))
    fps = np.unique(np.concatenate([*out, np.array(chain, np.uint64), np.array([0], np.uint64)]))
    df = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    found = [(r.a, r.b) for r in S.links(df).collect()]
    find, want = _components(found), _brute(fps)
    label = {}
    for x, g in want.items():
        assert label.setdefault(g, find(_signed(x))) == find(_signed(x))
    assert len(set(label.values())) == len(label)
    assert len(label) < len(fps) - 300


def test_three_bit_links_between_groups_of_one_crowd(spark):
    """Two tight groups in one crowded key whose only link has exactly three bits."""
    base = np.uint64(0xF0F0_1234_5678_9ABC)
    near = [base ^ np.uint64(1 << i) for i in range(0, 20)]
    other = base ^ np.uint64(0b111 << 40) ^ np.uint64(1 << 3)
    far = [other ^ np.uint64(1 << i) for i in range(50, 60)]
    fps = np.unique(np.array([*near, *far], np.uint64))
    df = spark.createDataFrame([(_signed(x),) for x in fps], "fp long")
    find, want = _components([(r.a, r.b) for r in S.links(df).collect()]), _brute(fps)
    same = {(a, b): want[a] == want[b] for a in want for b in want}
    assert all((find(_signed(a)) == find(_signed(b))) == v for (a, b), v in same.items())


def test_odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    long = " ".join(f"w{i % 977}" for i in range(40000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "same text here"), (5, "SAME  text here"), (5, "SAME  text here"),
            (None, "same text here"), (6, long), (7, long + " more"), (None, "alone stands this one")]
    df = spark.createDataFrame([(k, t, 9, "x", 1) for k, t in rows], "doc_id long, text string, fp int, a string, weight int")
    got = sorted(S.components(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.fp))
    assert [(r.doc_id, r.component_id) for r in got if r.doc_id is not None] == [
        (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6), (7, 6)]
    assert sorted(r.component_id or -1 for r in got if r.doc_id is None) == [-1, 4]
    assert S.components(df.limit(0)).collect() == []
