"""Registered queries and every pipeline stage against brute force over the whole smallest tables."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from collide.llm import byte_bpe, quality, sanitise
from collide.llm.queries import QUERIES

from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    out = []
    for no, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), no, kind, m.end()))
    return sorted(out)


def base_quality(text: str) -> dict:
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, c in Counter(windows).items() if c > 1}
    covered = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 50 or 100 * len(covered) > 50 * n}


def shingles(text: str, k: int) -> set:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def components(sets: dict, percent: int) -> dict:
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (i, a), (j, b) in itertools.combinations(sorted(sets.items()), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            p, q = sorted((find(i), find(j)))
            root[q] = p
    return {i: find(i) for i in sets}


def test_op1_law_and_slots(spark, texts):
    rows = QUERIES["op1_histogram_shards"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    size = Counter()
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        size[r["shard"]] += r["size"]
    for s in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    mean = sum(size.values()) / 8
    assert all(abs(size[s] - mean) <= 0.002 * mean + max(r["size"] for r in rows) for s in range(8))


def test_op3_base_columns(spark, texts):
    rows = QUERIES["op3_quality_ngrams"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        want = base_quality(texts[r["doc_id"]])
        assert {c: r[c] for c in want} == want
        assert not (r["kept"] and r["base_failed"])


def test_op5_base_spans(spark, texts):
    rows = QUERIES["op5_sanitise"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        spans = base_spans(texts[r["doc_id"]])
        told = ",".join(f"{kind}:{lo}:{hi}" for lo, _, kind, hi in spans)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert {k: r[f"n_{k}"] for k in KINDS} == {k: sum(s[2] == k for s in spans) for k in KINDS}
        assert set(told.split(",")) - {""} <= set(r["spans"].split(","))


def test_op10_components(spark, texts):
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    want = components(sets, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_jaccard_join"](spark, SF_SMALL).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_pipeline_stages(spark):
    """Every stage's whole result from its own input: which documents stay, and with which texts."""
    import corpus_pipeline
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")

    def rows(df):
        return {r["doc_id"]: r for r in df.collect()}

    def checked(name, before):
        kept = stage[name](spark, before, SF_SMALL).cache()
        assert kept.columns == before.columns or name == "byte_bpe"
        return kept, rows(before), rows(kept)

    # quality: the base rules by brute force, the trained verdict from the probabilities
    kept, was, now = checked("quality", docs)
    scored = rows(quality.score(docs, quality.fit(docs, labels)))
    good = {i for i, r in was.items() if not base_quality(r["text"] or "")["base_failed"]
            and scored[i]["quality"]["p_good"] >= quality.THRESHOLD}
    assert good and now == {i: was[i] for i in good}
    # near duplicates: the smallest id of every component
    kept, was, now = checked("near_duplicates", kept)
    lowest = components({i: shingles(r["text"] or "", 5) for i, r in was.items()}, 80)
    assert now == {i: was[i] for i in was if lowest[i] == i}
    # decontamination: everything that holds no benchmark item, whole
    kept, was, now = checked("decontaminate", kept)

    def plain(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {i for i, r in was.items() if any(s and 100 * len(s & plain(r["text"])) >= 80 * len(s) for s in items)}
    assert now == {i: was[i] for i in was if i not in leaks}
    # personal data: base spans by brute force, terms as the method names them
    before = kept
    kept, was, now = checked("personal_data", before)
    terms = {i: [(s["lo"], s["kind_no"], s["kind"], s["hi"], s["value"]) for s in r["spans"] if s["kind"] == "term"]
             for i, r in rows(sanitise.spans(before)).items()}
    assert set(now) == set(was)
    for i, r in was.items():
        merged = []
        for lo, _, kind, hi, value in sorted([(*s, None) for s in base_spans(r["text"] or "")] + terms[i]):
            if merged and lo < merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi, "" if value == "remove" else f"[{kind.upper()}]"])
        text = r["text"] or ""
        for lo, hi, label in reversed(merged):
            text = text[:lo] + label + text[hi:]
        assert (now[i]["text"] or "") == text and now[i]["n_chars"] == len(text)
        assert (now[i]["lang"], now[i]["source"]) == (r["lang"], r["source"])
    # byte-level BPE: the ids of every text
    kept, was, now = checked("byte_bpe", kept)
    enc, _ = byte_bpe._encoder(byte_bpe.RANKS)
    assert set(now) == set(was)
    for i, r in was.items():
        ids = enc.encode_ordinary(r["text"] or "")
        assert bytes(now[i]["ids"]) == b"".join(t.to_bytes(4, "little") for t in ids) and now[i]["n_tokens"] == len(ids)


def test_pipeline_of_nulls_and_repeated_rows(spark, tmp_path):
    """Null and empty texts, null ids, repeated rows, and an empty table through every stage."""
    import corpus_pipeline
    base = " ".join(f"word{i}" for i in range(80))
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    every = [(1, base, "en", "s", len(base)), (1, base, "en", "s", len(base)), (2, base, None, None, None),
             (None, base + " more", "en", "s", 0), (3, None, "en", "s", None), (4, "", "en", "s", 0)]
    for rows in (every, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF_SMALL)
            got = [tuple(r) for r in found.collect()]
            if name == "near_duplicates":  # the smallest id stays with its copies, rows without an id stay
                assert sorted(r[0] for r in got if r[0] is not None) == ([1, 1, 3, 4] if rows else [])
                assert sum(r[0] is None for r in got) == (1 if rows else 0)
            elif name == "quality":
                assert all(len((r[1] or "").split()) >= 50 for r in got)
                continue  # the later stages see nulls and empty texts too
            else:
                assert len(got) == docs.count()
            docs = found if name != "byte_bpe" else docs
