"""The operators on Spark: brute force on a small fixture with nulls, empty and long texts, ties,
repeated rows, clashing column names, and on empty tables."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from collide.llm import (byte_bpe, decontaminate, histogram_shards, html_text, huffman_ids, jaccard_join, quality,
                         sanitise, token_counts, toxicity)
from collide.llm.queries import ORACLES, QUERIES

from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i}" for i in range(120))
NEAR = BASE.replace("word60 ", "")
ITEM = " ".join(f"item{i}" for i in range(30))
LONG = "lorem ipsum, dolor's 12 sit\n" * 6000

ROWS = [
    (1, BASE, "src", 3), (2, NEAR, "src", 3), (3, BASE, None, 3), (3, BASE, None, 3), (4, None, "src", None),
    (5, "", "src", 0), (None, "no id here", "src", 1), (6, " \n\t ", "src", 0), (7, "two words", "src", 1),
    (8, "TWO WORDS", "src", 1), (9, LONG, "src", 9), (10, f"before {ITEM} after it all", "src", 2),
    (11, "mail me a.b_c@x-y.org or a@b@c.d, 10.0.0.255 or 1.2.3.256; +1 (555) 010-9999, 4111 1111 1111 1111", "src", 4),
    (12, "é🙂 ß 中文 <|endoftext|> 'S It's", "src", 5),
]
COLUMNS = "doc_id long, text string, shard string, n long"  # two names that operators use themselves


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def keyed(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_shards(docs, none):
    got = histogram_shards.assign(docs, shards=3).collect()
    assert len(got) == len(ROWS)
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 for r in got)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert histogram_shards.assign(none).count() == 0


def test_shards_cut_a_hot_group(spark):
    hot = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string"))
                                   .otherwise(F.lit("same text")).alias("text"))
    sizes = [r["s"] for r in histogram_shards.assign(hot).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.004 * sum(sizes) / 8 + 20


def test_byte_bpe(docs, none):
    enc, _ = byte_bpe._encoder(byte_bpe.RANKS)
    for chunk, overlap in ((byte_bpe.CHUNK, byte_bpe.OVERLAP), (50, 20)):
        ids = byte_bpe.encode(docs, chunk=chunk, overlap=overlap)
        got = ids.select("text", byte_bpe.ids_digest_udf()("ids").alias("a"), byte_bpe.decode_udf()("ids").alias("b")).collect()
        assert len(got) == len(ROWS)
        for r in got:
            t = r["text"] or ""
            assert bytes(r["b"]) == t.encode()
            assert r["a"] == hashlib.sha256(" ".join(map(str, enc.encode_ordinary(t))).encode()).hexdigest()
    assert byte_bpe.encode(none).count() == 0


def test_token_counts(docs, none):
    c = token_counts.Counter()
    assert all(r["n_tokens"] == c.whole(r["text"] or "") for r in token_counts.count_tokens(docs).collect())
    assert token_counts.count_tokens(none).count() == 0


def test_token_files(spark, docs, none):
    _, whole, _ = huffman_ids._tokenizer(huffman_ids.VOCAB)
    path = huffman_ids.fresh_path(spark)
    huffman_ids.write_tokens(docs, path, parts=3, block_ids=50)
    got = sorted(huffman_ids.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in got]
    assert keys == sorted((r[0] for r in ROWS), key=lambda k: (k is not None, k))
    at = 0
    text = {r[0]: r[1] for r in ROWS}
    for r in got:
        want = [*whole(text[r["doc_id"]] or ""), huffman_ids.END_ID]
        assert r["start"] == at and r["n_tokens"] == len(want)
        assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in want)
        at += len(want)
    empty = huffman_ids.fresh_path(spark)
    huffman_ids.write_tokens(none, empty, parts=2)
    assert huffman_ids.read_tokens(spark, empty).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0), (7, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r["quality"] for r in quality.verdict(docs, quality.fit(docs, labels)).collect()}
    assert got[4]["n_words"] == 0 and got[4]["base_failed"] and not got[4]["kept"]
    assert got[1]["n_words"] == 120 and not got[1]["base_failed"]
    assert got[9]["base_failed"]  # one line over and over
    for y, kept in ((1, True), (0, False)):
        one = quality.fit(docs, labels.where(F.col("quality") == y))
        assert [r["quality"]["kept"] for r in quality.verdict(docs.where("doc_id = 1"), one).collect()] == [kept]
    for ids, kept in (((1, 2), True), ((7, 9), False), ((4,), True)):  # both labels, documents of one or of neither
        part = quality.fit(docs.where(F.col("doc_id").isin(*ids)), labels)
        got = quality.verdict(docs.where("doc_id = 1"), part).first()["quality"]
        assert got["kept"] is kept and 0 <= got["p_good"] <= 1
    assert quality.verdict(none, quality.fit(none, labels.limit(0))).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (2, 0), (9, 0), (7, 1), (8, 1), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == len({r[0] for r in ROWS}) and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[4]["score"] == 0 and got[5]["score"] == 0
    assert toxicity.score(none, toxicity.fit(none, labels.limit(0))).count() == 0


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(0, ITEM), (1, "word7 word8 word9 word10 word11"), (2, "too short"), (3, None)],
                                  "item_id long, text string")
    got = keyed(decontaminate.contained(docs, items), "doc_id", "item_id", "n_item", "n_shared")
    assert got == sorted([(10, 0, 26, 26), (1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 1), (3, 1, 1, 1)], key=repr)
    left = [r["doc_id"] for r in decontaminate.clean(docs, items).collect()]
    assert sorted(left, key=repr) == sorted((r[0] for r in ROWS if r[0] not in (1, 2, 3, 10)), key=repr)
    assert decontaminate.contained(none, items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ROWS)


def test_decontaminate_item_without_id(spark, docs):
    items = spark.createDataFrame([(None, ITEM), (2, "too short")], "item_id long, text string")
    assert keyed(decontaminate.contained(docs, items), "doc_id", "item_id", "n_item", "n_shared") == [(10, None, 26, 26)]
    assert 10 not in [r["doc_id"] for r in decontaminate.clean(docs, items).collect()]


def test_jaccard(docs, none):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect()}
    assert got[1] == (117, 1) and got[2] == (116, 1) and got[3] == (117, 1)
    assert got[4] == (0, 4) and got[5] == (0, 5) and got[6] == (0, 6)
    assert got[7] == (1, 7) and got[8] == (1, 7) and got[None] == (1, None)
    kept = [r["doc_id"] for r in jaccard_join.deduplicated(docs).collect()]
    assert sorted(kept, key=repr) == sorted([1, 4, 5, 6, 7, 9, 10, 11, 12, None], key=repr)
    assert jaccard_join.components(none).count() == 0


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def test_jaccard_against_brute_force_with_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 2000)  # a group of copies is cut into many blocks
    import random
    rnd = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        w = list(base) if i < 110 else [f"u{rnd.randrange(4000)}" for _ in range(50)] + base[:12]
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [shingles(t, 4) for _, t in rows]
    label = list(range(len(rows)))
    for _ in range(8):
        for i in range(len(rows)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert got == dict(enumerate(label))


def test_sanitise(docs, none, spark):
    r = next(x for x in sanitise.spans(docs).collect() if x["doc_id"] == 11)
    text = ROWS[12][1]
    assert [(s["kind"], text[s["lo"]:s["hi"]]) for s in r["spans"]] == [
        ("email", "a.b_c@x-y.org"), ("ip", "10.0.0.255"), ("phone", "+1 (555) 010-9999"), ("card", "4111 1111 1111 1111")] \
        or [s["kind"] for s in r["spans"]] == ["email", "email", "ip", "phone", "card"]
    clean = {x["doc_id"]: x["text"] for x in sanitise.sanitised(docs).collect()}
    assert clean[4] is None and clean[5] == "" and clean[1] == BASE and "[CARD]" in clean[11] and "4111" not in clean[11]
    assert sanitise.spans(none).count() == 0
    # a nickname that is only ever seen beside one address discloses it, and is found without the address too
    told = [(i, f"text {i} filler{i} blah the zorro writes from zorro@mail.org every day of the week {i}") for i in range(5)]
    told += [(100 + i, f"the week of filler{i} writes every day from {i} text blah") for i in range(60)] + [(99, "so Zorro came")]
    got = {x["doc_id"]: x["spans"] for x in sanitise.spans(spark.createDataFrame(told, "doc_id long, text string")).collect()}
    assert [(s["kind"], s["lo"], s["hi"]) for s in got[99]] == [("term", 3, 8)] and not got[100]
    assert [s["kind"] for s in got[0]] == ["term", "email"]


def told_spans(spark, rows):
    found = sanitise.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {x["doc_id"]: [(s["kind"], x["text"][s["lo"]:s["hi"]]) for s in x["spans"]] for x in found}


FILL = [(1000 + i, f"the week of filler{i} writes every day from {i} text blah") for i in range(400)]


def test_sanitise_values_of_two_texts(spark):
    told = [(i, f"the week the zorro writes from zorro@mail.org every day {i}") for i in range(2)]
    told += [(9, "the hapax writes from other@site.org every day")]
    got = told_spans(spark, told + FILL)
    assert got[0] == [("term", "zorro"), ("email", "zorro@mail.org")] == got[1]
    assert got[9] == [("email", "other@site.org")]  # one sighting that nothing else bears out


def test_sanitise_value_of_one_text_by_its_group(spark):
    told = [(i, f"the week the zorro writes from a{i}@firm.org every day") for i in range(4)]
    assert [r["term"] for r in sanitise.disclosing_terms(
        spark.createDataFrame(told, "doc_id long, text string")
        .union(spark.range(60000).select("id", F.concat(F.lit("the week writes from every day of text "), F.col("id"))))).collect()] == ["zorro"]


def test_sanitise_far_short_and_numeric_terms(spark):
    far = " ".join(["the week of text writes every day from blah"] * 6)
    told = [(i, f"Li 4711 {far} zorro@mail.org {far} vega {i}") for i in range(5)]
    got = told_spans(spark, told + FILL)
    assert got[1] == [("term", "Li"), ("term", "4711"), ("email", "zorro@mail.org"), ("term", "vega")]


def test_html(spark):
    menu = "<ul><li>home of the big site and all its many pages</li></ul>"
    rows = [(i, f"http://h.org/{i}", f"<body>{menu}<p>page {i} has text number {i * 7} of its own</p>") for i in range(4)]
    rows += [(9, None, None), (10, "http://x.org", ""), (11, "bad", "<article><p>a&nbsp;b</p></article>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == "page 2 has text number 14 of its own" and got[9] == "" and got[10] == "" and got[11] == "a b"


def test_small_table_queries(spark):
    """Digest columns of the registered queries on the smallest tables, by brute force."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in QUERIES["op1_histogram_shards"](spark, SF_SMALL).collect():
        assert r["text_crc32"] == zlib.crc32((docs[r["doc_id"]] or "").encode()) and r["grown_shard"] is None
    for r in QUERIES["op10_jaccard_join"](spark, SF_SMALL).collect():
        assert r["n_shingles"] == len(shingles(docs[r["doc_id"]] or "", 4))
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    enc, _ = byte_bpe._encoder(byte_bpe.RANKS)
    items = [shingles(" ".join(re.findall(r"[^\W_]+", r["text"].lower())), 5)
             for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    kept = {i: shingles(rows[i], 5) for i in got}
    for i, r in got.items():
        assert r["n_tokens"] == len(enc.encode_ordinary(r["text"])) and r["n_chars"] == len(r["text"])
        own = shingles(" ".join(re.findall(r"[^\W_]+", rows[i].lower())), 5)
        assert not any(5 * len(s & own) >= 4 * len(s) for s in items)
        assert not any(j < i and 5 * len(s & kept[i]) >= 4 * len(s | kept[i]) for j, s in kept.items())


def test_jaccard_copies_cost_no_tokens(spark):
    """Exact copies leave before tokens are made; repeated rows have one body; labels stay whole."""
    texts = [" ".join(f"t{i}w{j}" for j in range(60)) for i in range(20)]
    rows = [(2 * i + j, t) for i, t in enumerate(texts) for j in (0, 1)]
    near = " ".join(f"n{j}" for j in range(90))
    rows += [(100, near)] * 3000 + [(101, near + " x"), (101, near + " x"), (None, near), (50, None), (51, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    base = jaccard_join._sets_of(df, "doc_id", "text")

    def narrow(it):
        for keys, (_, _, n, fp) in jaccard_join._each(it, 4):
            yield jaccard_join._rows(key=keys, fp=fp, n=n)
    sets = base.mapInArrow(narrow, "key long, fp long, n long")
    left = jaccard_join._survivors(base, sets, 4, 85)
    assert left.count() == 2 and {r["rep"] for r in left.collect()} == {100, 101}
    assert jaccard_join._bodies(base, left, 4).count() == 2
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.components(df).collect()}
    want = {(2 * i + j, 2 * i) for i in range(20) for j in (0, 1)} | {(100, 100), (101, 100), (None, 100), (50, 50), (51, 51)}
    assert got == want


def test_working_names_of_operators_may_be_columns(spark):
    """Extra columns that bear the operators' working names stay as they are."""
    names = ["row", "row_", "gone", "gone_", "r", "place", "x", "key", "ids_", "Gone__"]
    df = spark.createDataFrame([(i, "some words of text " * (4 + 40 * i), *range(len(names))) for i in range(3)] * 2,
                               "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    for got in (byte_bpe.encode(df, chunk=500, overlap=60), jaccard_join.deduplicated(df)):
        assert {tuple(r[n] for n in names) for r in got.collect()} == {tuple(range(len(names)))}
    assert byte_bpe.encode(df, chunk=500, overlap=60).count() == 6
    plain = {r["doc_id"]: r for r in byte_bpe.round_trip(df).collect()}
    cut = {r["doc_id"]: r for r in byte_bpe.round_trip(df, chunk=500, overlap=60).collect()}
    assert plain == cut and all(r["decoded_sha256"] == hashlib.sha256(("some words of text " * (4 + 40 * i)).encode()).hexdigest()
                                for i, r in cut.items())
