"""N-gram Jaccard join by prefix filters under several global token orders.

A document's set is the distinct hashes of its k-word shingles; documents with one set are
one node.  If two sets reach the threshold t they share at least ceil(t * n) tokens of either,
hence under every global order of the tokens their prefixes of n - ceil(t * n) + 1 tokens meet,
and their prefixes longer by l - 1 tokens share l tokens.  The steps, all exact:

1. Hash order, long prefixes: a set of whose long prefix fewer than l tokens occur elsewhere
   has no partner.  (Most documents end here; tokens travel as 40-bit numbers -- a collision can
   only add candidates.)
2. The tokens of the remaining sets are counted.  Order j ranks tokens by the binary logarithm
   of their count and then by hash j, so rare tokens come first in every order and passages
   that many documents share stay out of the prefixes.
3. For every order, sets that meet in a prefix token are joined to the smallest of them (linear
   in the prefix entries, whatever a token's frequency) and the classes of this relation are
   taken.  Only sets in one class under every order can be partners.
4. Each class is verified in blocks of bounded size: sets are dealt by size (partners differ in
   size by t at most) and by hash; a pair that shares a prefix token under every order is
   checked by its exact intersection.  Blocks return a spanning forest of their links.

Tokens are 48-bit hashes (two sets of n tokens: chance n * n / 2**48 that one token matches
wrongly), set fingerprints have 64 bits (n documents: chance n * n / 2**65 of one false match).

Defined results: text is lower-cased in A-Z; a text of fewer than k words is one shingle; null and
wordless texts have an empty set and are linked with nothing; a null key is its own component
unless its set is linked; repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collide.llm.common import (as_bytes, connected_components, free_name, give_back, keyed_join, mix, shingle_hashes,
                                slices, staged, word_hashes)

ORDERS = 3
BLOCK_TOKENS = 1 << 17
TOKEN_BITS = 40  # of a token's number in the candidate steps
_U = np.uint64


def needed(n, percent: int):
    """ceil(percent % of n): the least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def spare(n, percent: int):
    """l - 1 of the long prefix."""
    return np.minimum(n // 20, needed(n, percent) - 1)


def token_sets(raw: list[bytes], k: int):
    """(tokens ascending per text, text of each token, set size per text, fingerprint per text)."""
    h, doc, words = word_hashes(raw)
    s, d = shingle_hashes(h, doc, words, k)
    # one sort: the number of the text above the leading 48 bits of the token
    both = np.sort((d.astype(_U) << _U(48)) | (s >> _U(16)))
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    s, d = both << _U(16), (both >> _U(48)).astype(np.int64)
    n = np.bincount(d, minlength=len(raw))
    end = np.concatenate([np.zeros(1, _U), np.cumsum(mix(s ^ _U(0xA5A5A5A5A5A5A5A5)), dtype=_U)])
    stop = np.cumsum(n)
    fp = mix(end[stop] - end[stop - n] + n.astype(_U)).view(np.int64)
    return s, d, n, fp


def _short(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> _U(24)).astype(np.int64)


def _sets_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t"))


def _each(it: Iterator[pa.RecordBatch], k: int):
    try:
        for batch in it:
            raw = as_bytes(batch.column(1))
            for lo, hi in slices(raw):
                for a in range(lo, hi, 1 << 16):  # token_sets numbers texts in 16 bits
                    b = min(hi, a + (1 << 16))
                    yield batch.column(0).slice(a, b - a), token_sets(raw[a:b], k)
    finally:
        give_back()


def _copies(sets: DataFrame) -> DataFrame:
    """(key): keys none of whose rows stands for its set -- every one is a copy of a set that has a smaller key."""
    shared = sets.where("n > 0").groupBy("fp").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("m")).where("m > 1")
    stands = sets.join(shared.select("fp", "rep"), "fp", "left").where("key is not null").groupBy("key").agg(
        F.max(F.col("rep").isNull() | (F.col("rep") == F.col("key"))).alias("stands"))
    return stands.where("not stands").select("key")


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for k, v in columns.items()})


def _long_prefix(s, d, n, fp, percent: int, once: bool):
    """Mask of the tokens in the long prefixes (of one text per set of this run, if ``once``)."""
    start = np.cumsum(n) - n
    rank = np.arange(len(s)) - start[d]
    keep = rank < (n - needed(n, percent) + 1 + spare(n, percent))[d]
    if once:
        one = np.zeros(len(n), bool)
        one[np.unique(fp, return_index=True)[1]] = True
        keep &= one[d]
    return keep


def _survivors(base: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """(sid, fp, n, rep, many): sets that step 1 leaves, each with one document that holds it, and whether
    rows repeat that document.  Copies of other documents are left out before any token is made."""
    base = base.join(staged(_copies(sets), "jac-copies"), "key", "left_anti")

    def tokens(it):
        for _, (s, d, n, fp) in _each(it, k):
            yield _rows(tok=_short(s[_long_prefix(s, d, n, fp, percent, True)]))

    def pairs(it):
        for _, (s, d, n, fp) in _each(it, k):
            m = _long_prefix(s, d, n, fp, percent, True)
            yield _rows(tok=_short(s[m]), fp=fp[d[m]])

    live = staged(base.mapInArrow(tokens, "tok long").groupBy("tok").agg(F.count(F.lit(1)).alias("c"))
                  .where("c > 1").select("tok"), "jac-live")
    met = (base.mapInArrow(pairs, "tok long, fp long").join(live, "tok", "left_semi")
           .groupBy("fp").agg(F.count(F.lit(1)).alias("c")))
    same = sets.where("n > 0").groupBy("fp", "key").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    one = same.groupBy("fp").agg(F.min("key").alias("rep"), F.max("n").alias("n"), F.min_by("rows", "key").alias("rows"),
                                 F.max(F.when(F.col("key").isNull(), F.col("rows"))).alias("unnamed"))
    # a partner has at least ceil(t * n) tokens, and its long prefix may be that much shorter
    m = F.ceil(F.col("n") * percent / 100)
    least = F.least(F.floor(m / 20), F.ceil(m * percent / 100) - 1) + 1
    return staged(met.join(one, "fp").where(F.col("c") >= least)
                  .select(F.monotonically_increasing_id().alias("sid"), "fp", "n", "rep",
                          (F.when(F.col("rep").isNull(), F.col("unnamed")).otherwise(F.col("rows")) > 1).alias("many")),
                  "jac-sets")


def _bodies(base: DataFrame, survivors: DataFrame, k: int) -> DataFrame:
    """(sid, n, toks) of the surviving sets, from the one document that stands for each.

    The documents are picked by key first, so only their texts are read into tokens (and, where
    the keys are too many to broadcast, only texts are shuffled)."""
    def bodies(it):
        for keys, (s, d, n, fp) in _each(it, k):
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            toks = pa.ListArray.from_arrays(offsets, pa.array(s.view(np.int64), pa.int64()))
            yield _rows(key=keys, fp=fp, toks=toks)

    reps = staged(survivors.select("rep").distinct(), "jac-reps")
    wide = base.join(reps, F.col("key").eqNullSafe(F.col("rep")), "left_semi").mapInArrow(
        bodies, "key long, fp long, toks array<long>")
    own = wide.join(survivors, "fp").where(F.col("key").eqNullSafe(F.col("rep")))
    # rows that repeat one document have one body
    body = own.where("not many").select("sid", "n", "toks").union(
        own.where("many").groupBy("sid").agg(F.first("n").alias("n"), F.first("toks").alias("toks")))
    return staged(body, "jac-bodies")


def _prefixes(bodies: DataFrame, percent: int, orders: int) -> DataFrame:
    """(sid, pre): per order the counted tokens of the prefix; sets whose prefixes hold none are left out."""
    token = F.call_function("shiftrightunsigned", F.col("x"), F.lit(24))
    flat = bodies.select("sid", F.explode("toks").alias("x")).select("sid", token.alias("tok"))
    counts = (bodies.select(F.explode("toks").alias("x")).select(token.alias("tok")).groupBy("tok")
              .agg(F.count(F.lit(1)).alias("c")).where("c > 1")
              .select("tok", (F.length(F.bin("c")) - 1).cast("int").alias("rank")))
    packed = F.shiftleft(F.col("rank").cast("long"), TOKEN_BITS).bitwiseOR(F.col("tok"))  # one number, not a struct
    seen = (flat.join(counts, "tok").groupBy("sid").agg(F.collect_list(packed).alias("live"))
            .join(bodies.select("sid", "n"), "sid"))

    @F.pandas_udf("array<array<long>>")
    def prefix(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for live, size in it:
            out = []
            for rows, n in zip(live, size):
                both = np.asarray(rows, np.int64)
                rank, tok = both >> TOKEN_BITS, both & ((1 << TOKEN_BITS) - 1)
                left = n - needed(n, percent) + 1 - (n - len(tok))  # uncounted tokens come first
                if left <= 0:
                    out.append(None)
                    continue
                out.append([tok[np.lexsort((mix(tok.astype(_U) + _U((j + 1) << 48)), rank))[:left]].tolist()
                            for j in range(orders)])
            yield pd.Series(out, index=live.index, dtype=object)

    return staged(seen.select("sid", prefix("live", "n").alias("pre")).where("pre is not null"), "jac-prefix")


def _classes(prefixes: DataFrame, orders: int) -> DataFrame:
    """(sid, g): the class of a set under all orders at once; sets that are alone under some order are left out."""
    rows = (prefixes.select("sid", F.posexplode("pre").alias("j", "toks"))
            .select((F.col("sid") * 4 + F.col("j")).alias("node"), "j", F.explode("toks").alias("tok"))
            .select("node", (F.col("tok") * 4 + F.col("j")).alias("tok")))
    least = rows.groupBy("tok").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("tok", "lo")
    edges = rows.join(least, "tok").where("node != lo").select("node", "lo")
    comp = connected_components(edges, "node", "lo", "jac-order")
    return (comp.select(F.shiftright("node", 2).alias("sid"), (F.col("node") % 4).alias("j"), "component")
            .groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("j", "component"))).alias("c"))
            .where(F.size("c") == orders).select("sid", F.xxhash64("c").alias("g")))


def meeting(pre_a: list, pre_b: list, orders: int) -> np.ndarray:
    """Which pairs (a, b) share a prefix token under every order."""
    ok = np.ones((len(pre_a), len(pre_b)), bool)
    for j in range(orders):
        la, lb = [np.asarray(p[j], np.int64) for p in pre_a], [np.asarray(p[j], np.int64) for p in pre_b]
        col = np.intersect1d(np.concatenate(la), np.concatenate(lb))
        hit = np.zeros(ok.shape, bool)
        for at in range(0, len(col), 4096):
            part = col[at:at + 4096]
            hit |= _incidence(la, part) @ _incidence(lb, part).T > 0
        ok &= hit
    return ok


def _incidence(sets: list[np.ndarray], cols: np.ndarray) -> np.ndarray:
    m = np.zeros((len(sets), len(cols)), np.float32)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(cols, flat), len(cols) - 1)
    good = cols[at] == flat
    m[row[good], at[good]] = 1
    return m


def overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray], ok: np.ndarray) -> np.ndarray:
    """Exact intersection sizes (at least where ``ok``): by products of incidence matrices, or pair by pair
    where few pairs are left."""
    col = np.intersect1d(np.concatenate(sets_a), np.concatenate(sets_b))
    out = np.zeros(ok.shape, np.int64)
    if ok.sum() * 5e-5 < ok.size * len(col) * 1e-10 + 1e-4:
        for a, b in zip(*np.nonzero(ok)):
            out[a, b] = len(np.intersect1d(sets_a[a], sets_b[b], assume_unique=True))
        return out
    for at in range(0, len(col), 4096):
        part = col[at:at + 4096]
        out += np.rint(_incidence(sets_a, part) @ _incidence(sets_b, part).T).astype(np.int64)
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            parent[p] = q
            out.append((x, y))
    return out


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Members with the key of every block that they take part in, and their side in it.

    Classes that fit are one block.  Larger ones are cut by size (ratio a little below t, so
    partners are in the same or neighbouring cuts) and by hash, and blocks meet in pairs."""
    whole = members.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("tokens")).where("m > 1")
    base = float(-np.log(percent / 100 - 0.01)) if percent > 1 else 100.0
    cut = F.when(F.col("tokens") <= BLOCK_TOKENS, F.lit(0)).otherwise(F.floor(F.log(F.col("n")) / base) + 1).cast("int")
    cutted = members.join(whole.select("g", "tokens"), "g").withColumn("c", cut)
    parts = (cutted.groupBy("g", "c").agg(F.sum("n").alias("s"))
             .select("g", "c", F.ceil(F.col("s") / BLOCK_TOKENS).cast("int").alias("salts")))
    table = parts.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("c", "salts"))).alias("salts"))
    own = cutted.join(table, "g")
    own = own.withColumn("s", F.pmod(F.xxhash64("sid"), F.element_at("salts", F.col("c"))).cast("int"))

    def keys(other: Column, count: Column) -> Column:
        each = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(each, lambda t: F.when(
            (other > F.col("c")) | ((other == F.col("c")) & (t >= F.col("s"))),
            F.struct(F.col("c").alias("c1"), F.col("s").alias("s1"), other.alias("c2"), t.alias("s2"), F.lit(0).alias("side")))
            .otherwise(F.struct(other.alias("c1"), t.alias("s1"), F.col("c").alias("c2"), F.col("s").alias("s2"),
                                F.lit(1).alias("side"))))

    def count(c: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("salts"), c), F.lit(0))
    c = F.col("c")
    every = F.concat(keys(c, count(c)), keys(c + 1, F.when(c > 0, count(c + 1)).otherwise(0)),
                     keys(c - 1, F.when(c > 1, count(c - 1)).otherwise(0)))
    return own.select("g", "sid", F.explode(every).alias("k")).select("g", "sid", "k.*")


def _links(bodies: DataFrame, prefixes: DataFrame, classes: DataFrame, percent: int, orders: int) -> DataFrame:
    """(a, b) set numbers: a spanning forest of the links inside every block."""
    members = staged(classes.join(bodies.select("sid", "n"), "sid"), "jac-members")
    blocks = _blocks(members, percent)
    # bodies and prefixes of sets without a possible partner stay where they are
    several = members.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("g")
    wanted = staged(members.join(several, "g", "left_semi").select("sid"), "jac-wanted")
    rows = (blocks.join(bodies.join(wanted, "sid", "left_semi"), "sid")
            .join(prefixes.join(wanted, "sid", "left_semi"), "sid"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        one = (pdf["c1"].iloc[0], pdf["s1"].iloc[0]) == (pdf["c2"].iloc[0], pdf["s2"].iloc[0])
        pdf = pdf.drop_duplicates("sid")
        left = pdf if one else pdf[pdf["side"] == 0]
        right = pdf if one else pdf[pdf["side"] == 1]
        if not len(left) or not len(right) or len(pdf) < 2:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        ok = meeting(list(left["pre"]), list(right["pre"]), orders)
        na, nb = left["n"].to_numpy(np.int64)[:, None], right["n"].to_numpy(np.int64)[None, :]
        ok &= 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
        if one:
            ok &= np.tri(len(left), k=-1, dtype=bool)
        if not ok.any():
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        sa = [np.asarray(t, np.int64) for t in left["toks"]]
        sb = sa if one else [np.asarray(t, np.int64) for t in right["toks"]]
        common = overlaps(sa, sb, ok)
        linked = ok & (100 * common >= percent * (na + nb - common))
        i, j = np.nonzero(linked)
        found = _forest(left["sid"].to_numpy()[i], right["sid"].to_numpy()[j])
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("g", "c1", "s1", "c2", "s2").applyInPandas(verify, "a long, b long")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85,
               orders: int = ORDERS) -> DataFrame:
    """(key, n_shingles, component_id) per document: the smallest key reachable by links of at least ``percent`` %."""
    if not 2 <= orders <= 4:
        raise ValueError("between 2 and 4 orders")
    base = _sets_of(docs, key, text)

    def narrow(it):
        for keys, (_, _, n, fp) in _each(it, k):
            yield _rows(key=keys, fp=fp, n=n)

    sets = staged(base.mapInArrow(narrow, "key long, fp long, n long"), "jac-docs")
    left = _survivors(base, sets, k, percent)
    bodies = _bodies(base, left, k)
    prefixes = _prefixes(bodies, percent, orders)
    links = _links(bodies, prefixes, _classes(prefixes, orders), percent, orders)
    comp = connected_components(links, "a", "b", "jac-links")
    # every linked set gets the smallest key of its class; all others keep the smallest key of their own set
    one = sets.groupBy("fp").agg(F.min("key").alias("lo"), F.count(F.lit(1)).alias("weight"))
    of = comp.join(left.select(F.col("sid").alias("node"), "fp", "rep"), "node")
    lowest = of.groupBy("component").agg(F.min("rep").alias("m"))
    label = (one.join(of.join(lowest, "component").select("fp", "m"), "fp", "left")
             .select("fp", F.coalesce("m", "lo").alias("m"), "weight"))
    found = keyed_join(sets, staged(label, "jac-label"), "fp")
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("m")).otherwise(F.col("key")).alias("component_id"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80,
                 orders: int = ORDERS) -> DataFrame:
    """``docs`` with one document of each group of linked documents: the one with the smallest key.

    Rows without a key cannot be told apart and stay; rows that repeat the smallest key stay with it."""
    found = components(docs, key, text, k, percent, orders)
    name = free_name(docs.columns, "gone")
    gone = staged(found.where(F.col(key).isNotNull() & (F.col("component_id") != F.col(key)))
                  .select(F.col(key).alias(name)).distinct(), "jac-gone")
    return docs.join(gone, F.col(key) == F.col(name), "left_anti")
