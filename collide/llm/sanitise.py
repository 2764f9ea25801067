"""Personal data: fixed base spans, and information-theoretic sanitisation of what reveals them.

Only DataFrame functions.  Base spans (email, ip, card, phone) come from patterns and checks;
positions follow from the lengths of the matches and of the text between them.

Every base value is a protected entity e.  Over the distinct texts of the corpus we count
df(e), the texts that hold e; df(w), the texts that hold a term w; and n(e, w), the texts that
hold both, wherever they stand.  A term is any word or number outside of base values.  With N texts

    PMI(e; w) = log2(N * n(e, w) / (df(e) * df(w))),    IC(e) = -log2(df(e) / N)

and w alone tells s(e) = PMI / IC of the information of e.  Every pair that was seen is scored, and
little evidence is shrunk: sightings of weight n are trusted by c(n) = 1 - ``doubt`` ** n, where a text
weighs 1 if w stands within ``reach`` code points of e, and FAR if not.  What is not trusted is
estimated from the texts of other values of the entity's group g (first the domain of an email or
the prefix of a number, then the kind; the better one counts):

    share = c(e, w) * s(e) + (1 - c(e, w)) * c(g, w without e) * s(g)

So two texts (four from afar) can speak for themselves, and a value of one text where its group bears it out; a single
sighting that nothing else supports stays at 1 - ``doubt``, since each rare word of a text meets each
of its values once by chance.  A term whose share reaches ``generalise`` is replaced by a
class label wherever it stands, one that reaches ``remove`` is removed.

Defined results: null text is empty and has no span; repeated rows count once in the statistics
(they are one text); spans of different kinds may overlap; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collide.llm.common import bind, small_enough, staged

#: Fixed by the contract.  Possessive repeats and look-behinds only keep long runs linear: a
#: match may start where the last one ended, but not inside a run whose start has failed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
REACH, FAR, DOUBT = 64, 0.5, 0.25
GENERALISE, REMOVE = 0.9, 0.999
BROADCAST_ROWS = 1_000_000
_SPAN = "array<struct<lo:int,kind_no:int,hi:int,kind:string,value:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    value = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.struct(
        F.substring(d, i, F.lit(1)).cast("int").alias("v"), (i % 2 == 0).alias("twice")))
    total = F.aggregate(value, F.lit(0), lambda a, x: a + F.when(x["twice"], x["v"] * 2 - F.when(x["v"] > 4, 9).otherwise(0))
                        .otherwise(x["v"]))
    return total % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": m.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"),
        "card": F.when((n >= 14) & (n <= 19), _luhn(m)).otherwise(False),
        "phone": (n >= 10) & (n <= 15),
    }[kind]


def _located(matches: Column, gaps: Column, kind: Column, kind_no: int) -> Column:
    """Spans of all matches: lengths of gaps and matches, added up."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(_SPAN).alias("out"))

    def add(acc, m):
        lo = acc["at"] + F.char_length(F.get(gaps, acc["i"]))
        hi = lo + F.char_length(m)
        span = F.struct(lo.alias("lo"), F.lit(kind_no).alias("kind_no"), hi.alias("hi"), kind.alias("kind"), m.alias("value"))
        return F.struct(hi.alias("at"), (acc["i"] + 1).alias("i"), F.concat(acc["out"], F.array(span)).alias("out"))
    return F.when(F.size(matches) == 0, F.array().cast(_SPAN)).otherwise(
        F.aggregate(matches, start, add, lambda acc: acc["out"]))


def _valid(kind: str):
    return lambda s: _holds(kind, s["value"])


_GATE = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def base_spans(docs: DataFrame, text: str, out: str = "base") -> DataFrame:
    """``docs`` plus all base spans, by start and kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    for kind, pattern in PATTERNS.items():
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        if _GATE[kind]:
            found = F.when(F.contains(t, F.lit(_GATE[kind])), found).otherwise(none)
        docs = bind(docs, f"__m_{kind}", found)
    for kind, pattern in PATTERNS.items():
        docs = bind(docs, f"__g_{kind}", F.when(F.size(f"__m_{kind}") > 0, F.split(t, pattern, -1)).otherwise(none))
    spans = []
    for no, kind in enumerate(PATTERNS):
        all_ = _located(F.col(f"__m_{kind}"), F.col(f"__g_{kind}"), F.lit(kind), no)
        spans.append(F.filter(all_, _valid(kind)))
    docs = bind(docs.drop(out), out, F.array_sort(F.concat(*spans)))
    return docs.drop(*[f"__{x}_{k}" for x in "mg" for k in PATTERNS])


def terms_of(text: Column) -> Column:
    """Distinct lower-cased words, numbers and short ones too."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def _outside(text: Column, found: Column) -> Column:
    """``text`` without its spans (sorted by start; they may overlap)."""
    ends = F.transform(found, lambda s, i: F.when(i == 0, 0).otherwise(F.array_max(F.slice(found, 1, i)["hi"])))
    parts = F.zip_with(found, ends, lambda s, at: F.substring(text, at + 1, s["lo"] - at))
    return F.concat(F.array_join(parts, " "), F.lit(" "), F.substring(text, F.array_max(found["hi"]) + 1, F.char_length(text)))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small_enough(df, BROADCAST_ROWS) else df


def groups_of(kind: Column, value: Column) -> Column:
    """The groups of a protected value: the domain of an email or the first digits of a number, and the kind."""
    near = (F.when(kind == "email", F.lower(F.substring_index(value, "@", -1)))
            .when(kind == "ip", F.substring_index(value, ".", 2))
            .otherwise(F.substring(_digits(value), 1, F.when(kind == "card", 6).otherwise(4))))
    return F.array(F.xxhash64(F.lit("group"), kind, near), F.xxhash64(F.lit("kind"), kind))


def sightings(corpus: DataFrame, reach: int = REACH) -> DataFrame:
    """Distinct texts with a protected value: (th, values: the values with their groups and the terms near
    them, terms: all terms)."""
    t, s = F.col("t"), F.col("s")
    held = (base_spans(corpus, "t").where(F.size("base") > 0)
            .groupBy("th").agg(F.first(F.struct("t", "base")).alias("x")).select("th", "x.*"))
    held = bind(held, "terms", terms_of(_outside(t, F.col("base")))).select("th", "t", "terms", F.explode("base").alias("s"))
    left = F.substring(t, F.greatest(F.lit(0), s["lo"] - reach) + 1, F.least(F.lit(reach), s["lo"]))
    right = F.substring(t, s["hi"] + 1, F.lit(reach))
    # a word cut by the window is not near
    left = F.when(s["lo"] > reach, F.regexp_replace(left, r"^[\p{L}\p{N}]+", "")).otherwise(left)
    right = F.regexp_replace(right, r"[\p{L}\p{N}]+$", "")
    value = F.struct(F.xxhash64(s["kind"], s["value"]).alias("e"), groups_of(s["kind"], s["value"]).alias("groups"),
                     terms_of(F.concat(left, F.lit(" "), right)).alias("near"))
    return staged(held.select("th", "terms", value.alias("v")).groupBy("th").agg(
        F.first("terms").alias("terms"), F.collect_list("v").alias("values")), "pii-seen")


def _counted(seen: DataFrame, wanted: DataFrame | None, key: Column, name: str, out: str) -> DataFrame:
    """(name, term, n and weight of the texts with both) for a key of the values, or an array of keys."""
    keys = seen.select("th", "terms", F.explode("values").alias("v")).select("th", "terms", F.explode(key).alias(name), "v.near")
    keys = keys.groupBy("th", name).agg(F.first("terms").alias("terms"), F.flatten(F.collect_set("near")).alias("near"))
    pairs = keys.select(name, "near", F.explode("terms").alias("term"))
    if wanted is not None:
        pairs = pairs.join(wanted, "term")
    weight = F.when(F.array_contains("near", F.col("term")), 1.0).otherwise(FAR)
    return pairs.groupBy(name, "term").agg(F.count(F.lit(1)).alias(out), F.sum(weight).alias(f"{out}_weight"))


def disclosing_terms(docs: DataFrame, text: str = "text", reach: int = REACH, doubt: float = DOUBT,
                     generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(term, share, action) for every term that discloses some protected entity beyond the threshold."""
    t = F.coalesce(F.col("t"), F.lit(""))
    corpus = docs.select(F.col(text).alias("t")).withColumn("th", F.xxhash64("t"))
    seen = sightings(corpus, reach)
    total = corpus.select("th").distinct().count()
    n_all = F.lit(float(total))

    def trust(n: Column) -> Column:
        return 1 - F.pow(F.lit(doubt), n)

    def told(n: Column, df: Column, df_w: Column) -> Column:
        """PMI / IC; nothing where the texts are all alike or the two avoid each other."""
        return F.when(df < total, F.greatest(F.lit(0.0), F.log2(n_all * n / (df * df_w)) / -F.log2(df / n_all))).otherwise(0.0)
    one = seen.select("th", F.explode("values").alias("v")).select("th", "v.e", "v.groups").distinct()
    df_e = one.groupBy("e").agg(F.first("groups").alias("groups"), F.count(F.lit(1)).alias("df_e"))
    joint = _counted(seen, None, F.array("v.e"), "e", "n")
    # df(w) is at least the number of texts with w and any protected value, and no group has seen w in
    # more: an upper bound of the share, by which everyday words fall out before the corpus is counted
    held_w = seen.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_held"))
    n, c, others = F.col("n"), trust(F.col("n_weight")), F.col("df_held") - F.col("n_weight")
    pairs = (joint.join(df_e, "e").join(held_w, "term")
             .where(c * told(n, F.col("df_e"), F.col("df_held"))
                    + F.when(F.col("df_held") > n, (1 - c) * trust(others)).otherwise(0.0) >= generalise - 1e-9)
             .drop("df_held"))
    pairs = staged(pairs, "pii-pairs")
    if pairs.isEmpty():
        return pairs.select("term", F.lit(0.0).alias("share"), F.lit("").alias("action"))
    terms = _small(staged(pairs.select("term").distinct(), "pii-terms"))
    df_w = (corpus.select("th", F.explode(terms_of(t)).alias("term")).join(terms, "term").distinct()
            .groupBy("term").agg(F.count(F.lit(1)).alias("df_w")))
    df_g = one.select("th", F.explode("groups").alias("g")).distinct().groupBy("g").agg(F.count(F.lit(1)).alias("df_g"))
    n_g = _counted(seen, terms, F.col("v.groups"), "g", "n_g")
    full = (pairs.join(df_w, "term").select("*", F.explode("groups").alias("g"))
            .join(n_g, ["g", "term"]).join(df_g, "g"))
    # without other texts the group's sightings are the value's own
    others = F.when(F.col("n_g") > n, trust(F.col("n_g_weight") - F.col("n_weight"))).otherwise(0.0)
    share = c * told(n, F.col("df_e"), F.col("df_w")) + (1 - c) * others * told(
        F.col("n_g"), F.col("df_g"), F.col("df_w"))
    best = (full.withColumn("share", share)
            .groupBy("term").agg(F.max("share").alias("share")).where(F.col("share") >= generalise))
    return staged(best.withColumn("action", F.when(F.col("share") >= remove, "remove").otherwise("generalise")), "pii-found")


def spans(docs: DataFrame, text: str = "text", out: str = "spans", **options) -> DataFrame:
    """``docs`` plus all spans: struct(lo, kind_no, hi, kind, value) by start and kind; the value of a term
    span is its action."""
    terms = disclosing_terms(docs, text, **options)
    based = base_spans(docs, text, out)
    if terms.isEmpty():
        return based
    t = F.coalesce(F.col(text), F.lit(""))
    hits = (docs.select(F.xxhash64(text).alias("__th"), F.explode(terms_of(t)).alias("term"))
            .join(_small(terms.select("term", "action")), "term").distinct()
            .groupBy("__th").agg(F.collect_list(F.struct("term", "action")).alias("__terms")))
    hits = _small(staged(hits, "pii-hits"))
    both = based.withColumn("__th", F.xxhash64(text)).join(hits, "__th", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.concat_ws("|", F.col("__terms.term")), F.lit(r")(?![\p{L}\p{N}])"))
    none = F.array().cast("array<string>")
    both = bind(both, "__m", F.when(F.col("__terms").isNotNull(), F.regexp_extract_all(t, pattern, F.lit(0))).otherwise(none))
    both = bind(both, "__g", F.when(F.size("__m") > 0, F.split(t, pattern, -1)).otherwise(none))
    added = _located(F.col("__m"), F.col("__g"), F.lit("term"), len(PATTERNS))
    added = F.transform(added, lambda s: s.withField("value", F.coalesce(F.get(
        F.transform(F.filter(F.col("__terms"), lambda x: x["term"] == F.lower(s["value"])), lambda x: x["action"]), F.lit(0)),
        F.lit("generalise"))))
    added = F.filter(added, lambda s: ~F.exists(F.col(out), lambda b: (b["lo"] < s["hi"]) & (s["lo"] < b["hi"])))
    added = F.when(F.size("__m") > 0, added).otherwise(F.array().cast(_SPAN))
    both = bind(both, "__all", F.array_sort(F.concat(F.col(out), added)))
    return both.drop("__th", "__terms", "__m", "__g", out).withColumnRenamed("__all", out)


def sanitised(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every span of ``text`` replaced: base kinds and generalised terms by a label in
    brackets, removed terms by nothing.  Overlapping spans become one, labelled by the first."""
    found = spans(docs, text, "__spans", **options)

    def merge(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(last.withField("hi", F.greatest(last["hi"], s["hi"]))))
        return F.when(F.size(acc) == 0, F.array(s)).when(s["lo"] < last["hi"], joined).otherwise(F.concat(acc, F.array(s)))
    t = F.col(text)
    found = bind(found, "__merged", F.aggregate("__spans", F.array().cast(_SPAN), merge))
    sp = F.col("__merged")

    def piece(s, i):
        before = F.when(i == 0, F.lit(0)).otherwise(F.get(sp, i - 1)["hi"])
        label = F.when((s["kind"] == "term") & (s["value"] == "remove"), F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.substring(t, before + 1, s["lo"] - before), label)
    rest = F.substring(t, F.element_at(sp, -1)["hi"] + 1, F.char_length(t))
    new = F.when(F.size(sp) == 0, t).otherwise(F.concat(F.array_join(F.transform(sp, piece), ""), rest))
    return found.withColumn(text, F.when(t.isNull(), t).otherwise(new)).drop("__spans", "__merged")


def joined(found: Column, kinds=KINDS) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    kept = F.filter(found, lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["lo"].cast("string"), s["hi"].cast("string"))), ",")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
