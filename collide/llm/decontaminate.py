"""Benchmark decontamination: size-partitioned MinHash containment search, exactly verified.

Only DataFrame functions.  Words are runs of letters and digits, lower-cased; a set is the
distinct hashes of the ``words``-word shingles.

Index side (documents): sets are partitioned by size into classes of a factor of two.  The
hash space is cut into 2**(class + 3) equal bins, and the signature of a set is the smallest
hash of every occupied bin (one-permutation MinHash) -- so its length follows the class and a
short item is found inside a long document as surely as inside a short one.  Bins of a larger
class refine those of a smaller one; hence a shingle of an item is in the item's signature for
all classes from one ``least_class`` on, and each item is stored once with that class.

A document and an item are candidates if they share a signature entry of the document's class.
With s shared shingles the chance of no common entry is at most about 0.12**s; items of fewer
than ``exact_below`` shingles are looked up by all shingles instead.  Candidates are verified
by the exact containment of the shingles themselves.

Defined results: texts or items of fewer than ``words`` words have no shingle and are never
found or matched; null and repeated ids are kept (documents and items meet by their texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collide.llm.common import bind, small_enough, staged

WORDS = 5
PERCENT = 80
EXACT_BELOW = 8
SPARE_BITS = 3
#: Largest table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_sets(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """``df`` plus the sorted distinct shingle hashes of ``text`` (empty array if too short)."""
    hashed = bind(df, "__w", F.transform(word_list(F.col(text)), lambda w: F.xxhash64(w)))
    w = F.col("__w")
    runs = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (words - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, words)]))
    return bind(hashed, out, F.sort_array(F.array_distinct(runs))).drop("__w")


def shingle_texts(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """``df`` plus the distinct shingles of ``text`` themselves."""
    split = bind(df, "__w", word_list(F.col(text)))
    w = F.col("__w")
    runs = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (words - 1), F.lit(0))),
                       lambda x, i: F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, words)]))
    return bind(split, out, F.array_distinct(runs)).drop("__w")


def size_class(n: Column) -> Column:
    """floor(log2(n)) of a positive count."""
    return F.coalesce(F.length(F.bin(n.cast("long"))) - 1, F.lit(0))


def signature(hashes: Column, klass: Column) -> Column:
    """The smallest hash of every occupied bin of the class (``hashes`` is sorted)."""
    def bin_of(x: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, F.lit(64 - SPARE_BITS) - klass)
    return F.filter(hashes, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(hashes, i - 1))))


def item_index(items: DataFrame, key: str, text: str, words: int = WORDS) -> DataFrame:
    """(item, n, x, least_class): every shingle of every item with the first class that has it in its signature."""
    sets = shingle_sets(items.select(F.col(key).alias("item"), F.col(text).alias("t")), "t", "s", words)
    s = F.col("s")
    sets = sets.withColumn("n", F.size("s")).withColumn("e", F.transform(s, lambda x, i: F.struct(
        x.alias("x"), F.when(i == 0, F.lit(64)).otherwise(
            F.length(F.bin(x.bitwiseXOR(F.get(s, i - 1))))).alias("differ"))))
    return sets.select("item", "n", F.explode("e").alias("e")).select(
        "item", "n", "e.x", F.greatest(F.lit(0), F.lit(64 - SPARE_BITS + 1) - F.col("e.differ")).alias("least_class"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small_enough(df, BROADCAST_ROWS) else df


def candidates(docs: DataFrame, index: DataFrame, text: str, words: int = WORDS,
               exact_below: int = EXACT_BELOW) -> DataFrame:
    """Distinct (text hash, item) that share a signature entry (or any shingle of a tiny item)."""
    sets = shingle_sets(docs.select(F.xxhash64(text).alias("th"), F.col(text).alias("t")), "t", "s", words)
    sets = sets.select("th", "s", size_class(F.size("s")).alias("c"))
    entries = sets.select("th", "c", F.explode(signature(F.col("s"), F.col("c"))).alias("x"))
    found = (entries.join(_small(index.where(F.col("n") >= exact_below)), "x")
             .where("c >= least_class").select("th", "item"))
    tiny = index.where(F.col("n") < exact_below)
    if not tiny.isEmpty():
        found = found.union(sets.select("th", F.explode("s").alias("x")).join(_small(tiny), "x").select("th", "item"))
    return found.distinct()


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
              item_text: str = "text", words: int = WORDS, percent: int = PERCENT,
              exact_below: int = EXACT_BELOW) -> DataFrame:
    """(key, item_key, n_item, n_shared) of every document that holds at least ``percent`` % of an item's shingles."""
    named = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("t")).withColumn("item", F.xxhash64("t"))
    texts = named.select("item", "t").distinct()
    index = staged(item_index(texts, "item", "t", words), "bench-index")
    found = staged(candidates(docs, index, text, words, exact_below), "bench-candidates")
    wanted = _small(staged(found.groupBy("th").agg(F.collect_set("item").alias("items")), "bench-wanted"))
    hit = (docs.select(F.col(key).alias("k"), F.col(text).alias("t")).withColumn("th", F.xxhash64("t")).join(wanted, "th"))
    hit = shingle_texts(hit, "t", "own", words).select("k", "own", F.explode("items").alias("item"))
    whole = shingle_texts(texts, "t", "need", words).select("item", "need")
    whole = _small(staged(whole.join(named.select("item", "item_id"), "item"), "bench-items"))
    shared = hit.join(whole, "item").select(
        F.col("k").alias(key), F.col("item_id").alias(item_key), F.size("need").cast("long").alias("n_item"),
        F.size(F.array_intersect("own", "need")).cast("long").alias("n_shared"))
    return shared.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold a benchmark item (matched by text, so null and repeated ids are safe)."""
    keyed = docs.select(F.col(text).alias("text")).withColumn("doc_id", F.xxhash64("text"))
    bad = contained(keyed, items, **options).select("doc_id").distinct().withColumnRenamed("doc_id", "__th")
    bad = staged(bad, "bench-bad")
    return docs.withColumn("__th", F.xxhash64(text)).join(_small(bad), "__th", "left_anti").drop("__th")


ORACLE_SQL = r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from documents),
held as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) as s
  from words),
item_words as (
  select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from benchmark),
need as (
  select distinct item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) as s
  from item_words),
size as (select item_id, count(*) as n_item from need group by item_id)
select h.doc_id, n.item_id, any_value(z.n_item) as n_item, count(*) as n_shared
from held h join need n using (s) join size z on z.item_id = n.item_id
group by h.doc_id, n.item_id
having 100 * count(*) >= 80 * any_value(z.n_item)
"""
