"""The registered queries of the training-data operators: one per operator, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide.llm import (byte_bpe, collocations, decontaminate, histogram_shards, html_text, huffman_ids, jaccard_join,
                         quality, sanitise, simhash, token_alignment, token_counts, toxicity)
from collide.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out fifth are never learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = toxicity.fit(docs, labels.where(~held))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    p = F.col("toxicity.score")
    return scored.select("doc_id", held.alias("held_out"), p.alias("score"), (p >= 0.5).cast("int").alias("predicted"),
                         F.size("toxicity.sentences").alias("n_offending"))


@query
def op3_quality_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the calibrated n-gram verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.verdict(docs.select("doc_id", "text"), model).select("doc_id", "quality.*")


@query
def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back: place, size and checksum of every document's ids."""
    path = huffman_ids.fresh_path(spark)
    huffman_ids.write_tokens(table(spark, sf_dir, "documents"), path)
    return huffman_ids.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, and whether it exceeds 2048."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return token_counts.count_tokens(docs).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes that they decode to, as digests."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by sizes in bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return histogram_shards.assign(docs).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the shared shingles."""
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op6_decontaminate"] = decontaminate.ORACLE_SQL


@query
def op5_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and disclosing-term spans of every document."""
    found = sanitise.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col("spans")
    return found.select("doc_id", *[sanitise.count_of(s, k).alias(f"n_{k}") for k in sanitise.KINDS],
                        F.sha2(sanitise.joined(s, list(sanitise.PATTERNS)), 256).alias("base_sha256"),
                        sanitise.joined(s).alias("spans"))


@query
def op8_host_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    text = html_text.extract(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under 4-word shingles and a Jaccard similarity of 85 %."""
    return jaccard_join.components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op11_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_collocations"] = collocations.ORACLE_SQL


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers in every document, with the corpus counts of the links."""
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"))
