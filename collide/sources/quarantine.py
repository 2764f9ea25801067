"""Quarantine of bad rows (S1, P12): one pass splits an input into good rows and rows with their reasons.

A scan in FAILFAST mode stops at the first bad row; here the scan is permissive,
every row gets the array of its ``reasons`` (empty: good), and one write puts both kinds
into one committed folder, partitioned by ``bad``.  Good and bad counts therefore add up to the rows
of the input, whatever happens to the tasks.

Reasons are ``malformed`` (the text does not parse under the schema), ``<column>:<rule>`` for the rules of
``operators.validate`` and ``label:fractional``.  A malformed row gives that one reason, since its parsed
fields mean nothing.  Blank lines and, with a header, header lines are no rows.  An empty input gives two
empty tables; rows that are repeated are judged and kept one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide import schema as S
from collide.operators import validate as V
from collide.sources import commits as C
from collide.sources import io as IO

RECORD, REASONS, BAD = "record", "reasons", "bad"


def scan_permissive(spark: SparkSession, path: str, with_id: bool = True, header: bool | None = None,
                    partitions: int | None = None) -> DataFrame:
    """S1 without FAILFAST: the columns of the schema and ``record``, the text of a malformed row (else null)."""
    if header is None:
        header = IO.has_header(spark, path)
    schema = T.StructType([*IO.event_schema(with_id).fields, T.StructField(RECORD, T.StringType(), True)])
    df = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", RECORD).csv(path))
    return df.repartition(partitions) if partitions else df


def row_reasons(df: DataFrame, which: str = "validator") -> Column:
    """The sorted ``<column>:<rule>`` reasons of a row (empty array: the row is good)."""
    rules = V.rule_sql(df, which)
    if S.LABEL in df.columns:
        rules = rules + [(S.LABEL, "fractional", f"coalesce(cast({S.LABEL} as double) = floor(cast({S.LABEL} as double)), true)")]
    cells = ", ".join(f"struct('{c}:{r}' as reason, coalesce({ok}, false) as ok)" for c, r, ok in rules)
    return F.expr(f"array_sort(transform(filter(array({cells}), x -> not x.ok), x -> x.reason))")


def judged(df: DataFrame, which: str = "validator") -> DataFrame:
    """``df`` with ``reasons`` and ``bad``; a non-null ``record`` makes a row malformed."""
    for name in (REASONS, BAD):
        if name in df.columns:
            raise ValueError(f"the input has a column {name!r} of its own; rename it first")
    why = row_reasons(df, which)
    if RECORD in df.columns:
        why = F.when(F.col(RECORD).isNotNull(), F.array(F.lit("malformed"))).otherwise(why)
    return df.withColumn(REASONS, why).withColumn(BAD, F.size(REASONS) > 0)


def write_judged(spark: SparkSession, df: DataFrame, base: str, which: str = "validator") -> None:
    """Judge ``df`` and publish good and bad rows by one write under ``base``."""
    IO.commit_data(spark, judged(df, which), base, {"rules": which}, BAD)


def _committed(spark: SparkSession, base: str) -> DataFrame:
    data = IO.read_json_marker(spark, f"{base}/_meta")["data"]
    fs, p = C.fs_of(spark, f"{base}/{data}")
    if not any(s.isDirectory() for s in fs.listStatus(p)):
        raise FileNotFoundError(f"{base} holds no rows: an empty input has neither good nor bad rows")
    return spark.read.parquet(f"{base}/{data}")


def good_rows(spark: SparkSession, base: str) -> DataFrame:
    """The good rows with the types of the gate (label INT); the other folder is pruned at the scan."""
    df = _committed(spark, base).where(F.col(BAD) == F.lit("false")).drop(BAD, REASONS, RECORD)
    return df.withColumn(S.LABEL, F.col(S.LABEL).cast("int")) if S.LABEL in df.columns else df


def bad_rows(spark: SparkSession, base: str) -> DataFrame:
    """The bad rows as read, with ``reasons`` (and ``record`` where the text did not parse)."""
    return _committed(spark, base).where(F.col(BAD) == F.lit("true")).drop(BAD)  # a folder name, hence a text


def reason_counts(bad: DataFrame) -> DataFrame:
    """(reason, n_rows) over bad rows; a row counts once for each of its reasons."""
    return bad.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
