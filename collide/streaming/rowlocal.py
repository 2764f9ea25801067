"""Row-local operators on a streaming source.

The derived features (D1-D7), cuts (F1-F3, F6, F7) and kinematics are pure
projections and filters, so the same functions apply unchanged to a
streaming DataFrame.  ``derive_and_cut`` is that shared plan; the smoke
job runs it over a Parquet file source with ``trigger(availableNow=True)``
into a Parquet sink whose checkpoint lives in the shared folder (so a lost
executor or a restarted driver resumes exactly once).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide import schema as S
from collide.operators import cuts as C
from collide.operators import features as D
from collide.session import fresh_dir


def derive_and_cut(df: DataFrame) -> DataFrame:
    """Derived features + ETL cuts + jet counting: valid on batch and streaming frames."""
    d = D.derived(df)
    d = C.apply_cuts(d, C.quality_cuts(d, lepton_pt_min=20.0, met_min=10.0))
    return d.select("event_id", "label", *S.DERIVED, C.n_jets_above().alias("n_jets_30"),
                    C.has_b_tag().alias("has_b_tag"))


#: Rows of one file of a file source; its batches are as many as asked for, whatever the number of files.
ROWS_PER_FILE = 250_000


def file_source(spark: SparkSession, events: DataFrame, path: str, batches: int = 4, rows: int = ROWS_PER_FILE) -> DataFrame:
    """The events as a stream of Parquet files in about ``batches`` micro-batches.

    Files hold about ``rows`` rows, so none grows with the events and a batch is worked on by as many tasks as it has files."""
    each = max(1, math.ceil(events.count() / (rows * batches)))  # files of a batch
    events.repartition(each * batches).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", each).parquet(path)


def stream_rowlocal(spark: SparkSession, events: DataFrame, files: int = 4) -> DataFrame:
    """Write the events as a file source, stream them through ``derive_and_cut`` with
    availableNow in about ``files`` batches, and return the sink's rows (same rows as the batch plan)."""
    src = fresh_dir(spark, "stream-src")
    sink = fresh_dir(spark, "stream-sink")
    ckpt = fresh_dir(spark, "stream-ckpt")
    stream = file_source(spark, events, src, files)
    q = (derive_and_cut(stream).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink).select(*[F.col(c) for c in derive_and_cut(events).columns])
