"""File sources: files of bounded size, the same number of batches, every row once."""

import os

from pyspark.sql import functions as F

from collide.session import fresh_dir
from collide.streaming.rowlocal import file_source


def test_files_grow_with_the_rows_and_batches_do_not(spark):
    events = spark.range(1000).withColumnRenamed("id", "event_id")
    src, ckpt, sink = (fresh_dir(spark, n) for n in ("fs-src", "fs-ckpt", "fs-sink"))
    stream = file_source(spark, events, src, batches=4, rows=25)
    files = [f for f in os.listdir(src.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == 40
    assert spark.read.parquet(src).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 50
    q = (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(os.listdir(f"{ckpt.removeprefix('file:')}/commits")) <= 2 * 4
    assert sorted(r[0] for r in spark.read.parquet(sink).collect()) == list(range(1000))
