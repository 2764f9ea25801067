"""Streaming store: micro-batches published once, each behind the validation rules.

Structured Streaming gives a batch again under its old id when the driver died between the batch's work and
its checkpoint.  ``foreachBatch`` here writes the batch into a folder of its own and publishes it by
the commit record *of the batch id*; a batch whose record is complete already changes nothing.  So a stream that is
killed anywhere and started again leaves the rows of one undisturbed run:

* killed before the record: the folder is named by no record (``IO.collect_orphans`` deletes it), the replay writes anew;
* killed inside the record: the record does not parse, counts as absent and is replaced;
* killed after the record: the replay finds it and skips the batch.

The gate works row by row (``sources.quarantine``) and on the batch: with ``max_bad_share`` a batch that holds a larger
share of bad rows is published as refused, whole; its rows are kept for inspection but are in no result.
A batch without rows publishes a record without data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from collide.sources import commits as C
from collide.sources import quarantine as Q


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def store_batch(batch: DataFrame, batch_id: int, root: str, which: str = "validator", max_bad_share: float | None = None) -> bool:
    """Write one micro-batch and publish it under its id; False if that id is published already."""
    spark, root = batch.sparkSession, root.rstrip("/")
    if C.read_number(spark, _log(root), batch_id) is not None:
        return False
    data = f"data-{uuid.uuid4().hex[:12]}"
    Q.judged(batch, which).write.parquet(f"{root}/{data}")
    n, bad = spark.read.parquet(f"{root}/{data}").agg(F.count(F.lit(1)), F.count_if(Q.BAD)).first()
    refused = max_bad_share is not None and bad > max_bad_share * n
    C.commit_as(spark, _log(root), batch_id, {"batch": batch_id, "data": data if n else None, "n_rows": n, "n_bad": bad,
                                              "refused": refused})
    return True


def start(stream: DataFrame, root: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
          which: str = "validator", max_bad_share: float | None = None, **trigger) -> StreamingQuery:
    """Start the stream into the store (``trigger`` as in ``DataStreamWriter.trigger``; default ``availableNow``).

    ``transform`` is applied to the streaming frame, before the rules; ``checkpoint`` must be kept
    together with ``root``: it says which batch ids are done.
    """
    frame = transform(stream) if transform else stream
    writer = frame.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.foreachBatch(lambda batch, i: store_batch(batch, i, root, which, max_bad_share)).start()


def batches(spark: SparkSession, root: str) -> list[dict]:
    """The published records, one per batch, in the order of their ids."""
    return C.history(spark, _log(root))


def _rows(spark: SparkSession, root: str, refused: bool) -> DataFrame:
    found = [r for r in batches(spark, root) if r["data"]]
    if not found:
        raise FileNotFoundError(f"no rows published under {root}")
    chosen = [f"{root.rstrip('/')}/{r['data']}" for r in found if r["refused"] == refused]
    if chosen:
        return spark.read.parquet(*chosen)
    return spark.read.parquet(f"{root.rstrip('/')}/{found[0]['data']}").limit(0)


def good(spark: SparkSession, root: str) -> DataFrame:
    """The good rows of all accepted batches."""
    return _rows(spark, root, False).where(~F.col(Q.BAD)).drop(Q.BAD, Q.REASONS, Q.RECORD)


def bad(spark: SparkSession, root: str) -> DataFrame:
    """The bad rows of all accepted batches with their reasons."""
    return _rows(spark, root, False).where(F.col(Q.BAD)).drop(Q.BAD)


def refused(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the refused batches, good ones included, with their reasons."""
    return _rows(spark, root, True)
