"""Numbered commit records: how concurrent writers publish data folders.

A version is a folder.  A writer first writes its data into a folder of its
own, then publishes it by creating the next numbered record ``<n>.json``.  A number
can be created once only (``create`` without overwriting; on a local disk an
exclusive file creation), so of two writers the later one takes the next number.
Readers take the record with the highest number that is complete: they see one
writer's data or the other's, never a mixture, and a writer that dies leaves a
folder that nobody refers to (``collect_orphans``).
"""

from __future__ import annotations

import json
import re
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_NAME = re.compile(r"\d{20}\.json$")


def fs_of(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, log: str) -> list[str]:
    fs, p = fs_of(spark, log)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if _NAME.match(n))


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create the record unless it is there; False if another writer has it."""
    fs, p = fs_of(spark, path)
    if fs.getUri().getScheme() == "file":
        if not spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile():
            return False
        out = fs.create(p, True)
    else:
        try:
            out = fs.create(p, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def commit(spark: SparkSession, log: str, record: dict) -> int:
    """Publish ``record`` under the next free number."""
    fs, p = fs_of(spark, log)
    fs.mkdirs(p)
    names = _names(spark, log)
    n = int(names[-1][:20]) + 1 if names else 0
    text = json.dumps(record, sort_keys=True, default=str) + "\n"
    while not _create(spark, f"{log}/{n:020d}.json", text):
        n += 1
    return n


def _read(spark: SparkSession, path: str) -> dict | None:
    fs, p = fs_of(spark, path)
    stream = fs.open(p)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    try:
        return json.loads(text)
    except ValueError:  # its writer is still at it, or died
        return None


def read_number(spark: SparkSession, log: str, n: int) -> dict | None:
    """The complete record of that number, if there is one."""
    path = f"{log}/{n:020d}.json"
    fs, p = fs_of(spark, path)
    return _read(spark, path) if fs.exists(p) else None


def commit_as(spark: SparkSession, log: str, n: int, record: dict) -> bool:
    """Publish ``record`` under the number ``n`` itself; False if a complete record has it.

    For numbers that one writer at a time hands out (the batches of a stream): a record that does not parse is
    what that writer left when it died, and is replaced.
    """
    fs, p = fs_of(spark, log)
    fs.mkdirs(p)
    path, text = f"{log}/{n:020d}.json", json.dumps(record, sort_keys=True, default=str) + "\n"
    if _create(spark, path, text):
        return True
    if _read(spark, path) is not None:
        return False
    out = fs.create(fs_of(spark, path)[1], True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def latest(spark: SparkSession, log: str) -> dict | None:
    """The complete record with the highest number."""
    for name in reversed(_names(spark, log)):
        record = _read(spark, f"{log}/{name}")
        if record is not None:
            return record
    return None


def history(spark: SparkSession, log: str) -> list[dict]:
    """All complete records, oldest first."""
    found = [_read(spark, f"{log}/{name}") for name in _names(spark, log)]
    return [r for r in found if r is not None]


def collect_orphans(spark: SparkSession, base: str, logs: list[str], older_than_s: float = 86_400.0) -> list[str]:
    """Delete the ``data-*`` folders under ``base`` that no record of ``logs`` names and that are older than
    the given age (writers that are still at work keep theirs); returns their names."""
    named = {r.get("data") for log in logs for r in history(spark, log)}
    fs, p = fs_of(spark, base)
    gone = []
    if not fs.exists(p):
        return gone
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith("data-") and name not in named \
                and s.getModificationTime() / 1000.0 <= time.time() - older_than_s:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return sorted(gone)
