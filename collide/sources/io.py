"""Scans, sinks, versions and read-through caches.

All paths live in the cluster's shared folder (``spark.checkpoint.dir``);
existence is probed through the Hadoop FileSystem of the path, so the same
code works on HDFS, object stores and local disk.  Every versioned write
writes a data folder of its own and then publishes it by a numbered commit
record (``sources.commits``): a reader never sees a half-written version, and of
two writers at once the one with the higher number wins whole.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide import schema as S
from collide.operators import features as D
from collide.operators import prepare as P
from collide.sources import commits as C


# --------------------------------------------------------------------------- file system
def exists(spark: SparkSession, path: str) -> bool:
    fs, p = C.fs_of(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = C.fs_of(spark, path)
    if not fs.exists(p):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(p) if s.isDirectory()]


def write_json_marker(spark: SparkSession, path: str, meta: dict) -> int:
    """Publish ``meta`` as the next commit record under ``path``."""
    return C.commit(spark, path, meta)


def marker_exists(spark: SparkSession, path: str) -> bool:
    """A marker counts once its record is complete, not as soon as its folder appears."""
    return C.latest(spark, path) is not None


def commit_data(spark: SparkSession, df: DataFrame, base: str, meta: dict, partition_by: str | None = None) -> None:
    """Write ``df`` to a new folder under ``base``, then publish it: a reader sees the old
    version or the new one, never a half-written one."""
    data = f"data-{uuid.uuid4().hex[:12]}"
    w = df.write.partitionBy(partition_by) if partition_by else df.write
    w.parquet(f"{base}/{data}")
    write_json_marker(spark, f"{base}/_meta", {**meta, "data": data})


def committed_data(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{read_json_marker(spark, f'{base}/_meta')['data']}")


def read_json_marker(spark: SparkSession, path: str) -> dict:
    meta = C.latest(spark, path)
    if meta is None:
        raise FileNotFoundError(f"no commit record under {path}")
    return meta


def collect_orphans(spark: SparkSession, base: str, older_than_s: float = 86_400.0) -> list[str]:
    """Delete data folders of a version that no commit record names (see ``commits.collect_orphans``)."""
    return C.collect_orphans(spark, base, [f"{base}/_meta"], older_than_s)


# --------------------------------------------------------------------------- S1-S3 CSV scans
def event_schema(with_id: bool = True, feature_set: str = "all") -> T.StructType:
    fields = [T.StructField(S.EVENT_ID, T.LongType(), False)] if with_id else []
    fields += [T.StructField(S.LABEL, T.DoubleType(), False)]  # files may write the label as a float
    fields += [T.StructField(c, T.FloatType(), True) for c in S.FEATURE_SETS[feature_set]]
    return T.StructType(fields)


def has_header(spark: SparkSession, path: str) -> bool:
    """A header is present when the first line starts with ``label`` (or the id column)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return False
    line = first[0]["value"].lstrip()
    return line.startswith(S.LABEL) or line.startswith(S.EVENT_ID)


def read_events_csv(spark: SparkSession, path: str, with_id: bool = True, feature_set: str = "all",
                    header: bool | None = None, partitions: int | None = None) -> DataFrame:
    """CSV (plain or .gz) with an explicit schema and FAILFAST; names imposed without header.

    The label is read as a number and cast; a fractional label fails the read.  Without an id
    column (``with_id=False``) every row gets a stable ``event_id`` from its content and, among
    rows with one content (which are interchangeable), a counter -- independent of partitioning.
    Gzip is not splittable: pass ``partitions`` to spread the rows right after the scan.
    """
    if header is None:
        header = has_header(spark, path)
    df = (spark.read.schema(event_schema(with_id)).option("header", header).option("mode", "FAILFAST")
          .csv(path))
    if partitions:
        df = df.repartition(partitions)
    label = F.when(F.col(S.LABEL) == F.floor(S.LABEL), F.col(S.LABEL).cast("int")).when(
        F.col(S.LABEL).isNotNull(), F.raise_error(F.concat(F.lit("label is no integer: "), F.col(S.LABEL).cast("string"))).cast("int"))
    if not with_id:
        whole = F.xxhash64(*[F.col(c) for c in df.columns])
        same = Window.partitionBy("__content").orderBy("__content")
        df = (df.withColumn("__content", whole).withColumn("__copy", F.row_number().over(same))
              .withColumn(S.EVENT_ID, F.xxhash64("__content", "__copy")))
    return df.withColumn(S.LABEL, label).select(S.EVENT_ID, *S.feature_set(feature_set))


def write_events_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = df.write.mode("overwrite").option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def first_n(df: DataFrame, n: int, key: str = S.EVENT_ID) -> DataFrame:
    """S3: reproducible first-N rows: ``orderBy(key).limit(n)`` (a distributed top-k)."""
    return df.orderBy(key).limit(n)


# --------------------------------------------------------------------------- S4 cache
def cache_key(**params) -> str:
    """sha256 over *every* read parameter (the dtype included), first 12 hex digits."""
    text = json.dumps({k: str(v) for k, v in params.items()}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def cached_read(spark: SparkSession, cache_dir: str, build, **params) -> tuple[DataFrame, bool]:
    """Read-through cache.  Hit -> read the Parquet under the key; miss -> build, write, read.

    Returns (frame, hit)."""
    key = cache_key(**params)
    path = f"{cache_dir.rstrip('/')}/{key}"
    marker = f"{path}/_meta"
    if marker_exists(spark, marker):
        return committed_data(spark, path), True
    commit_data(spark, build(), path, {"key": key, **{k: str(v) for k, v in params.items()}})
    return committed_data(spark, path), False


# --------------------------------------------------------------------------- S5/S6 split store
def write_splits(spark: SparkSession, df: DataFrame, root: str, version: str,
                 scaler: P.ScalerModel | None = None, meta: dict | None = None) -> str:
    """``<root>/<version>/data-.../split=...`` + metadata (scaler included, Q11) + ``latest`` pointer."""
    base = f"{root.rstrip('/')}/{version}"
    m = {"version": version, "created_at": time.time(), **(meta or {})}
    if scaler is not None:
        m["scaler"] = scaler.to_json()
    commit_data(spark, df, base, m, "split")
    write_json_marker(spark, f"{root.rstrip('/')}/latest", {"version": version})
    return base


def version_exists(spark: SparkSession, root: str, version: str) -> bool:
    """A version exists only once its metadata marker is written."""
    return marker_exists(spark, f"{root.rstrip('/')}/{version}/_meta")


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The version that was written last."""
    path = f"{root.rstrip('/')}/latest"
    return read_json_marker(spark, path)["version"] if marker_exists(spark, path) else None


def read_split(spark: SparkSession, root: str, version: str | None = None, split: str | None = None) -> DataFrame:
    """Reload a version (default: the latest); a ``split`` filter prunes partitions at the scan."""
    version = version or latest_version(spark, root)
    if version is None or not version_exists(spark, root, version):
        raise FileNotFoundError(f"version {version} not found under {root}")
    df = committed_data(spark, f"{root.rstrip('/')}/{version}")
    return df if split is None else df.filter(F.col("split") == split)


def load_scaler(spark: SparkSession, root: str, version: str) -> P.ScalerModel | None:
    meta = read_json_marker(spark, f"{root.rstrip('/')}/{version}/_meta")
    return P.ScalerModel.from_json(meta["scaler"]) if "scaler" in meta else None


# --------------------------------------------------------------------------- S7 feature store
def feature_version(etl_version: str, cfg: dict) -> str:
    """sha256(etl_version, config)[:12]."""
    text = json.dumps({"etl_version": etl_version, **{k: str(v) for k, v in cfg.items()}}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def build_feature_store(spark: SparkSession, splits: DataFrame, root: str, etl_version: str,
                        fill_strategy: str = "median", **switches) -> str:
    """Derive -> fill per split -> order columns -> one partitioned write; metadata last."""
    cfg = {"fill": fill_strategy, **switches}
    version = feature_version(etl_version, cfg)
    fm = D.feature_matrix(splits, fill_strategy, **switches)
    base = f"{root.rstrip('/')}/{version}"
    commit_data(spark, fm, base, {"version": version, "etl_version": etl_version, "created_at": time.time(),
                                  "columns": fm.columns, **cfg}, "split")
    return version


def newest_version(spark: SparkSession, root: str) -> str | None:
    """Newest built version by its stored ``created_at`` (not by file times, Q15)."""
    markers = [f"{d}/_meta" for d in list_dirs(spark, root) if marker_exists(spark, f"{d}/_meta")]
    if not markers:
        return None
    m = F.from_json("value", "version string, created_at double")  # all records in one scan
    top = spark.read.text(markers).select(F.max_by(m["version"], m["created_at"]).alias("v")).first()
    return top["v"]


def load_features(spark: SparkSession, root: str, split: str, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(X, y) of one split; a missing version raises; default = newest."""
    version = version or newest_version(spark, root)
    if version is None or not version_exists(spark, root, version):
        raise FileNotFoundError(f"feature store version {version!r} not found under {root}")
    df = committed_data(spark, f"{root.rstrip('/')}/{version}").filter(F.col("split") == split)
    return df.drop(S.LABEL), df.select(S.EVENT_ID, S.LABEL)


# --------------------------------------------------------------------------- S9/S10 ragged
def read_ragged(spark: SparkSession, path: str, branches: list[str] | None = None,
                max_events: int | None = None) -> DataFrame:
    """Ragged Parquet; branch choice is a projection pruned into the scan; optional first-N events."""
    df = spark.read.parquet(path)
    if branches:
        df = df.select(S.EVENT_ID, *branches)
    return first_n(df, max_events) if max_events else df
