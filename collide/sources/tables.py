"""Append tables published by commit records: runs (S12), metric steps (S13), scores, models.

Every append is one data folder and one record, so appends of concurrent writers never meet in a file and a
reader sees whole appends only.
"""

from __future__ import annotations

import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide.operators import metrics as M
from collide.operators import registry as R
from collide.sources import commits as C

RUNS = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("registered_at", T.TimestampType()), T.StructField("val_auc", T.DoubleType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()))])


def append(spark: SparkSession, df: DataFrame, root: str, **about) -> int:
    """Write ``df`` as one append and publish it; returns its number."""
    data = f"data-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{root}/{data}")
    return C.commit(spark, f"{root}/_commits", {"data": data, "created_at": time.time(), **about})


def read(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """All published appends (an empty frame of ``schema`` if there is none)."""
    paths = [f"{root}/{r['data']}" for r in C.history(spark, f"{root}/_commits")]
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"nothing published under {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


# --------------------------------------------------------------------------- S12 / R3 runs
def register_runs(spark: SparkSession, runs: DataFrame, root: str) -> int:
    """Append runs (model_name, run_id, registered_at, metrics map, optional tags map) as one batch;
    val_auc is the metric of that name, 0.0 where it is absent."""
    def has(c):
        return c in runs.columns
    metrics = F.col("metrics") if has("metrics") else F.create_map().cast("map<string,double>")
    auc = F.try_element_at(metrics, F.lit("val_auc"))
    auc = F.coalesce(F.col("val_auc"), auc, F.lit(0.0)) if has("val_auc") else F.coalesce(auc, F.lit(0.0))
    tags = F.col("tags") if has("tags") else F.create_map().cast("map<string,string>")
    rows = runs.select("model_name", F.col("run_id").cast("string").alias("run_id"), "registered_at", auc.alias("val_auc"),
                       metrics.alias("metrics"), tags.alias("tags"))
    return append(spark, rows, root)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, RUNS)


def register_run(spark: SparkSession, root: str, model_name: str, run_id: str, metrics: dict[str, float],
                 tags: dict[str, str] | None = None, promote: bool = False, delta: float = R.PROMOTION_AUC_DELTA) -> bool:
    """Register one run, registered now; with ``promote`` tells whether it is in production afterwards."""
    one = spark.createDataFrame(
        [(model_name, run_id, {k: float(v) for k, v in metrics.items()}, {k: str(v) for k, v in (tags or {}).items()})],
        "model_name string, run_id string, metrics map<string,double>, tags map<string,string>")
    register_runs(spark, one.withColumn("registered_at", F.current_timestamp()), root)
    if not promote:
        return False
    own = read_runs(spark, root).where(F.col("model_name") == model_name)
    return R.production_run(own, delta).first()["production_run_id"] == run_id


# --------------------------------------------------------------------------- S13 metrics by step
STEPS = "run_id string, metric string, step long, value double"


def log_history(spark: SparkSession, hist: DataFrame, metrics, root: str, key: str = "run_id") -> int:
    """Append metric histories (arrays per run) as steps 1, 2, ...; NaN and null steps are left out."""
    long = R.history_long(hist, metrics, key).select(F.col(key).cast("string").alias("run_id"), "metric",
                                                     F.col("step").cast("long").alias("step"), "value")
    return append(spark, long, root)


def log_metrics(spark: SparkSession, root: str, run_id: str, metrics: dict[str, float], step: int | None = None) -> int:
    """Append single values of one run at a step (null: a summary value)."""
    rows = [(run_id, k, step, float(v)) for k, v in metrics.items()]
    return append(spark, spark.createDataFrame(rows, STEPS), root)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, metric, step, value): of values logged more than once for a step, all."""
    return read(spark, root, T._parse_datatype_string(STEPS))


# --------------------------------------------------------------------------- scores of models
def append_scores(spark: SparkSession, scored: DataFrame, root: str, label: str = "label", score: str = "score",
                  group_cols=("model",)) -> int:
    """Append scored rows as counts per (model, score): the mergeable state of all metrics."""
    return append(spark, M.score_state(M.prepared(scored, label, score, group_cols), group_cols), root)


def read_scores(spark: SparkSession, root: str, group_cols=("model",)) -> DataFrame:
    """The appended counts, merged."""
    return M.merged_states(read(spark, root), group_cols=group_cols)


# --------------------------------------------------------------------------- S14 models
def save_model(spark: SparkSession, model: PipelineModel | None, root: str, config: dict, metadata: dict) -> int:
    """Store a fitted model with its settings and metadata; an unfitted one (None) raises."""
    if model is None:
        raise RuntimeError("the model has not been fitted")
    data = f"data-{uuid.uuid4().hex[:12]}"
    model.write().save(f"{root}/{data}")
    return C.commit(spark, f"{root}/_commits", {"data": data, "created_at": time.time(), "config": config, "metadata": metadata})


def load_model(spark: SparkSession, root: str) -> tuple[PipelineModel, dict, dict]:
    """The model stored last, its settings and its metadata."""
    record = C.latest(spark, f"{root}/_commits")
    if record is None:
        raise FileNotFoundError(f"no model under {root}")
    return PipelineModel.load(f"{root}/{record['data']}"), record["config"], record["metadata"]
