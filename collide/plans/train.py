"""Training flow (X3 / L6): ETL -> feature store -> GBT -> exact val/test AUC -> registry with promotion.

The model is trained on every column of the feature store: those of the dataset and the derived
ones.  Returns a result row instead of a bare float (Q10)."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide import schema as S
from collide.operators import learn as L
from collide.operators import registry as R
from collide.plans import etl as X
from collide.session import fresh_dir
from collide.sources import io as IO
from collide.sources import tables as TB


def train_and_register(spark: SparkSession, events: DataFrame, registry_path: str, model_name: str = "bdt",
                       cfg: X.ETLConfig = X.ETLConfig(), store_path: str | None = None, metrics_path: str | None = None,
                       model_path: str | None = None, **gbt_params) -> DataFrame:
    """ETL (gate, cuts, split, scale) -> feature store -> GBT fit with validation -> exact AUCs -> register the
    run with its metrics and tags -> promote.  ``metrics_path`` also logs the summary, ``model_path`` stores the model
    with its settings."""
    etl_version = cfg.config_hash()
    root = store_path or fresh_dir(spark, "features")
    version = IO.build_feature_store(spark, X.etl(events, cfg), root, etl_version)
    data = IO.committed_data(spark, f"{root.rstrip('/')}/{version}")
    feats = [c for c in S.FEATURES + S.DERIVED if c in data.columns]
    began = time.time()
    model = L.fit_gbt(data, feats, **gbt_params)
    fit_time = time.time() - began
    val_auc = L.exact_auc(L.score(model, data.where(F.col("split") == "val")))
    test_auc = L.exact_auc(L.score(model, data.where(F.col("split") == "test")))
    run_id = uuid.uuid4().hex
    metrics = {"val_auc": val_auc, "test_auc": test_auc, "fit_time_s": fit_time}
    tags = {"model_type": model_name, "dataset": cfg.dataset_name, "etl_version": etl_version, "n_features": len(feats),
            "feature_store_version": version}
    if metrics_path:
        TB.log_metrics(spark, metrics_path, run_id, metrics)
    if model_path:
        TB.save_model(spark, model, model_path, {**gbt_params, "features": feats}, {"run_id": run_id, "best_val_auc": val_auc})
    promoted = TB.register_run(spark, registry_path, model_name, run_id, metrics, tags, promote=True)
    prod = R.production_run(TB.read_runs(spark, registry_path).where(F.col("model_name") == model_name)).first()
    out = [(model_name, run_id, float(val_auc), float(test_auc), int(model.stages[-1].getNumTrees), len(feats),
            bool(promoted), prod["production_run_id"], etl_version)]
    return spark.createDataFrame(out, "model_name string, run_id string, val_auc double, test_auc double, "
                                      "n_trees int, n_features int, promoted boolean, production_run_id string, "
                                      "etl_version string")
