"""Queries for the run registry and metric history."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide.catalog import query
from collide.operators import registry as R
from collide.session import fresh_dir
from collide.sources import tables as TB

RUNS = ["runs"]


def _runs(spark, sf):
    return FX.runs(spark, sf)


_ORDERED = "r as (select model_name, run_id, registered_at, val_auc, row_number() over (partition by model_name order by registered_at, run_id) as k from runs)"
_FOLD = f""", {_ORDERED},
f(model_name, k, prod_run, prod_auc, n) as (
  select model_name, k, run_id, val_auc, 1 from r where k = 1
  union all
  select r.model_name, r.k,
         case when r.val_auc - f.prod_auc >= 0.005e0 then r.run_id else f.prod_run end,
         case when r.val_auc - f.prod_auc >= 0.005e0 then r.val_auc else f.prod_auc end,
         f.n + case when r.val_auc - f.prod_auc >= 0.005e0 then 1 else 0 end
  from f join r on r.model_name = f.model_name and r.k = f.k + 1),
last as (select f.* from f join (select model_name, max(k) as mk from r group by model_name) m
         on f.model_name = m.model_name and f.k = m.mk)
"""


def _recursive(sql: str) -> str:
    return "with recursive " + sql[len("with "):]


@query("best_run", FX.oracle(RUNS, """
select model_name, run_id, val_auc as best_val_auc, registered_at from (
  select *, row_number() over (partition by model_name order by val_auc desc, registered_at, run_id) as k from runs) t
where k = 1"""))
def best_run(spark, sf):
    """Highest val_auc per model; the earliest registration wins ties."""
    return R.best_run(_runs(spark, sf))


@query("promotion_fold", _recursive(FX.oracle(RUNS, _FOLD + """
select model_name, prod_run as production_run_id, prod_auc as production_val_auc, cast(n as int) as n_promotions from last""")))
def promotion_fold(spark, sf):
    """Sequential promotion fold (margin 0.005) in registration order, per model."""
    return R.promotion_fold(_runs(spark, sf))


@query("production_run", _recursive(FX.oracle(RUNS, _FOLD + """
select model_name, prod_run as production_run_id, prod_auc as production_val_auc from last""")))
def production_run(spark, sf):
    """Current production entry per model."""
    return R.production_run(_runs(spark, sf))


@query("leaderboard", _recursive(FX.oracle(RUNS, _FOLD + """,
b as (select model_name, run_id, val_auc as best_val_auc, registered_at from (
  select *, row_number() over (partition by model_name order by val_auc desc, registered_at, run_id) as k from runs) t where k = 1)
select b.model_name, b.best_val_auc, b.run_id, b.registered_at, coalesce(l.prod_run = b.run_id, false) as is_production
from b left join last l on b.model_name = l.model_name""")))
def leaderboard(spark, sf):
    """R2: best run per model with is_production, sorted by best val_auc."""
    return R.leaderboard(_runs(spark, sf))


_HIST_STEPS = ("h as (select run_id, val_auc, train_loss, "
               "row_number() over (partition by run_id order by ts, event_id) as step from history_flat)")


@query("history_long", FX.oracle(["history_flat"], f""", {_HIST_STEPS}
select run_id, 'val_auc' as metric, step, val_auc as value from h where not isnan(val_auc)
union all select run_id, 'train_loss', step, train_loss from h where not isnan(train_loss)"""))
def history_long(spark, sf):
    """Metric history to long rows; step = index + 1; NaN epochs skipped."""
    d = R.history_long(FX.history(spark, sf), ["val_auc", "train_loss"])
    return d.select("run_id", "metric", F.col("step").cast("bigint").alias("step"), "value")


@query("best_epoch", FX.oracle(["history_flat"], f""", {_HIST_STEPS}
select run_id, cast(step as int) as best_epoch, val_auc as best_val_auc from (
  select *, row_number() over (partition by run_id order by val_auc desc, step) as k from h) t where k = 1"""))
def best_epoch(spark, sf):
    """First arg-max of val_auc (1-based) and its value."""
    return R.best_epoch(FX.history(spark, sf))


@query("run_summary", FX.oracle(["history_flat"], f""", {_HIST_STEPS},
b as (select run_id, step as best_epoch, val_auc as best_val_auc from (
  select *, row_number() over (partition by run_id order by val_auc desc, step) as k from h) t where k = 1),
ft as (select run_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as fit_time_s, count(*) as n from history_flat group by run_id)
select b.run_id, b.best_val_auc, cast(b.best_epoch as double) as best_epoch, ft.fit_time_s, cast(ft.n as double) as n_epochs_run
from b join ft on b.run_id = ft.run_id"""))
def run_summary(spark, sf):
    """Summary with defaults, the fit time given as an extra that overrides the default 0."""
    flat = FX.view(spark, sf, "history_flat")
    ft = flat.groupBy("run_id").agg(((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6).alias("fit_s"))
    h = FX.history(spark, sf).join(ft, "run_id")
    return R.run_summary(h, {"fit_time_s": F.col("fit_s")})


@query("params_log", FX.oracle([], """
select doc_id, param, substr(value, 1, 499) as value from (
  select doc_id, 'text' as param, text as value from documents
  union all select doc_id, 'lang', lang from documents
  union all select doc_id, 'source', source from documents
  union all select doc_id, 'n_chars', cast(n_chars as varchar) from documents) t"""))
def params_log(spark, sf):
    """Params stringified and cut at 499 characters, one row per (run, param); whole texts read."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return R.params_long(docs, "doc_id", {"text": F.col("text"), "lang": F.col("lang"),
                                          "source": F.col("source"), "n_chars": F.col("n_chars")})


@query("config_fingerprint", FX.oracle(RUNS, """
select run_id, substr(sha256(coalesce(length(m) || ':' || m, '-1:') || coalesce(length(r) || ':' || r, '-1:')
       || coalesce(length(a) || ':' || a, '-1:')), 1, 12) as fingerprint
from (select run_id, model_name as m, cast(run_id as varchar) as r,
             cast(cast(round(val_auc * 1e6) as bigint) as varchar) as a from runs)"""))
def config_fingerprint(spark, sf):
    """Content hash of each run's config fields (sha256, first 12 hex digits)."""
    r = _runs(spark, sf)
    return r.select("run_id", R.config_fingerprint(F.col("model_name"), F.col("run_id"),
                                                   F.round(F.col("val_auc") * 1e6).cast("bigint")).alias("fingerprint"))


@query("registry_append", FX.oracle(RUNS, """
select model_name, count(*) as n_runs, max(coalesce(val_auc, 0e0)) as best_val_auc from runs group by model_name"""))
def registry_append(spark, sf):
    """Runs registered in two batches, each one published append (val_auc defaulting to 0.0),
    then read back: runs and best val_auc per model."""
    root = fresh_dir(spark, "registry")
    r = _runs(spark, sf)
    cut = F.col("registered_at") < F.lit("2024-01-15").cast("timestamp")
    TB.register_runs(spark, r.filter(cut), root)
    TB.register_runs(spark, r.filter(~cut), root)
    return TB.read_runs(spark, root).groupBy("model_name").agg(F.count(F.lit(1)).alias("n_runs"),
                                                               F.max("val_auc").alias("best_val_auc"))


@query("metrics_by_step", FX.oracle(["history_flat"], f""", {_HIST_STEPS}
select cast(run_id as varchar) as run_id, 'val_auc' as metric, step, val_auc as value from h where not isnan(val_auc)
union all select cast(run_id as varchar), 'train_loss', step, train_loss from h where not isnan(train_loss)"""))
def metrics_by_step(spark, sf):
    """Metric histories logged by step into the metrics table, one append per metric, and read back."""
    root = fresh_dir(spark, "metrics")
    hist = FX.history(spark, sf)
    for m in ("val_auc", "train_loss"):
        TB.log_history(spark, hist, [m], root)
    return TB.read_metrics(spark, root)


@query("promotion_chain", _recursive(FX.oracle(RUNS, _FOLD + """
select model_name, prod_run as production_run_id, prod_auc as production_val_auc, cast(n as int) as n_promotions from last""")))
def promotion_chain(spark, sf):
    """R4 by pointers, as it runs for models with any number of runs."""
    return R.promotion_chain(_runs(spark, sf))


@query("score_store", FX.oracle(["scored", "scored2"], """, s as (
  select 'a' as model, cast(cast(score as float) as double) as s, label as y from scored
  union all select 'b', cast(cast(score as float) as double), label from scored2)
select model, s, cast(sum(y) as bigint) as pos, cast(count(*) - sum(y) as bigint) as neg from s group by model, s"""))
def score_store(spark, sf):
    """Scores of two models appended in three batches as mergeable counts, read back merged."""
    root = fresh_dir(spark, "scores")
    a = FX.scored(spark, sf, "scored").withColumn("model", F.lit("a"))
    b = FX.scored(spark, sf, "scored2").withColumn("model", F.lit("b"))
    for part in (a.where("event_id % 3 = 0"), a.where("event_id % 3 <> 0"), b):
        TB.append_scores(spark, part, root)
    return TB.read_scores(spark, root)
