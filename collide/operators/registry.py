"""Run registry and metric history.

Runs are rows of a ``runs`` table (model_name, run_id, registered_at,
val_auc, ...); registration order is (registered_at, run_id).  Best runs
and leaderboards are ordinary aggregates.  Promotion is a sequential fold
in registration order: per model an ``aggregate`` over its strict maxima, or, where a
model has very many runs, pointer jumping over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collide.session import fresh_dir

PROMOTION_AUC_DELTA = 0.005
#: Runs of one model that may be folded in one row.
MOST_RUNS = 100_000


def _auc(c: str = "val_auc") -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))  # missing val_auc counts as 0


def best_run(runs: DataFrame) -> DataFrame:
    """Per model the run with the highest val_auc; the earliest registration wins ties."""
    key = F.struct((-_auc()).alias("a"), F.col("registered_at").alias("t"), F.col("run_id").alias("r"))
    best = runs.groupBy("model_name").agg(
        F.min_by(F.struct("run_id", _auc().alias("val_auc"), "registered_at"), key).alias("b"))
    return best.select("model_name", F.col("b.run_id").alias("run_id"), F.col("b.val_auc").alias("best_val_auc"),
                       F.col("b.registered_at").alias("registered_at"))


def promotion_fold(runs: DataFrame, delta: float = PROMOTION_AUC_DELTA, most: int = MOST_RUNS) -> DataFrame:
    """In registration order the first run is promoted; a later run is promoted when
    val_auc - production_auc >= delta.  Per model: final production run, its val_auc and
    the number of promotions.

    Models of at most ``most`` runs each are folded in the row (one small job checks that); a table with a
    larger one goes by ``promotion_chain``, which holds no model's runs in one task or array."""
    # the margin is positive, so only a run above every earlier one can be promoted; the running
    # maximum streams over sorted rows, and the fold sees these strict maxima alone
    if delta <= 0:
        raise ValueError("the promotion margin must be positive")
    largest = runs.groupBy("model_name").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    if (largest or 0) > most:
        return promotion_chain(runs, delta)
    earlier = Window.partitionBy("model_name").orderBy("registered_at", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__top", F.max(_auc()).over(earlier)).where(F.col("__top").isNull() | (_auc() > F.col("__top")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("registered_at").alias("t"), F.col("run_id").alias("r"),
                                                   _auc().alias("a"))))
    init = F.struct(F.lit(None).cast(runs.schema["run_id"].dataType).alias("run_id"),
                    F.lit(None).cast("double").alias("auc"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        promote = acc["auc"].isNull() | (x["a"] - acc["auc"] >= F.lit(delta))
        return F.when(promote, F.struct(x["r"].alias("run_id"), x["a"].alias("auc"), (acc["n"] + 1).alias("n"))) \
            .otherwise(acc)
    folded = runs.groupBy("model_name").agg(F.aggregate(ordered, init, step).alias("p"))
    return folded.select("model_name", F.col("p.run_id").alias("production_run_id"),
                         F.col("p.auc").alias("production_val_auc"), F.col("p.n").alias("n_promotions"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def strict_maxima(runs: DataFrame) -> DataFrame:
    """(m, a, r): runs above every earlier run of their model, of which any number may be one model's.  Runs are cut
    into ranges of registration order; each range knows the maximum of the ranges before it."""
    ranged = (runs.select(F.struct("model_name").alias("m"), F.col("registered_at").alias("t"), F.col("run_id").alias("r"),
                          _auc().alias("a"))
              .repartitionByRange("m", "t", "r").withColumn("chunk", F.spark_partition_id()))
    ranged = _stored(ranged, "runs-ranged")
    chunks = Window.partitionBy("m").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = (ranged.groupBy("m", "chunk").agg(F.max("a").alias("top")).withColumn("before", F.max("top").over(chunks))
              .select("m", "chunk", "before"))
    inside = Window.partitionBy("m", "chunk").orderBy("t", "r").rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.join(before, ["m", "chunk"]).withColumn("top", F.greatest(F.max("a").over(inside), F.col("before")))
    return _stored(rows.where(F.col("top").isNull() | (F.col("a") > F.col("top"))).select("m", "a", "r"), "runs-maxima")


def next_promotions(maxima: DataFrame, delta: float) -> DataFrame:
    """(m, a, b): of every strict maximum a the next run that would be promoted after it: the least
    maximum b with b - a >= delta.  Maxima rise in registration order, so this is a search by value: in the three
    half-margin cells after that of a, else the least value of the first cell beyond them."""
    cell = F.floor(F.col("a") / F.lit(delta / 2)).cast("long")
    tops = maxima.select("m", cell.alias("c"), "a")
    after = Window.partitionBy("m", "c").orderBy("a")
    found = tops.withColumn("more", F.lead("a").over(after)).select(
        "m", "c", F.col("a").alias("v"), F.lit(1).alias("top"), F.struct("a", "more").alias("own"), F.lit(None).cast("double").alias("x"))
    asked = tops.select("m", F.explode(F.array(*[F.col("c") + i for i in (1, 2, 3)])).alias("c"),
                        (F.col("a") + F.lit(delta)).alias("v"), F.lit(0).alias("top"),
                        F.lit(None).cast("struct<a:double,more:double>").alias("own"), F.col("a").alias("x"))
    both = found.unionByName(asked)
    # from above: the nearest top at or over the asked value; from below: the nearest one under it (rounding may favour it)
    down = Window.partitionBy("m", "c").orderBy(F.col("v").desc(), F.col("top").desc()).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("m", "c").orderBy("v", "top").rowsBetween(Window.unboundedPreceding, -1)
    near = both.select("*", F.last("own", True).over(down).alias("over"), F.last("own", True).over(up).alias("under")).where("top = 0")

    def fits(y: Column) -> Column:
        return F.when(y - F.col("x") >= F.lit(delta), y)
    near = near.select("m", F.col("x").alias("a"), F.least(fits(F.col("under.a")), fits(F.col("over.a")),
                                                           fits(F.col("over.more"))).alias("b"))
    # the first cell beyond the three: one row per cell that holds a maximum
    cells = tops.groupBy("m", "c").agg(F.min("a").alias("least"))
    beyond = cells.select("m", "c", F.lit(1).alias("top"), "least").unionByName(
        cells.select("m", (F.col("c") + 4).alias("c"), F.lit(0).alias("top"), F.lit(None).cast("double").alias("least")))
    far = Window.partitionBy("m").orderBy(F.col("c").desc(), F.col("top").desc()).rowsBetween(Window.unboundedPreceding, -1)
    beyond = beyond.withColumn("b", F.last("least", True).over(far)).where("top = 0").select("m", (F.col("c") - 4).alias("c"), "b")
    rest = tops.join(beyond, ["m", "c"]).select("m", "a", "b")
    return near.unionByName(rest).groupBy("m", "a").agg(F.min("b").alias("b")).where("b is not null")


def promotion_chain(runs: DataFrame, delta: float = PROMOTION_AUC_DELTA) -> DataFrame:
    """R4 for any number of runs per model: strict maxima by ranges, a pointer from each to the next promotion
    after it, and the chain from the first run by pointers that double their reach in every round."""
    maxima = strict_maxima(runs)
    jump = _stored(next_promotions(maxima, delta), "runs-next")
    chain = _stored(maxima.groupBy("m").agg(F.min("a").alias("a")), "runs-chain")
    size = chain.count()
    while True:
        more = chain.join(jump, ["m", "a"]).select("m", F.col("b").alias("a"))
        chain = _stored(chain.union(more).distinct(), "runs-chain")
        grown = chain.count()
        if grown == size:
            break
        size = grown
        jump = _stored(jump.join(jump.select("m", F.col("a").alias("b"), F.col("b").alias("to")), ["m", "b"])
                       .select("m", "a", F.col("to").alias("b")), "runs-next")
    last = chain.groupBy("m").agg(F.max("a").alias("a"), F.count(F.lit(1)).cast("int").alias("n"))
    return last.join(maxima, ["m", "a"]).select(F.col("m.model_name").alias("model_name"), F.col("r").alias("production_run_id"),
                                                F.col("a").alias("production_val_auc"), F.col("n").alias("n_promotions"))


def production_run(runs: DataFrame, delta: float = PROMOTION_AUC_DELTA) -> DataFrame:
    """The current production entry per model (None-free: models without runs are absent)."""
    return promotion_fold(runs, delta).select("model_name", "production_run_id", "production_val_auc")


def leaderboard(runs: DataFrame, delta: float = PROMOTION_AUC_DELTA) -> DataFrame:
    """R2: best run per model with is_production, sorted by best val_auc desc (then model name)."""
    b = best_run(runs)
    p = production_run(runs, delta)
    j = b.join(p, "model_name", "left")
    return j.select("model_name", "best_val_auc", "run_id", "registered_at",
                    F.coalesce(F.col("production_run_id") == F.col("run_id"), F.lit(False)).alias("is_production")) \
        .orderBy(F.col("best_val_auc").desc(), F.col("model_name"))


def history_long(hist: DataFrame, metrics, key: str = "run_id") -> DataFrame:
    """Per-epoch arrays to long rows (run, metric, step = index + 1, value); NaN and null skipped."""
    parts = None
    for m in metrics:
        e = hist.select(key, F.lit(m).alias("metric"), F.posexplode(F.col(m)).alias("pos", "value"))
        parts = e if parts is None else parts.unionByName(e)
    parts = parts.where(F.col("value").isNotNull() & ~F.isnan(F.col("value")))
    return parts.select(key, "metric", (F.col("pos") + 1).alias("step"), F.col("value").cast("double").alias("value"))


def best_epoch(hist: DataFrame, metric: str = "val_auc", key: str = "run_id") -> DataFrame:
    """1-based first arg-max of the metric history (NaN counts as largest, as in NumPy) and its value."""
    a = F.col(metric)
    return hist.select(key, F.array_position(a, F.array_max(a)).cast("int").alias("best_epoch"),
                       F.array_max(a).alias(f"best_{metric}"))


def run_summary(hist: DataFrame, extras: dict[str, Column] | None = None, key: str = "run_id") -> DataFrame:
    """best_val_auc, best_epoch, fit_time_s, n_epochs_run (defaults 0); extras override by name."""
    base = {
        "best_val_auc": F.coalesce(F.array_max("val_auc"), F.lit(0.0)),
        "best_epoch": F.coalesce(F.array_position(F.col("val_auc"), F.array_max("val_auc")).cast("double"), F.lit(0.0)),
        "fit_time_s": F.coalesce(F.col("fit_time_s").cast("double"), F.lit(0.0)) if "fit_time_s" in hist.columns
        else F.lit(0.0),
        "n_epochs_run": F.coalesce(F.size("val_auc").cast("double"), F.lit(0.0)),
    }
    base.update(extras or {})
    return hist.select(key, *[v.cast("double").alias(k) for k, v in base.items()])


def params_long(df: DataFrame, key: str, params: dict[str, Column], max_len: int = 499) -> DataFrame:
    """Params stringified and cut at ``max_len`` characters, one row per (run, param)."""
    m = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), v.cast("string"))])
    e = df.select(key, F.explode(m).alias("param", "value"))
    return e.select(key, "param", F.substring(F.col("value"), 1, max_len).alias("value"))


def config_fingerprint(*cols: Column, n: int = 12) -> Column:
    """S8 (SQL twin): first n hex digits of sha256 over the fields as length:value (null: -1:), so that no two
    different rows of fields give one text."""
    text = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-1:"))
            for c in cols]
    return F.substring(F.sha2(F.concat(*text), 256), 1, n)
