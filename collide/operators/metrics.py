"""Exact distributed classifier metrics.

Input: (label, score) rows, optionally with group columns (e.g. model).
Scores are rounded to FLOAT and widened to DOUBLE first, as the reference
does.  Everything derives from two small tables:

* ``score_state``: counts per (group, distinct score); states of parts of the data
  add up to the state of all (``merged_states``), so they can be stored and appended to
  (``sources.tables``), and every metric follows from the merged state;
* ``score_table``: one row per (group, distinct score) with pos/neg counts
  and exact running sums from ``prefix.cumulative`` (no one-task window);
* ``sweep_table``: each score is bucketed once to k = number of thresholds
  <= score (exact compare against the threshold values), so the table has
  at most n_thresholds + 1 rows per group -- never an N x thresholds join.

Only these bounded summaries are ever small enough to collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collide.operators.prefix import cumulative
from collide.session import fresh_dir


def prepared(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., y, s): y as 0/1 INT, s = DOUBLE(FLOAT(score))."""
    return df.select(*group_cols, F.col(label).cast("int").alias("y"),
                     F.col(score).cast("float").cast("double").alias("s"))


def score_state(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., s, pos, neg): rows per distinct score of prepared rows; missing scores are states of their own."""
    return df.groupBy(*group_cols, "s").agg(F.sum("y").cast("bigint").alias("pos"),
                                            (F.count(F.lit(1)) - F.sum("y")).cast("bigint").alias("neg"))


def merged_states(*states: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The state of all rows from the states of parts of them."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy(*group_cols, "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def state_table(state: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """A state plus cum_pos, cum_neg (scores >= s), tot_pos, tot_neg."""
    return cumulative(state, "s", ["pos", "neg"], list(group_cols), descending=True)


def score_table(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per (group, s): pos, neg, cum_pos, cum_neg (scores >= s), tot_pos, tot_neg."""
    return state_table(score_state(df, group_cols), group_cols)


def roc_curve(st: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the (inf, 0, 0) start point.

    No collinear point is dropped (sklearn drops them by default)."""
    def point(threshold, fpr, tpr):
        return F.struct(threshold.alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    own = point(F.col("s"), F.try_divide(F.col("cum_neg").cast("double"), F.col("tot_neg").cast("double")),
                F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos").cast("double")))
    start = point(F.lit(float("inf")), F.lit(0.0), F.lit(0.0))
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))  # the highest score of its group
    return st.select(*group_cols, F.inline(F.when(first, F.array(start, own)).otherwise(F.array(own))))


def background_rejection(roc: DataFrame, floor: float = 1e-7) -> DataFrame:
    """1 / max(fpr, floor) per ROC point (the logger uses floor 1e-6)."""
    return roc.withColumn("rejection", F.lit(1.0) / F.greatest(F.col("fpr"), F.lit(floor)))


def roc_auc(st: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """AUC with ties counted half: sum(pos * (neg_below + neg/2)) / (P N); 0.5 with one class, with no
    rows (ungrouped), or with a missing score anywhere in the group."""
    g = list(group_cols)
    agg = st.groupBy(*g).agg(
        F.max(F.col("s").isNull() | F.isnan("s")).alias("__bad"),
        F.sum(F.col("pos").cast("double") * (F.col("tot_neg") - F.col("cum_neg") + F.col("neg") / 2.0)).alias("__num"),
        F.first("tot_pos").alias("P"), F.first("tot_neg").alias("N"))
    pn = F.col("P").cast("double") * F.col("N").cast("double")
    return agg.select(*g, F.when((pn > 0) & ~F.col("__bad"), F.col("__num") / pn).otherwise(F.lit(0.5)).alias("roc_auc"))


def pr_curve(st: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus (1, 0) at the end; baseline = mean label."""
    g = list(group_cols)
    pts = st.select(*g, F.col("s").alias("threshold"),
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos").cast("double")).alias("recall"),
                    (F.col("tot_pos") / (F.col("tot_pos") + F.col("tot_neg"))).alias("baseline"))
    end = st.groupBy(*g).agg(F.first("tot_pos").alias("P"), F.first("tot_neg").alias("N")).select(
        *g, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"), (F.col("P") / (F.col("P") + F.col("N"))).alias("baseline"))
    return pts.unionByName(end)


def average_precision(st: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Step sum AP = sum over distinct scores of (pos/P) * precision; the mean label with no positives or
    with a missing score anywhere in the group."""
    g = list(group_cols)
    agg = st.groupBy(*g).agg(
        F.max(F.col("s").isNull() | F.isnan("s")).alias("__bad"),
        F.sum(F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))).alias("__num"),
        F.first("tot_pos").alias("P"), F.first("tot_neg").alias("N"))
    return agg.select(*g, F.when((F.col("P") > 0) & ~F.col("__bad"), F.col("__num") / F.col("P"))
                      .otherwise(F.col("P") / (F.col("P") + F.col("N"))).alias("average_precision"))


# --------------------------------------------------------------------------- threshold sweep
def _threshold(i: Column, n: int) -> Column:
    """NumPy linspace(0, 1, n): i * (1/(n-1)), last value exactly 1.0."""
    return F.when(i == F.lit(n - 1), F.lit(1.0)).otherwise(i.cast("double") * F.lit(1.0 / (n - 1)))


def n_thresholds_at_or_below(s: Column, n: int = 200) -> Column:
    """k = #{i : t_i <= s}, exact: floor(s*(n-1)) + 1 corrected by +-1 against the threshold values."""
    k0 = F.least(F.greatest(F.floor(s * F.lit(float(n - 1))) + 1, F.lit(0)), F.lit(n)).cast("int")
    up = F.when((k0 < n) & (_threshold(k0, n) <= s), k0 + 1).otherwise(k0)
    down = F.when((up > 0) & (_threshold(up - 1, n) > s), up - 1).otherwise(up)
    return F.when(F.isnan(s) | s.isNull(), F.lit(0)).otherwise(down)


def sweep_table(df: DataFrame, n: int = 200, group_cols: Sequence[str] = ()) -> DataFrame:
    """E4/E6 base: per (group, i): threshold t_i, tp, fp, tn, fn from a <= n+1-row aggregate per group."""
    g = list(group_cols) or ["__k"]
    if not group_cols:
        df = df.withColumn("__k", F.lit(0))
    k = df.groupBy(*g, n_thresholds_at_or_below(F.col("s"), n).alias("k")).agg(
        F.sum("y").cast("bigint").alias("pk"), (F.count(F.lit(1)) - F.sum("y")).cast("bigint").alias("nk"))
    # complete k = 0..n per group with a generator (no join against the data)
    grid = k.select(*g).distinct().select(*g, F.explode(F.sequence(F.lit(0), F.lit(n))).alias("k"))
    full = grid.join(k, on=[*g, "k"], how="left").fillna(0, ["pk", "nk"])
    # rows with score >= t_i are those with k >= i + 1: reverse running sum over <= n+1 rows per group
    w = Window.partitionBy(*g)
    w_rev = w.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = full.select(*g, "k", F.sum("pk").over(w_rev).alias("tp"), F.sum("nk").over(w_rev).alias("fp"),
                      F.sum("pk").over(w).alias("P"), F.sum("nk").over(w).alias("N"))
    out = cum.where(F.col("k") >= 1).select(
        *g, (F.col("k") - 1).alias("i"), _threshold(F.col("k") - 1, n).alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        (F.col("N") - F.col("fp")).cast("bigint").alias("tn"), (F.col("P") - F.col("tp")).cast("bigint").alias("fn"))
    return out.drop("__k") if not group_cols else out


def threshold_sweep(sw: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 per threshold with the reference's guards."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    prec = tp / F.greatest(tp + fp, F.lit(1.0))
    rec = tp / F.greatest(tp + fn, F.lit(1.0))
    return sw.select(*group_cols, "i", "threshold", "tp", "fp", "tn", "fn",
                     ((tp + tn) / F.greatest(n, F.lit(1.0))).alias("accuracy"),
                     prec.alias("precision"), rec.alias("recall"),
                     (F.lit(2.0) * prec * rec / F.greatest(prec + rec, F.lit(1e-9))).alias("f1"))


def best_threshold(sweep: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Best F1 (first arg-max), best accuracy, threshold of the best F1."""
    g = list(group_cols)
    return sweep.groupBy(*g).agg(
        F.max_by(F.struct("f1", "threshold"), F.struct(F.col("f1"), -F.col("i"))).alias("b"),
        F.max("accuracy").alias("best_accuracy")).select(
        *g, F.col("b.f1").alias("best_f1"), "best_accuracy", F.col("b.threshold").alias("best_threshold"))


def punzi_fom(sw: DataFrame, a: float = 5.0, group_cols: Sequence[str] = ()) -> DataFrame:
    """S / (a/2 + sqrt(max(B, 1e-9))) per threshold, S = tp, B = fp."""
    return sw.select(*group_cols, "i", "threshold", "tp", "fp",
                     (F.col("tp") / (F.lit(a / 2.0) + F.sqrt(F.greatest(F.col("fp").cast("double"), F.lit(1e-9)))))
                     .alias("fom"))


def best_punzi(fom: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Best FOM and its threshold (first arg-max)."""
    g = list(group_cols)
    return fom.groupBy(*g).agg(F.max_by(F.struct("fom", "threshold"), F.struct(F.col("fom"), -F.col("i"))).alias("b")) \
        .select(*g, F.col("b.fom").alias("best_punzi_fom"), F.col("b.threshold").alias("best_punzi_threshold"))


# --------------------------------------------------------------------------- calibration
def _edge(j: int, n_bins: int) -> float:
    return 1.0 if j == n_bins else j * (1.0 / n_bins)


def calibration_curve(df: DataFrame, n_bins: int = 10, group_cols: Sequence[str] = ()) -> DataFrame:
    """Uniform bins (lo, hi] (first bin closed), empty bins dropped: (bin, mean_predicted, fraction_positive, n)."""
    s = F.col("s")
    b = None
    for j in range(1, n_bins):
        t = (s > F.lit(_edge(j, n_bins))).cast("int")
        b = t if b is None else b + t
    b = b if b is not None else F.lit(0)
    return df.groupBy(*group_cols, b.alias("bin")).agg(
        F.avg("s").alias("mean_predicted"), F.avg(F.col("y").cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def calibration_ece(df: DataFrame, n_bins: int = 10, group_cols: Sequence[str] = ()) -> DataFrame:
    """ECE over bins [lo, hi); a score of exactly 1.0 (or outside [0,1)) is in no bin but counts in n."""
    g = list(group_cols)
    s = F.col("s")
    b = None
    for j in range(1, n_bins + 1):
        t = (s >= F.lit(_edge(j, n_bins))).cast("int")
        b = t if b is None else b + t
    valid = (s >= F.lit(0.0)) & (b < F.lit(n_bins))
    per = df.groupBy(*g, F.when(valid, b).alias("bin")).agg(
        F.count(F.lit(1)).alias("nb"), F.avg(F.col("y").cast("double")).alias("acc"), F.avg("s").alias("conf"))
    w = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    per = per.withColumn("n_all", F.sum("nb").over(w))
    return per.groupBy(*g).agg(
        F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("nb") / F.col("n_all") * F.abs(F.col("acc") - F.col("conf")))),
                   F.lit(0.0)).alias("calibration_ece"))


# --------------------------------------------------------------------------- other
def score_histogram(df: DataFrame, n_bins: int = 60, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per class, n_bins uniform bins over that class's [min, max], last bin closed; density."""
    g = list(group_cols) + ["y"]
    rng = df.groupBy(*g).agg(F.min("s").alias("mn"), F.max("s").alias("mx"), F.count(F.lit(1)).alias("n_class"))
    # one row per (group, class); bounded, and broadcast, without group columns
    d = df.join(rng if group_cols else F.broadcast(rng), on=g)
    width = F.col("mx") - F.col("mn")
    step = width / F.lit(float(n_bins))

    def edge(i: Column) -> Column:
        return F.when(i == F.lit(n_bins), F.col("mx")).otherwise(i.cast("double") * step + F.col("mn"))
    raw = F.when(width > 0, F.floor((F.col("s") - F.col("mn")) * (F.lit(float(n_bins)) / width))).otherwise(F.lit(0))
    i0 = F.least(F.greatest(raw, F.lit(0)), F.lit(n_bins - 1)).cast("int")
    i1 = F.when((i0 > 0) & (F.col("s") < edge(i0)), i0 - 1).otherwise(i0)
    i2 = F.when((i1 < n_bins - 1) & (F.col("s") >= edge(i1 + 1)), i1 + 1).otherwise(i1)
    d = d.withColumn("bin", F.when(width > 0, i2).otherwise(F.lit(0)))
    counts = d.groupBy(*g, "bin", "mn", "mx", "n_class").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    bw = F.when(F.col("mx") > F.col("mn"), edge(F.col("bin") + 1) - edge(F.col("bin"))).otherwise(F.lit(1.0))
    return counts.select(*g, "bin", "count", (F.col("count") / (F.col("n_class") * bw)).alias("density"))


def brier_score(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """mean((p - y)^2)."""
    return df.groupBy(*group_cols).agg(F.avg(F.pow(F.col("s") - F.col("y"), 2)).alias("brier_score"))


def class_totals(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols).agg(F.sum("y").cast("bigint").alias("n_signal"),
                                       (F.count(F.lit(1)) - F.sum("y")).cast("bigint").alias("n_background"))


def evaluate_state(state: DataFrame, group_cols: Sequence[str] = (), n_thresholds: int = 200, n_bins: int = 10,
                   a: float = 5.0) -> DataFrame:
    """E7 from a score state: one row per group (one row without groups, also of no scores) with the eight
    metrics and the two counts.

    The score table is reduced to one row per (group, number of thresholds at or below the score) and
    these, at most n_thresholds + 1 a group, to arrays in which the sweep is worked out."""
    g, n = list(group_cols), n_thresholds
    st, s = state_table(state, g), F.col("s")
    both = F.col("pos") + F.col("neg")
    bin_ = F.lit(0)
    for j in range(1, n_bins + 1):
        bin_ = bin_ + (s >= F.lit(_edge(j, n_bins))).cast("int")
    bin_ = F.when((s >= F.lit(0.0)) & ~F.isnan(s), bin_)
    sums = {"pos": F.col("pos"), "neg": F.col("neg"),
            "auc": F.col("pos").cast("double") * (F.col("tot_neg") - F.col("cum_neg") + F.col("neg") / 2.0),
            "ap": F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))}
    for j in range(n_bins):
        sums |= {f"n{j}": F.when(bin_ == j, both).otherwise(0), f"y{j}": F.when(bin_ == j, F.col("pos")).otherwise(0),
                 f"s{j}": F.when(bin_ == j, s * both).otherwise(0.0)}
    per_k = st.groupBy(*g, n_thresholds_at_or_below(s, n).alias("k")).agg(
        F.max(s.isNull() | F.isnan(s)).alias("bad"), *[F.sum(v).alias(c) for c, v in sums.items()])
    one = per_k.groupBy(*g).agg(
        F.collect_list(F.struct("k", "pos", "neg")).alias("ks"), F.coalesce(F.max("bad"), F.lit(False)).alias("bad"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])

    def dense(c: str) -> Column:  # rows per k = 0..n
        return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: F.aggregate(
            F.filter("ks", lambda x: x["k"] == k), F.lit(0).cast("long"), lambda acc, x: acc + x[c]))
    one = one.withColumns({"pk": dense("pos"), "nk": dense("neg")}).drop("ks")

    def above(c: str) -> Column:  # rows with a score at or above threshold i are those with k > i
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.aggregate(
            F.slice(c, i + 2, F.lit(n)), F.lit(0).cast("long"), lambda acc, x: acc + x))
    one = one.withColumns({"tp": above("pk"), "fp": above("nk")}).drop("pk", "nk")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")

    def at(i: Column) -> Column:
        tp, fp = F.get("tp", i).cast("double"), F.get("fp", i).cast("double")
        prec, rec = tp / F.greatest(tp + fp, F.lit(1.0)), tp / F.greatest(pos, F.lit(1.0))
        return F.struct((F.lit(2.0) * prec * rec / F.greatest(prec + rec, F.lit(1e-9))).alias("f1"),
                        ((tp + neg - fp) / F.greatest(pos + neg, F.lit(1.0))).alias("accuracy"),
                        (tp / (F.lit(a / 2.0) + F.sqrt(F.greatest(fp, F.lit(1e-9))))).alias("fom"),
                        (-i).alias("first"), _threshold(i, n).alias("threshold"))
    one = one.withColumn("sweep", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), at)).drop("tp", "fp")

    def best(c: str) -> Column:  # the first arg-max
        return F.array_max(F.transform("sweep", lambda x: F.struct(x[c].alias("v"), x["first"].alias("i"), x["threshold"].alias("t"))))
    one = one.withColumns({"f": best("f1"), "p": best("fom"), "best_accuracy": F.array_max(F.transform("sweep", lambda x: x["accuracy"]))})
    ece = F.lit(0.0)
    for j in range(n_bins):
        nj = F.col(f"n{j}").cast("double")
        ece = ece + F.when(nj > 0, nj / (pos + neg) * F.abs(F.col(f"y{j}") / nj - F.col(f"s{j}") / nj)).otherwise(F.lit(0.0))
    return one.select(
        *g, F.when((pos * neg > 0) & ~F.col("bad"), F.col("auc") / (pos * neg)).otherwise(F.lit(0.5)).alias("roc_auc"),
        F.when((pos > 0) & ~F.col("bad"), F.col("ap") / pos).otherwise(F.try_divide(pos, pos + neg)).alias("average_precision"),
        F.col("f.v").alias("best_f1"), "best_accuracy", F.col("f.t").alias("best_threshold"),
        F.col("p.v").alias("best_punzi_fom"), F.col("p.t").alias("best_punzi_threshold"), ece.alias("calibration_ece"),
        F.col("pos").cast("bigint").alias("n_signal"), F.col("neg").cast("bigint").alias("n_background"))


def evaluate(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = (),
             n_thresholds: int = 200, n_bins: int = 10, a: float = 5.0, model_name: str = "model",
             run_name: str = "evaluation") -> DataFrame:
    """One row per group with the eight metrics, the two counts and the names.

    The input is read once, into its score state in the shared folder; everything else reads that."""
    g, spark = list(group_cols), df.sparkSession
    path = fresh_dir(spark, "score-state")
    state = score_state(prepared(df, label, score, g), g)
    state.write.parquet(path)
    out = evaluate_state(spark.read.schema(state.schema).parquet(path), g, n_thresholds, n_bins, a)
    names = [F.lit(model_name).alias("model_name")] if not g else []
    return out.select("*", *names, F.lit(run_name).alias("run_name"))


def compare_models(df: DataFrame, model: str = "model", label: str = "label", score: str = "score") -> DataFrame:
    """(model, roc_auc, best_f1, best_punzi_fom) rounded to 6, 6 and 4 decimals, from one read of the long table."""
    e = evaluate(df, label, score, [model])
    return e.select(model, *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in (("roc_auc", 6), ("best_f1", 6), ("best_punzi_fom", 4))])
