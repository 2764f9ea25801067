"""Queries for the evaluation metrics (E1-E12) on the ``scored`` view
(and ``scored2`` for model comparison).  The oracles are brute force:
ranks with ties for AUC, a threshold x rows join for the sweep -- work
the Spark side never does."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide.catalog import query
from collide.functions import kinematics as K
from collide.operators import metrics as M

SC = ["scored"]
S32 = "cast(cast(score as float) as double)"


def _p(spark, sf, which="scored"):
    return M.prepared(FX.scored(spark, sf, which))


def _rd(c, n):
    return (F.round(F.col(c), n) + F.lit(0.0)).alias(c)


# per distinct score (desc): pos, neg, cumulative tp/fp, totals -- written with plain SQL windows
_ST_SQL = f""", s as (select {S32} as s, label as y from scored),
g as (select s, sum(y) as pos, count(*) - sum(y) as neg from s group by s),
st as (select s, pos, neg, sum(pos) over (order by s desc) as tp, sum(neg) over (order by s desc) as fp,
              sum(pos) over () as P, sum(neg) over () as N from g)
"""


@query("roc_curve", FX.oracle(SC, _ST_SQL + """
select s as threshold, fp / N as fpr, tp / P as tpr from st
union all select 'inf'::double, 0e0, 0e0"""))
def roc_curve(spark, sf):
    """(threshold, fpr, tpr) at every distinct score plus the start point; no point dropped."""
    return M.roc_curve(M.score_table(_p(spark, sf)))


@query("background_rejection", FX.oracle(SC, _ST_SQL + """
select threshold, fpr, tpr, 1e0 / greatest(fpr, 1e-7) as rejection from (
  select s as threshold, fp / N as fpr, tp / P as tpr from st
  union all select 'inf'::double, 0e0, 0e0) t"""))
def background_rejection(spark, sf):
    """1 / max(fpr, 1e-7) along the ROC curve."""
    return M.background_rejection(M.roc_curve(M.score_table(_p(spark, sf))))


@query("roc_auc", FX.oracle(SC, f""", s as (select {S32} as s, label as y from scored),
r as (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2e0 as ar from s)
select round((sum(ar) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2e0)
        / (count(*) filter (where y = 1) * count(*) filter (where y = 0)), 12) + 0e0 as roc_auc from r"""))
def roc_auc(spark, sf):
    """Exact AUC with ties counted half (0.6798652655829498 at sf0.01), from running sums."""
    return M.roc_auc(M.score_table(_p(spark, sf))).select(_rd("roc_auc", 12))


@query("pr_curve", FX.oracle(SC, _ST_SQL + """
select s as threshold, tp / (tp + fp) as precision, tp / P as recall, P / (P + N) as baseline from st
union all select null, 1e0, 0e0, max(P) / (max(P) + max(N)) from st"""))
def pr_curve(spark, sf):
    """Precision / recall at every distinct score, plus the (recall 0, precision 1) end; baseline = mean label."""
    return M.pr_curve(M.score_table(_p(spark, sf)))


@query("average_precision", FX.oracle(SC, _ST_SQL + """
select round(sum(pos * tp / (tp + fp)) / max(P), 12) + 0e0 as average_precision from st"""))
def average_precision(spark, sf):
    """Step-sum average precision (0.5845784885602943 at sf0.01)."""
    return M.average_precision(M.score_table(_p(spark, sf))).select(_rd("average_precision", 12))


_SWEEP_SQL = f""", s as (select {S32} as s, label as y from scored),
t as (select cast(range as int) as i, case when range = 199 then 1e0 else range * (1e0 / 199e0) end as threshold from range(200)),
c as (select i, threshold, cast(count(*) filter (where s >= threshold and y = 1) as bigint) as tp,
             cast(count(*) filter (where s >= threshold and y = 0) as bigint) as fp,
             cast(count(*) filter (where not (s >= threshold) and y = 0) as bigint) as tn,
             cast(count(*) filter (where not (s >= threshold) and y = 1) as bigint) as fn
      from t join s on true group by i, threshold),
m as (select *, (tp + tn) / greatest(tp + fp + tn + fn, 1) as accuracy, tp / greatest(tp + fp, 1) as precision,
             tp / greatest(tp + fn, 1) as recall from c),
f as (select *, 2e0 * precision * recall / greatest(precision + recall, 1e-9) as f1 from m)
"""


@query("threshold_sweep", FX.oracle(SC, _SWEEP_SQL + "select * from f"))
def threshold_sweep(spark, sf):
    """Tp, fp, tn, fn, accuracy, precision, recall, F1 at linspace(0, 1, 200); each score bucketed once."""
    return M.threshold_sweep(M.sweep_table(_p(spark, sf)))


@query("best_threshold", FX.oracle(SC, _SWEEP_SQL + """
select (select f1 from f order by f1 desc, i limit 1) as best_f1, (select max(accuracy) from f) as best_accuracy,
       (select threshold from f order by f1 desc, i limit 1) as best_threshold"""))
def best_threshold(spark, sf):
    """Best F1 (first arg-max), best accuracy, threshold of the best F1."""
    return M.best_threshold(M.threshold_sweep(M.sweep_table(_p(spark, sf))))


_PUNZI_SQL = _SWEEP_SQL + """, pz as (select i, threshold, tp, fp, tp / (5e0 / 2e0 + sqrt(greatest(cast(fp as double), 1e-9))) as fom from f)
"""


@query("punzi_fom", FX.oracle(SC, _PUNZI_SQL + "select * from pz"))
def punzi_fom(spark, sf):
    """Punzi figure of merit S / (a/2 + sqrt(max(B, 1e-9))), a = 5, per threshold."""
    return M.punzi_fom(M.sweep_table(_p(spark, sf)))


@query("best_punzi", FX.oracle(SC, _PUNZI_SQL + """
select fom as best_punzi_fom, threshold as best_punzi_threshold from pz order by fom desc, i limit 1"""))
def best_punzi(spark, sf):
    """Best Punzi value and its threshold (first arg-max)."""
    return M.best_punzi(M.punzi_fom(M.sweep_table(_p(spark, sf))))


def _cal_bin_sql() -> str:
    return " + ".join(f"cast(s > {j * (1.0 / 10)!r}e0 as int)" for j in range(1, 10))


@query("calibration_curve", FX.oracle(SC, f""", s as (select {S32} as s, label as y from scored)
select bin, round(avg(s), 9) + 0e0 as mean_predicted, round(avg(cast(y as double)), 9) + 0e0 as fraction_positive,
       cast(count(*) as bigint) as n
from (select *, {_cal_bin_sql()} as bin from s) t group by bin"""))
def calibration_curve(spark, sf):
    """Uniform bins (lo, hi], empty bins dropped."""
    c = M.calibration_curve(_p(spark, sf))
    return c.select("bin", _rd("mean_predicted", 9), _rd("fraction_positive", 9), "n")


def _ece_sql(src: str = "scored") -> str:
    edges = [(j * (1.0 / 10) if j < 10 else 1.0) for j in range(11)]
    conds = " ".join(f"when s >= {edges[j]!r}e0 and s < {edges[j + 1]!r}e0 then {j}" for j in range(10))
    return f""", s as (select {S32} as s, label as y from {src}),
b as (select *, case {conds} end as bin from s),
per as (select bin, count(*) as nb, avg(cast(y as double)) as acc, avg(s) as conf from b group by bin)
select round(coalesce(sum(nb / (select count(*) from s) * abs(acc - conf)) filter (where bin is not null), 0e0), 9) + 0e0
       as calibration_ece from per"""


@query("calibration_ece", FX.oracle(SC, _ece_sql()))
def calibration_ece(spark, sf):
    """Expected calibration error over [lo, hi) bins; a score of 1.0 is in no bin but counts in n."""
    return M.calibration_ece(_p(spark, sf)).select(_rd("calibration_ece", 9))


@query("evaluate", FX.oracle(SC, _PUNZI_SQL.rstrip() + f""",
st0 as (select s, sum(y) as pos, count(*) - sum(y) as neg from s group by s),
st as (select s, pos, neg, sum(pos) over (order by s desc) as tp, sum(neg) over (order by s desc) as fp,
              sum(pos) over () as P, sum(neg) over () as N from st0),
ar as (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2e0 as ar from s),
auc as (select (sum(ar) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2e0)
        / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as v from ar),
ap as (select sum(pos * tp / (tp + fp)) / max(P) as v from st),
bf as (select f1, threshold from f order by f1 desc, i limit 1),
bp as (select fom, threshold from pz order by fom desc, i limit 1),
cb as (select *, case {' '.join(f"when s >= {(j * 0.1 if j < 10 else 1.0)!r}e0 and s < {((j + 1) * 0.1 if j + 1 < 10 else 1.0)!r}e0 then {j}" for j in range(10))} end as bin from s),
cper as (select bin, count(*) as nb, avg(cast(y as double)) as acc, avg(s) as conf from cb group by bin),
ece as (select coalesce(sum(nb / (select count(*) from s) * abs(acc - conf)) filter (where bin is not null), 0e0) as v from cper)
select round((select v from auc), 12) + 0e0 as roc_auc, round((select v from ap), 12) + 0e0 as average_precision,
       (select f1 from bf) as best_f1, (select max(accuracy) from f) as best_accuracy, (select threshold from bf) as best_threshold,
       (select fom from bp) as best_punzi_fom, (select threshold from bp) as best_punzi_threshold,
       round((select v from ece), 9) + 0e0 as calibration_ece,
       (select cast(sum(y) as bigint) from s) as n_signal, (select cast(count(*) - sum(y) as bigint) from s) as n_background,
       'model' as model_name, 'evaluation' as run_name"""))
def evaluate(spark, sf):
    """The full one-row result: eight metrics, two counts, names -- one plan."""
    e = M.evaluate(FX.scored(spark, sf))
    return e.select(_rd("roc_auc", 12), _rd("average_precision", 12), "best_f1", "best_accuracy", "best_threshold",
                    "best_punzi_fom", "best_punzi_threshold", _rd("calibration_ece", 9), "n_signal", "n_background",
                    "model_name", "run_name")


@query("score_histogram", FX.oracle(SC, f""", s as (select {S32} as s, label as y from scored),
r as (select y, min(s) as mn, max(s) as mx, count(*) as n_class from s group by y),
j as (select s.s, s.y, r.mn, r.mx, r.n_class, (r.mx - r.mn) / 60e0 as step from s join r on s.y = r.y),
e as (select *, least(greatest(floor((s - mn) * (60e0 / (mx - mn))), 0), 59) as i0 from j),
e1 as (select *, case when i0 > 0 and s < i0 * step + mn then i0 - 1 else i0 end as i1 from e),
e2 as (select *, cast(case when i1 < 59 and s >= (case when i1 + 1 = 60 then mx else (i1 + 1) * step + mn end) then i1 + 1 else i1 end as int) as bin from e1),
c as (select y, bin, mn, mx, n_class, step, count(*) as cnt from e2 group by y, bin, mn, mx, n_class, step)
select y, bin, cast(cnt as bigint) as count,
       round(cnt / (n_class * ((case when bin + 1 = 60 then mx else (bin + 1) * step + mn end) - (bin * step + mn))), 9) + 0e0 as density
from c"""))
def score_histogram(spark, sf):
    """Per-class 60-bin density histogram over that class's score range, last bin closed."""
    h = M.score_histogram(_p(spark, sf))
    return h.select("y", "bin", "count", _rd("density", 9))


def _long_scores(spark, sf):
    a = FX.scored(spark, sf, "scored").select("event_id", "label", F.col("score").alias("model_a"))
    b = FX.scored(spark, sf, "scored2").select("event_id", F.col("score").alias("model_b"))
    wide = a.join(b, "event_id")
    return wide.unpivot(["event_id", "label"], ["model_a", "model_b"], "model", "score")


@query("model_comparison", FX.oracle(["scored", "scored2"], f""", wide as (
  select a.event_id, a.label, a.score as model_a, b.score as model_b from scored a join scored2 b on a.event_id = b.event_id),
s as (select 'model_a' as model, cast(cast(model_a as float) as double) as s, label as y from wide
      union all select 'model_b', cast(cast(model_b as float) as double), label from wide),
ar as (select model, y, rank() over (partition by model order by s) + (count(*) over (partition by model, s) - 1) / 2e0 as ar from s),
auc as (select model, (sum(ar) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2e0)
        / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as auc from ar group by model),
t as (select cast(range as int) as i, case when range = 199 then 1e0 else range * (1e0 / 199e0) end as threshold from range(200)),
c as (select model, i, threshold, count(*) filter (where s >= threshold and y = 1) as tp,
             count(*) filter (where s >= threshold and y = 0) as fp,
             count(*) filter (where not (s >= threshold) and y = 0) as tn,
             count(*) filter (where not (s >= threshold) and y = 1) as fn
      from t join s on true group by model, i, threshold),
f as (select model, i, tp / greatest(tp + fp, 1) as p, tp / greatest(tp + fn, 1) as r,
             tp / (2.5e0 + sqrt(greatest(cast(fp as double), 1e-9))) as fom from c),
f1 as (select model, i, 2e0 * p * r / greatest(p + r, 1e-9) as f1, fom from f)
select a.model, round(a.auc, 6) + 0e0 as roc_auc, round(max(f1.f1), 6) + 0e0 as best_f1, round(max(f1.fom), 4) + 0e0 as best_punzi_fom
from auc a join f1 on a.model = f1.model group by a.model, a.auc"""))
def model_comparison(spark, sf):
    """AUC, best F1, best Punzi per model (rounded 6/6/4) from one long table grouped by model."""
    return M.compare_models(_long_scores(spark, sf))


@query("signal_significance", FX.oracle(SC, _SWEEP_SQL + """
select i, threshold, round(tp / sqrt(greatest(cast(fp as double), 1e-10)), 9) + 0e0 as significance from f"""))
def signal_significance(spark, sf):
    """S / sqrt(max(B, 1e-10)) per threshold of the sweep."""
    sw = M.sweep_table(_p(spark, sf))
    return sw.select("i", "threshold", K.signal_significance("tp", "fp").alias("significance")) \
        .select("i", "threshold", _rd("significance", 9))


@query("punzi_efficiency", FX.oracle(SC, _SWEEP_SQL + """
select i, threshold, round((tp / (tp + fn)) / (5e0 / 2e0 + sqrt(greatest(cast(fp as double), 1e-10))), 12) + 0e0 as punzi_eff from f"""))
def punzi_efficiency(spark, sf):
    """Efficiency / (sigma/2 + sqrt(max(B, 1e-10))), efficiency = tp / P."""
    sw = M.sweep_table(_p(spark, sf))
    eff = F.col("tp") / (F.col("tp") + F.col("fn"))
    return sw.select("i", "threshold", K.punzi_efficiency(eff, "fp").alias("punzi_eff")) \
        .select("i", "threshold", _rd("punzi_eff", 12))


@query("brier_score", FX.oracle(SC, f"""
select round(avg(pow({S32} - label, 2)), 12) + 0e0 as brier_score from scored"""))
def brier_score(spark, sf):
    """Mean squared difference between score and label."""
    return M.brier_score(_p(spark, sf)).select(_rd("brier_score", 12))
