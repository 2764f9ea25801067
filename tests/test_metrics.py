"""Metric identities (E1-E12) and brute-force comparisons."""
import numpy as np
import pytest

from collide.operators import metrics as M


def frame(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")


def auc(spark, y, s):
    return M.roc_auc(M.score_table(M.prepared(frame(spark, y, s)))).first()["roc_auc"]


def test_auc_identities(spark):
    assert auc(spark, [0, 0, 0, 1, 1, 1], [0.1, 0.2, 0.3, 0.7, 0.8, 0.9]) == 1.0
    assert auc(spark, [1, 1, 1, 0, 0, 0], [0.1, 0.2, 0.3, 0.7, 0.8, 0.9]) == 0.0
    assert auc(spark, [0, 1, 0, 1], [0.5, 0.5, 0.5, 0.5]) == 0.5
    assert auc(spark, [1, 1, 1], [0.1, 0.5, 0.9]) == 0.5          # one class -> 0.5


def test_auc_pair_count_and_monotone_invariance(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 2000)
    s = np.round(rng.uniform(0, 1, 2000) * 0.5 + y * 0.2, 3).astype(np.float32)
    pos, neg = s[y == 1], s[y == 0]
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    a = auc(spark, y, s)
    assert abs(a - ref) < 1e-12
    assert abs(auc(spark, y, s.astype(np.float64) ** 3) - a) < 1e-12


def test_average_precision_step_sum(spark):
    ap = M.average_precision(M.score_table(M.prepared(frame(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])))).first()[0]
    assert abs(ap - 0.8333333333333333) < 1e-12


def test_sweep_matches_brute_force_on_edges(spark):
    t = np.linspace(0, 1, 200)
    edge = np.concatenate([t, np.nextafter(t, -1), [0.0, 1.0, 0.5]]).astype(np.float32)
    rng = np.random.default_rng(1)
    s = np.concatenate([edge, rng.uniform(0, 1, 3000).astype(np.float32)])
    y = rng.integers(0, 2, len(s))
    sw = M.sweep_table(M.prepared(frame(spark, y, s))).orderBy("i").toPandas()
    s64 = s.astype(np.float64)
    tp = np.array([int(((s64 >= x) & (y == 1)).sum()) for x in t])
    fp = np.array([int(((s64 >= x) & (y == 0)).sum()) for x in t])
    assert (sw.tp.to_numpy() == tp).all() and (sw.fp.to_numpy() == fp).all()
    assert np.array_equal(sw.threshold.to_numpy(), t)


def test_ece_drops_score_one_but_counts_it(spark):
    df = M.prepared(frame(spark, [1, 0, 1], [1.0, 0.05, 0.95]))
    ece = M.calibration_ece(df).first()[0]
    # bins: 0.05 (y=0) -> |0-0.05|; 0.95 (y=1) -> |1-0.95|; the 1.0 row is in no bin but n = 3
    assert abs(ece - (1 / 3 * 0.05 + 1 / 3 * (1 - np.float32(0.95)))) < 1e-7


def test_brier_and_punzi(spark):
    df = M.prepared(frame(spark, [1, 0], [0.8, 0.3]))
    assert abs(M.brier_score(df).first()[0] - ((0.2 ** 2 + 0.3 ** 2) / 2)) < 1e-7
    y = [1] * 500 + [0] * 500
    s = [0.8] * 500 + [0.3] * 500
    best = M.best_punzi(M.punzi_fom(M.sweep_table(M.prepared(frame(spark, y, s))))).first()
    assert best["best_punzi_fom"] > 10


@pytest.mark.parametrize("parts", [1, 7])
def test_score_table_partition_invariant(spark, parts):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 3000)
    s = rng.uniform(0, 1, 3000).round(3)
    st = M.score_table(M.prepared(frame(spark, y, s).repartition(parts))).orderBy("s").toPandas()
    order = np.argsort(-np.unique(s.astype(np.float32)))
    assert len(st) == len(order)
    srt = st.sort_values("s", ascending=False)
    assert (np.diff(srt.cum_pos.to_numpy()) >= 0).all()
    assert srt.cum_pos.iloc[-1] == y.sum() and srt.cum_neg.iloc[-1] == (1 - y).sum()
