"""Stores: registered storage queries, concurrent writers, orphans, append tables, models."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from collide.catalog import QUERIES, load_all
from collide.operators import metrics as M
from collide.operators import registry as R
from collide.session import fresh_dir
from collide.sources import commits as C
from collide.sources import io as IO
from collide.sources import tables as TB

from tests.conftest import SF_SMALL

load_all()


@pytest.mark.parametrize("name", ["scan_csv", "scan_csv_gz", "limit_first_n", "cached_read", "split_store", "split_reload",
                                  "feature_store_load", "ragged_scan", "list_columns", "registry_append",
                                  "metrics_by_step", "score_store"])
def test_storage_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_two_writers_leave_one_version(spark):
    root = fresh_dir(spark, "race")
    frames = [spark.range(1000 * (i + 1)).select("id", F.lit(i).alias("writer"), F.lit("train").alias("split")) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda f: IO.write_splits(spark, f, root, "v1"), frames))
    got = IO.read_split(spark, root).groupBy("writer").count().collect()
    assert len(got) == 1 and got[0]["count"] == 1000 * (got[0]["writer"] + 1)
    assert len(C.history(spark, f"{root}/v1/_meta")) == 4 and IO.latest_version(spark, root) == "v1"


def test_records_are_numbered_once(spark):
    log = fresh_dir(spark, "log") + "/_commits"
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: C.commit(spark, log, {"i": i}), range(40)))
    assert sorted(numbers) == list(range(40))
    assert sorted(r["i"] for r in C.history(spark, log)) == list(range(40))


def test_half_written_record_and_orphans(spark):
    base = fresh_dir(spark, "orphans")
    IO.commit_data(spark, spark.range(5), base, {"k": 1})
    kept = IO.read_json_marker(spark, f"{base}/_meta")["data"]
    spark.range(9).write.parquet(f"{base}/data-dead")  # a writer that died before its commit
    fs, p = C.fs_of(spark, f"{base}/_meta/{7:020d}.json")
    fs.create(p, False).close()  # and one that died inside it
    assert IO.committed_data(spark, base).count() == 5
    assert IO.collect_orphans(spark, base) == []  # too young
    assert IO.collect_orphans(spark, base, -60.0) == ["data-dead"]
    assert IO.committed_data(spark, base).count() == 5 and IO.exists(spark, f"{base}/{kept}")
    assert C.commit(spark, f"{base}/_meta", {"data": kept}) == 8
    assert not IO.marker_exists(spark, f"{base}/none")
    with pytest.raises(FileNotFoundError):
        IO.committed_data(spark, f"{base}/none")


def test_runs_and_metrics(spark):
    root, steps = fresh_dir(spark, "runs"), fresh_dir(spark, "steps")
    assert TB.read_runs(spark, root).count() == 0
    assert TB.register_run(spark, root, "m", "r1", {"val_auc": 0.70, "f1": 0.5}, {"dataset": "x"}, promote=True)
    assert not TB.register_run(spark, root, "m", "r2", {"val_auc": 0.703}, promote=True)
    assert TB.register_run(spark, root, "m", "r3", {"val_auc": 0.71}, promote=True)
    assert not TB.register_run(spark, root, "m", "r4", {})
    got = {r["run_id"]: r for r in TB.read_runs(spark, root).collect()}
    assert got["r1"]["metrics"] == {"val_auc": 0.70, "f1": 0.5} and got["r1"]["tags"] == {"dataset": "x"}
    assert got["r4"]["val_auc"] == 0.0
    hist = spark.createDataFrame([("r1", [0.5, float("nan"), 0.7]), ("r2", None)], "run_id string, auc array<double>")
    TB.log_history(spark, hist, ["auc"], steps)
    TB.log_metrics(spark, steps, "r1", {"best": 0.7})
    assert sorted(map(tuple, TB.read_metrics(spark, steps).fillna({"step": -1}).collect())) == [
        ("r1", "auc", 1, 0.5), ("r1", "auc", 3, 0.7), ("r1", "best", -1, 0.7)]
    with pytest.raises(RuntimeError):
        TB.save_model(spark, None, root, {}, {})
    with pytest.raises(FileNotFoundError):
        TB.load_model(spark, fresh_dir(spark, "nomodel"))


def test_metrics_of_merged_appends_equal_those_of_all_rows(spark):
    rows = [("a", i % 3 == 0, (i * 37 % 101) / 100) for i in range(600)] + [("b", i % 2 == 0, (i * 53 % 97) / 96) for i in range(400)]
    rows += [("b", True, None), ("c", True, 0.5)]
    df = spark.createDataFrame([(m, int(y), s) for m, y, s in rows], "model string, label int, score double")
    root = fresh_dir(spark, "scores")
    for i in range(3):
        TB.append_scores(spark, df.where(F.abs(F.hash("score", "label")) % 3 == i), root)
    merged = TB.read_scores(spark, root)
    one = M.evaluate_state(merged, ["model"]).orderBy("model").collect()
    two = M.evaluate(df, group_cols=["model"]).drop("run_name").orderBy("model").collect()
    for a, b in zip(one, two, strict=True):
        assert a["model"] == b["model"] and list(a)[1:] == pytest.approx(list(b)[1:], rel=1e-12)


def test_evaluate_equals_its_parts_and_takes_no_rows(spark):
    df = spark.createDataFrame([(int(i % 7 < 3), ((i * 7919) % 1001) / 1000) for i in range(3000)], "label int, score double")
    got = M.evaluate(df).first()
    p = M.prepared(df)
    st, sw = M.score_table(p), M.sweep_table(p)
    assert got["roc_auc"] == pytest.approx(M.roc_auc(st).first()[0], rel=1e-12)
    assert got["average_precision"] == pytest.approx(M.average_precision(st).first()[0], rel=1e-12)
    best, punzi = M.best_threshold(M.threshold_sweep(sw)).first(), M.best_punzi(M.punzi_fom(sw)).first()
    assert [got[c] for c in best.asDict()] == list(best) and [got[c] for c in punzi.asDict()] == list(punzi)
    assert got["calibration_ece"] == pytest.approx(M.calibration_ece(p).first()[0], rel=1e-9)
    none = M.evaluate(df.limit(0)).collect()
    assert len(none) == 1 and none[0]["roc_auc"] == 0.5 and none[0]["n_signal"] == 0 and none[0]["best_threshold"] == 0.0
    plan = M.evaluate(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in M.evaluate(df)._jdf.queryExecution().executedPlan().toString()


def _fold(aucs, delta):
    prod, n, at = None, 0, None
    for i, a in enumerate(aucs):
        if prod is None or a - prod >= delta:
            prod, n, at = a, n + 1, i
    return at, prod, n


def test_promotion_chain_equals_the_fold(spark):
    """Very many runs of one model: rising slowly, with values just at the margin; small models beside it."""
    import random
    rnd = random.Random(5)
    long = [0.5 + i * 4e-6 + rnd.random() * 0.002 for i in range(100_000)]
    exact = [0.1 + 0.005 * i for i in range(60)] + [0.3 + 0.0025 * i for i in range(90)]
    tiny = [0.0, 0.004, 0.005, 0.0049999999999999996, 0.01, 0.3, 0.1]
    none = [None, 0.001, 0.2]
    models = {"long": long, "exact": exact, "tiny": tiny, "none": none, "one": [0.7], "down": [0.9, 0.5, 0.904, 0.91]}
    t0 = dt.datetime(2024, 1, 1)
    rows = [(m, f"{m}-{i}", t0 + dt.timedelta(seconds=i // 3), a) for m, v in models.items() for i, a in enumerate(v)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "model_name string, run_id string, registered_at timestamp, val_auc double")
    order = {m: sorted(range(len(v)), key=lambda i, m=m: (i // 3, f"{m}-{i}")) for m, v in models.items()}
    want = {}
    for m, v in models.items():
        at, prod, n = _fold([v[i] or 0.0 for i in order[m]], R.PROMOTION_AUC_DELTA)
        want[m] = (f"{m}-{order[m][at]}", prod, n)
    got = {r["model_name"]: (r["production_run_id"], r["production_val_auc"], r["n_promotions"])
           for r in R.promotion_fold(df, most=50_000).collect()}
    assert got == want
    small = df.where("model_name <> 'long'")
    assert {r["model_name"]: tuple(r)[1:] for r in R.promotion_fold(small).collect()} == {m: w for m, w in want.items() if m != "long"}
