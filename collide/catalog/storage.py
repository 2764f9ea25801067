"""Queries for scans, sinks, caches and versioned stores.

Sinks write into the shared folder (``spark.checkpoint.dir``); each query
writes the fixture data, reads it back through the source under test and
returns what it read, so the row check compares against the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide import schema as S
from collide.catalog import query
from collide.catalog.prepare import _ALL_SQL, _h_sql, _hash_split_sql
from collide.catalog.sqlkit import r3, s_r3, s_r3f
from collide.catalog.validation import _rules_sql
from collide.operators import prepare as T
from collide.operators import project as P
from collide.plans import etl as X
from collide.session import fresh_dir
from collide.sources import io as IO
from collide.sources import quarantine as Q
from collide.streaming import store as ST
from collide.streaming.rowlocal import file_source


_CUT_SQL = "(select * from collisions where coalesce(lepton_pt, 0e0) + coalesce(jet1_pt, 0e0) > 0e0) c"


def _coll(spark, sf):
    return FX.collisions(spark, sf)


_CSV_SQL = FX.oracle(["collisions"], "select event_id, label, " + ", ".join(
    f"cast({c} as float) as {c}" if c in S.LOW_LEVEL else f"{s_r3f(c)} as {c}" for c in S.FEATURES) + " from collisions")


def _read_back(df):
    """The columns of a scan; masses, which carry rounding noise of their own, to three decimals."""
    return df.select("event_id", "label", *[F.col(c) if c in S.LOW_LEVEL else r3(c).alias(c) for c in S.FEATURES])


@query("scan_csv", _CSV_SQL)
def scan_csv(spark, sf):
    """Collisions written as CSV with a header, re-read with the explicit schema (header detected)."""
    path = fresh_dir(spark, "csv")
    IO.write_events_csv(_coll(spark, sf).select("event_id", "label", *S.FEATURES), path)
    return _read_back(IO.read_events_csv(spark, path))


@query("scan_csv_gz", _CSV_SQL)
def scan_csv_gz(spark, sf):
    """The same as gzip CSV (not splittable), repartitioned right after the scan."""
    path = fresh_dir(spark, "csvgz")
    IO.write_events_csv(_coll(spark, sf).select("event_id", "label", *S.FEATURES), path, "gzip")
    return _read_back(IO.read_events_csv(spark, path, partitions=spark.sparkContext.defaultParallelism))


@query("limit_first_n", FX.oracle(["collisions"], "select event_id, label, lepton_pt from collisions order by event_id limit 1000"))
def limit_first_n(spark, sf):
    """S3: reproducible first 1000 events by event_id (TakeOrdered)."""
    return IO.first_n(_coll(spark, sf).select("event_id", "label", "lepton_pt"), 1000)


@query("cached_read", FX.oracle(["collisions"], f""", r as (
  select *, row_number() over (partition by label order by {_h_sql()}, event_id) as rk,
         count(*) over (partition by label) as n_c from collisions),
q as (select least(5000 / 2, coalesce(max(case when label = 1 then n_c end), 0)) as qs from r)
select event_id, label, {', '.join(S.LOW_LEVEL)} from r, q
where (label = 1 and rk <= qs) or (label = 0 and rk <= least(5000 - qs, n_c))"""))
def cached_read(spark, sf):
    """Read-through cache: a miss builds and writes, the second call hits; both return the same rows."""
    cache = fresh_dir(spark, "cache")
    params = {"path": sf, "n_samples": 5000, "seed": 42, "feature_set": "low_level", "dtype": "float32"}

    def build():
        return P.select_feature_set(T.balanced_sample(_coll(spark, sf), 5000, seed=42), "low_level")
    first, hit1 = IO.cached_read(spark, cache, build, **params)
    second, hit2 = IO.cached_read(spark, cache, build, **params)
    assert not hit1 and hit2, "cache must miss first and hit second"
    return second


@query("split_store", FX.oracle(["collisions"], f"""
select split, count(*) as n, avg(cast(label as double)) as signal_share from ({_hash_split_sql(_CUT_SQL)}) t group by split"""))
def split_store(spark, sf):
    """ETL output written partitioned by split under its config-hash version, metadata + latest last."""
    cfg = X.ETLConfig()
    out, scaler = X.etl(_coll(spark, sf), cfg, return_scaler=True)
    root = fresh_dir(spark, "splits")
    version = cfg.config_hash()
    IO.write_splits(spark, out, root, version, scaler, {"normalization": cfg.normalization})
    back = IO.read_split(spark, root, version)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("signal_share"))


@query("split_reload", FX.oracle(["collisions"], f""", d as ({_hash_split_sql(_CUT_SQL)}),
p as (select {', '.join(f'avg({c}) as c_{c}, case when stddev_pop({c}) = 0 then 1e0 else stddev_pop({c}) end as s_{c}' for c in S.FEATURES)}
      from d where split = 'train')
select d.event_id, d.split, d.label, {', '.join(f"{s_r3(f'(d.{c} - p.c_{c}) / p.s_{c}')} as {c}" for c in S.FEATURES)}
from d, p where d.split = 'val'"""))
def split_reload(spark, sf):
    """Version probe, then reload of one split (partition pruning) and the stored scaler."""
    cfg = X.ETLConfig()
    out, scaler = X.etl(_coll(spark, sf), cfg, return_scaler=True)
    root = fresh_dir(spark, "splits")
    version = cfg.config_hash()
    assert not IO.version_exists(spark, root, version)
    IO.write_splits(spark, out, root, version, scaler)
    assert IO.version_exists(spark, root, version)
    sc = IO.load_scaler(spark, root, version)
    assert sc is not None and sc.center == scaler.center
    back = IO.read_split(spark, root, version, "val")
    return back.select("event_id", "split", "label", *[r3(c).alias(c) for c in S.FEATURES])


@query("feature_store_load", f"select * from ({_ALL_SQL}) t where split = 'test'")
def feature_store_load(spark, sf):
    """Feature store built from the splits, loaded back as (X, y) of the test split (newest version)."""
    d = T.hash_split(_coll(spark, sf))
    root = fresh_dir(spark, "features")
    IO.build_feature_store(spark, d, root, "etlv1", "zero")
    v2 = IO.build_feature_store(spark, d, root, "etlv1", "median")
    assert IO.newest_version(spark, root) == v2
    try:
        IO.load_features(spark, root, "test", "does-not-exist")
        raise AssertionError("missing version must raise")
    except FileNotFoundError:
        pass
    x, y = IO.load_features(spark, root, "test")
    both = x.join(y, "event_id")
    return both.select("event_id", "split", "label", *[F.col(c) if c in S.LOW_LEVEL else r3(c).alias(c)
                                                       for c in S.FEATURES + S.DERIVED])


def _ragged_path(spark, sf):
    path = fresh_dir(spark, "ragged")
    FX.ragged(spark, sf).write.mode("overwrite").parquet(path)
    return path


@query("ragged_scan", FX.oracle(["base", "constituents"], """
select b.event_id, cast(count(c.event_id) as int) as n_jets,
       round(coalesce(sum(cast(cast(c.pt as float) as double)), 0e0), 3) + 0e0 as jet_pt_sum,
       cast(coalesce(sum(case when c.flag = 'R' then 1 else 0 end), 0) as int) as n_muons
from base b left join constituents c on b.event_id = c.event_id group by b.event_id"""))
def ragged_scan(spark, sf):
    """Ragged Parquet scan with a branch choice (pruned into the scan): counts and sums per event."""
    r = IO.read_ragged(spark, _ragged_path(spark, sf), ["Jet_pt", "Muon_pt"])
    return r.select("event_id", F.size("Jet_pt").alias("n_jets"),
                    (F.round(F.aggregate("Jet_pt", F.lit(0.0), lambda a, x: a + x.cast("double")), 3) + F.lit(0.0))
                    .alias("jet_pt_sum"), F.size("Muon_pt").alias("n_muons"))


# The branches of the ragged fixture in order.
_BRANCHES = ([("event_id", "bigint")] + [(f"{o}_{k}", "array<float>") if k else (f"n{o}", "int")
                                          for o in ("Muon", "Electron", "Jet")
                                          for k in ("pt", "eta", "phi", "mass", *(("btagDeepFlavB",) if o == "Jet" else ()), "")]
             + [("MET_pt", "float"), ("MET_phi", "float")])


@query("list_columns", "select * from (values " + ", ".join(
    f"('{n}', '{t}', {i})" for i, (n, t) in enumerate(_BRANCHES)) + ") as t(name, type, position)")
def list_columns(spark, sf):
    """The branches of the ragged source as (name, type, position)."""
    return P.list_columns(spark.read.parquet(_ragged_path(spark, sf)))


# The reasons of a row of ``dirty``, written apart from the Spark rule engine.
_REASONS_SQL = "coalesce(array_to_string(list_sort([" + ", ".join(
    f"case when {p} then '{c}:{r}' end" for c, r, p in _rules_sql("validator")) + "]), ','), '')"
_QUARANTINE_SQL = FX.oracle(["dirty"], f"""
select event_id, reasons = '' as good, reasons from (select event_id, {_REASONS_SQL} as reasons from dirty) t""")


def _verdicts(good, bad):
    """One row per event: which table it is in, and why."""
    return good.select("event_id", F.lit(True).alias("good"), F.lit("").alias("reasons")).unionByName(
        bad.select("event_id", F.lit(False).alias("good"), F.array_join(Q.REASONS, ",").alias("reasons")))


@query("quarantine_csv", _QUARANTINE_SQL)
def quarantine_csv(spark, sf):
    """The dirty events as CSV, scanned permissively and split into good rows and rows with reasons in one write."""
    path, base = fresh_dir(spark, "dirty-csv"), fresh_dir(spark, "quarantine")
    IO.write_events_csv(FX.view(spark, sf, "dirty").select("event_id", "label", *S.FEATURES), path)
    Q.write_judged(spark, Q.scan_permissive(spark, path), base)
    return _verdicts(Q.good_rows(spark, base), Q.bad_rows(spark, base))


@query("stream_store", _QUARANTINE_SQL)
def stream_store(spark, sf):
    """2.15: the dirty events as a stream of files into the store, batch by batch behind the row rules."""
    src, root, ckpt = (fresh_dir(spark, n) for n in ("store-src", "store", "store-ckpt"))
    stream = file_source(spark, FX.view(spark, sf, "dirty"), src)
    ST.start(stream, root, ckpt).awaitTermination()
    return _verdicts(ST.good(spark, root), ST.bad(spark, root))
