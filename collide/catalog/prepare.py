"""Queries for sampling, splitting, scaling (T1-T9), fills and the feature
matrix (D8, D9), summaries (A1, A2) and the ETL flow (X1, X4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide import schema as S
from collide.catalog import query
from collide.catalog.sqlkit import r3, s_dphi, s_dr, s_f32, s_ht, s_mt, s_r3, s_r3f
from collide.operators import features as D
from collide.operators import prepare as T
from collide.plans import etl as X

ALL = ["collisions"]
SEED = 42


def _coll(spark, sf):
    return FX.collisions(spark, sf)


def _h_sql(seed: int = SEED, key: str = "event_id") -> str:
    return f"('0x' || substr(md5('{seed}|' || cast({key} as varchar)), 1, 8))::bigint"


def _hash_split_sql(src: str = "collisions") -> str:
    u = f"(cast({_h_sql()} as double) / 4294967296e0)"
    return (f"select *, case when {u} < 0.7e0 then 'train' when {u} < {0.7 + 0.15!r}e0 then 'val' "
            f"else 'test' end as split from {src}")


# ---------------------------------------------------------------- T1-T3
@query("balanced_sample", FX.oracle(ALL, f""", r as (
  select event_id, label, row_number() over (partition by label order by {_h_sql()}, event_id) as rk,
         count(*) over (partition by label) as n_c from collisions),
q as (select least(5000 / 2, coalesce(max(case when label = 1 then n_c end), 0)) as qs from r)
select event_id, label from r, q
where (label = 1 and rk <= qs) or (label = 0 and rk <= least(5000 - qs, n_c))"""))
def balanced_sample(spark, sf):
    """5000 events, half signal (capped by availability), by hash rank; exact quotas."""
    return T.balanced_sample(_coll(spark, sf).select("event_id", "label"), 5000, seed=SEED)


_STRAT_SQL = FX.oracle(ALL, f""", r as (
  select event_id, label, row_number() over (partition by label order by {_h_sql()}, event_id) as rk,
         count(*) over (partition by label) as n from collisions),
c as (select *, cast(ceil(n * {0.15 + 0.15!r}e0) as bigint) as n_rest from r)
select event_id, label,
  case when rk <= n - n_rest then 'train'
       when rk <= n - cast(ceil(n_rest * {1.0 - 0.15 / (0.15 + 0.15)!r}e0) as bigint) then 'val'
       else 'test' end as split
from c""")


@query("stratified_split", _STRAT_SQL)
def stratified_split(spark, sf):
    """T2 (exact): stratified 70/15/15 by label, ranks from the two-level hash rank."""
    return T.stratified_split(_coll(spark, sf).select("event_id", "label"), seed=SEED)


@query("hash_split", FX.oracle(ALL, f"select event_id, split from ({_hash_split_sql()}) t"))
def hash_split(spark, sf):
    """T2 (default): hash-threshold split, row-local."""
    return T.hash_split(_coll(spark, sf), seed=SEED).select("event_id", "split")


@query("split_balance", FX.oracle(ALL, f"""
select split, cast(count(*) as bigint) as n, avg(cast(label as double)) as signal_share
from ({_hash_split_sql()}) t group by split"""))
def split_balance(spark, sf):
    """Signal share per split."""
    return T.split_balance(T.hash_split(_coll(spark, sf), seed=SEED))


@query("split_summary", FX.oracle(ALL, f"""
select cast(count(*) filter (where split = 'train') as bigint) as n_train,
       cast(count(*) filter (where split = 'val') as bigint) as n_val,
       cast(count(*) filter (where split = 'test') as bigint) as n_test, 28 as n_features
from ({_hash_split_sql()}) t"""))
def split_summary(spark, sf):
    """A2: n_train, n_val, n_test, n_features."""
    return T.split_summary(T.hash_split(_coll(spark, sf), seed=SEED), len(S.FEATURES))


# ---------------------------------------------------------------- T4-T9
def _scaled_sql(method: str, src_sql: str | None = None, cols=S.FEATURES) -> str:
    src = src_sql or _hash_split_sql()
    if method == "standard":
        stats = ", ".join(f"avg({c}) as c_{c}, case when stddev_pop({c}) = 0 then 1e0 else stddev_pop({c}) end as s_{c}"
                          for c in cols)
    elif method == "robust":
        stats = ", ".join(
            f"quantile_cont({c}, 0.5) as c_{c}, case when quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 "
            f"then 1e0 else quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) end as s_{c}" for c in cols)
    else:
        stats = ", ".join(f"min({c}) as c_{c}, case when max({c}) - min({c}) = 0 then 1e0 else max({c}) - min({c}) end as s_{c}"
                          for c in cols)
    scaled = ", ".join(f"{s_r3(f'(d.{c} - p.c_{c}) / p.s_{c}')} as {c}" for c in cols)
    return FX.oracle(ALL, f""", d as ({src}),
p as (select {stats} from d where split = 'train')
select d.event_id, d.split, d.label, {scaled} from d, p""")


def _scaled(spark, sf, method):
    d = T.hash_split(_coll(spark, sf), seed=SEED)
    model = T.fit_scaler(d.filter(F.col("split") == "train"), S.FEATURES, method)
    out = model.transform(d)
    return out.select("event_id", "split", "label", *[r3(c).alias(c) for c in S.FEATURES])


@query("scale_standard", _scaled_sql("standard"))
def scale_standard(spark, sf):
    """T4: (x - mean) / population std fitted on train, applied to all splits."""
    return _scaled(spark, sf, "standard")


@query("scale_robust", _scaled_sql("robust"))
def scale_robust(spark, sf):
    """T5: (x - median) / (q75 - q25), exact linear-interpolated quantiles on train."""
    return _scaled(spark, sf, "robust")


@query("scale_minmax", _scaled_sql("minmax"))
def scale_minmax(spark, sf):
    """(x - min) / (max - min) on train; constant column -> 0."""
    return _scaled(spark, sf, "minmax")


@query("scale_none", FX.oracle(ALL, f"select event_id, split, label, {', '.join(S.LOW_LEVEL)}, "
                               f"{', '.join(s_r3(c) + ' as ' + c for c in S.HIGH_LEVEL)} from ({_hash_split_sql()}) t"))
def scale_none(spark, sf):
    """No scaling; the label stays in its row (the positional mix-up cannot happen)."""
    d = T.hash_split(_coll(spark, sf), seed=SEED)
    out = T.fit_scaler(d, S.FEATURES, "none").transform(d)
    return out.select("event_id", "split", "label", *S.LOW_LEVEL, *[r3(c).alias(c) for c in S.HIGH_LEVEL])


@query("scale_check", FX.oracle(ALL, f""", d as ({_hash_split_sql()}),
p as (select {', '.join(f'avg({c}) as c_{c}, case when stddev_pop({c}) = 0 then 1e0 else stddev_pop({c}) end as s_{c}' for c in S.FEATURES)}
      from d where split = 'train'),
z as (select {', '.join(f'(d.{c} - p.c_{c}) / p.s_{c} as {c}' for c in S.FEATURES)} from d, p where d.split = 'train'),
m as (select {', '.join(f'avg({c}) as m_{c}, stddev_samp({c}) as sd_{c}' for c in S.FEATURES)} from z)
select {s_r3('least(' + ', '.join(f'm_{c}' for c in S.FEATURES) + ')')} as mean_min,
       {s_r3('greatest(' + ', '.join(f'm_{c}' for c in S.FEATURES) + ')')} as mean_max,
       {s_r3('least(' + ', '.join(f'sd_{c}' for c in S.FEATURES) + ')')} as std_min,
       {s_r3('greatest(' + ', '.join(f'sd_{c}' for c in S.FEATURES) + ')')} as std_max
from m"""))
def scale_check(spark, sf):
    """Range of means and sample stds of the standard-scaled train split."""
    d = T.hash_split(_coll(spark, sf), seed=SEED)
    train = d.filter(F.col("split") == "train")
    z = T.fit_scaler(train, S.FEATURES, "standard").transform(train)
    chk = T.scale_check(z, S.FEATURES)
    return chk.select(*[r3(c).alias(c) for c in chk.columns])


@query("class_weights", FX.oracle(ALL, """
select label, cast(count(*) as bigint) as n_class,
       sum(count(*)) over () / (count(*) over () * count(*)) as weight
from collisions group by label"""))
def class_weights(spark, sf):
    """Balanced class weights n / (n_classes * n_class)."""
    return T.class_weights(_coll(spark, sf))


# ---------------------------------------------------------------- D8, D9, A1
def _fill_sql(strategy: str) -> str:
    dr = s_dr('jet1_eta', 'jet1_phi', 'jet2_eta', 'jet2_phi')
    base = (f"select event_id, split, case when jet2_pt = 0e0 then null else cast({dr} as float) end as dr12, "
            f"cast(cast(jet4_pt as float) as double) as j4 from ({_hash_split_sql()}) t")
    if strategy == "zero":
        return FX.oracle(ALL, f"""select event_id, split, {s_r3f('coalesce(dr12, 0e0)')} as delta_r_jet1_jet2
from ({base}) b""")
    return FX.oracle(ALL, f""", b as ({base}),
m as (select split, median(cast(dr12 as double)) as med from b group by split)
select b.event_id, b.split, {s_r3f('coalesce(cast(b.dr12 as double), m.med)')} as delta_r_jet1_jet2
from b join m on b.split = m.split""")


def _filled(spark, sf, strategy):
    d = D.derived(T.hash_split(_coll(spark, sf), seed=SEED))
    f = D.fill(d.select("event_id", "split", "delta_r_jet1_jet2"), strategy, group_cols=("split",))
    return f.select("event_id", "split", r3("delta_r_jet1_jet2").alias("delta_r_jet1_jet2"))


@query("fill_median", _fill_sql("median"))
def fill_median(spark, sf):
    """Missing delta R(jet1, jet2) filled with the median of its own split."""
    return _filled(spark, sf, "median")


@query("fill_zero", _fill_sql("zero"))
def fill_zero(spark, sf):
    """Missing values filled with 0."""
    return _filled(spark, sf, "zero")


_DESCRIBE_SQL = FX.oracle(ALL, ", long as (" + " union all ".join(
    f"select '{c}' as feature, {c} as v from collisions" for c in S.FEATURES) + """)
select feature, cast(count(v) as bigint) as count, round(avg(v), 3) + 0e0 as mean, round(stddev_samp(v), 3) + 0e0 as std,
       round(min(v), 3) + 0e0 as min, round(quantile_cont(v, 0.25), 3) + 0e0 as q25, round(quantile_cont(v, 0.5), 3) + 0e0 as q50,
       round(quantile_cont(v, 0.75), 3) + 0e0 as q75, round(max(v), 3) + 0e0 as max
from long group by feature""")


@query("describe_features", _DESCRIBE_SQL)
def describe_features(spark, sf):
    """A1: count, mean, sample std, min, exact quartiles, max per feature (3 decimals), over all events."""
    return X.describe(_coll(spark, sf), S.FEATURES)


@query("label_balance", FX.oracle(ALL, """
select label, cast(count(*) as bigint) as n, count(*) / sum(count(*)) over () as share from collisions group by label"""))
def label_balance(spark, sf):
    """A1: label balance beside the description."""
    return X.label_balance(_coll(spark, sf))


# ---------------------------------------------------------------- X1, X4
_ETL_SQL = _scaled_sql("standard", _hash_split_sql(
    "(select * from collisions where coalesce(lepton_pt, 0e0) + coalesce(jet1_pt, 0e0) > 0e0) c"))


@query("etl_scaled", _ETL_SQL)
def etl_scaled(spark, sf):
    """X1 (flagship): read -> validation gate -> quality cuts -> hash split -> standard scaling."""
    out = X.etl(_coll(spark, sf), X.ETLConfig())
    return out.select("event_id", "split", "label", *[r3(c).alias(c) for c in S.FEATURES])


@query("etl_config_cuts", FX.oracle(ALL, """, c as (
  select count(*) as n0,
    count(*) filter (where lepton_pt > 30e0) as n1,
    count(*) filter (where lepton_pt > 30e0 and missing_energy_magnitude > 20e0) as n2,
    count(*) filter (where lepton_pt > 30e0 and missing_energy_magnitude > 20e0 and abs(lepton_eta) <= 2e0) as n3,
    count(*) filter (where lepton_pt > 30e0 and missing_energy_magnitude > 20e0 and abs(lepton_eta) <= 2e0
      and (cast(jet1_pt > 30e0 as int) + cast(jet2_pt > 30e0 as int) + cast(jet3_pt > 30e0 as int) + cast(jet4_pt > 30e0 as int)) >= 2) as n4,
    count(*) filter (where lepton_pt > 30e0 and missing_energy_magnitude > 20e0 and abs(lepton_eta) <= 2e0
      and (cast(jet1_pt > 30e0 as int) + cast(jet2_pt > 30e0 as int) + cast(jet3_pt > 30e0 as int) + cast(jet4_pt > 30e0 as int)) >= 2
      and coalesce(lepton_pt, 0e0) + coalesce(jet1_pt, 0e0) > 0e0) as n5
  from collisions)
select step, cut, cast(n_before as bigint) as n_before, cast(n_after as bigint) as n_after,
       case when n_before = 0 then null else n_after / n_before end as efficiency,
       case when n0 = 0 then null else n_after / n0 end as cumulative_efficiency
from (select 1 as step, 'lepton_pt' as cut, n0 as n_before, n1 as n_after, n0 from c
      union all select 2, 'met', n1, n2, n0 from c
      union all select 3, 'lepton_eta', n2, n3, n0 from c
      union all select 4, 'min_jets', n3, n4, n0 from c
      union all select 5, 'zero_kinematics', n4, n5, n0 from c) t"""))
def etl_config_cuts(spark, sf):
    """ETL settings from a nested config; the optional cuts (lepton_eta_max, min_jets, jet_pt_min) as a cut flow."""
    cfg = X.ETLConfig.from_dict({"quality_cuts": {"lepton_pt_min": 30.0, "met_min": 20.0, "lepton_eta_max": 2.0,
                                                  "min_jets": 2, "jet_pt_min": 30.0}})
    return X.cut_flow_for(_coll(spark, sf), cfg)


@query("feature_matrix", FX.oracle(ALL, f""", d as ({_hash_split_sql()}),
dd as (select *, case when jet2_pt = 0e0 then null else cast({s_dr('jet1_eta', 'jet1_phi', 'jet2_eta', 'jet2_phi')} as float) end as dr12,
       cast({' + '.join(f'greatest(jet{i}_pt, 0e0)' for i in range(1, 5))} as float) as ht_f from d),
m as (select split, median(cast(dr12 as double)) as med from dd group by split)
select dd.event_id, dd.split, dd.label, {', '.join(c for c in S.LOW_LEVEL)},
  {', '.join(s_r3(c) + ' as ' + c for c in S.HIGH_LEVEL)},
  {s_r3f('coalesce(cast(dd.dr12 as double), m.med)')} as delta_r_jet1_jet2,
  round(cast(ht_f as double), 3) + 0e0 as ht
from dd join m on dd.split = m.split"""))
def feature_matrix(spark, sf):
    """Derive -> fill per split (median) -> ordered feature columns, one plan for all splits."""
    d = T.hash_split(_coll(spark, sf), seed=SEED)
    fm = D.feature_matrix(d, "median")
    keep = S.LOW_LEVEL + S.HIGH_LEVEL + ["delta_r_jet1_jet2", "ht"]
    return fm.select("event_id", "split", "label",
                     *[F.col(c) if c in S.LOW_LEVEL else r3(c).alias(c) for c in keep])


_ALL_SQL = FX.oracle(ALL, f""", d as ({_hash_split_sql()}),
h as (select *, {s_f32(s_ht('jet1_pt', 'jet2_pt', 'jet3_pt', 'jet4_pt'))} as ht64 from d),
dd as (select *,
  cast({s_mt('lepton_pt', 'lepton_phi', 'missing_energy_magnitude', 'missing_energy_phi')} as float) as transverse_mass_lv,
  cast({s_dr('lepton_eta', 'lepton_phi', 'jet1_eta', 'jet1_phi')} as float) as delta_r_lepton_jet1,
  case when jet2_pt = 0e0 then null else cast({s_dr('jet1_eta', 'jet1_phi', 'jet2_eta', 'jet2_phi')} as float) end as delta_r_jet1_jet2,
  cast({s_dphi('lepton_phi', 'missing_energy_phi')} as float) as delta_phi_lepton_met,
  cast(ht64 as float) as ht,
  cast(missing_energy_magnitude / sqrt(greatest(ht64, 1e0)) as float) as met_significance,
  cast(ht64 / greatest(ht64 + lepton_pt + missing_energy_magnitude, 1e-10) as float) as centrality from h),
m as (select split, {', '.join(f'median(cast({c} as double)) as med_{c}' for c in S.FEATURES + S.DERIVED)} from dd group by split)
select dd.event_id, dd.split, dd.label,
  {', '.join(f'{s_r3f(f"coalesce(cast(dd.{c} as double), m.med_{c})") if c in S.DERIVED else s_r3(f"coalesce(dd.{c}, m.med_{c})") if c in S.HIGH_LEVEL else f"coalesce(dd.{c}, m.med_{c})"} as {c}' for c in S.FEATURES + S.DERIVED)}
from dd join m on dd.split = m.split""")


@query("feature_matrix_all", _ALL_SQL)
def feature_matrix_all(spark, sf):
    """The feature matrix with every column: 28 of the dataset and the seven derived ones."""
    fm = D.feature_matrix(T.hash_split(_coll(spark, sf), seed=SEED), "median")
    return fm.select("event_id", "split", "label", *[F.col(c) if c in S.LOW_LEVEL else r3(c).alias(c) for c in fm.columns
                                                     if c not in ("event_id", "split", "label")])
