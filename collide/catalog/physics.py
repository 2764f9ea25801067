"""Queries for kinematics (M1-M10), derived features (D1-D7), projections
(P1-P15) and cuts (F1-F10).  Kinematic outputs are rounded to 3 decimals
on both sides (engines differ in the last ulp of trig functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide import schema as S
from collide.catalog import query
from collide.catalog.sqlkit import (r3, s_dphi, s_dr, s_e, s_ht, s_mt, s_r3, s_r3f)
from collide.functions import kinematics as K
from collide.operators import cuts as C
from collide.operators import features as D
from collide.operators import project as P

ALL = ["collisions"]


def _coll(spark, sf):
    return FX.collisions(spark, sf)


# ---------------------------------------------------------------- D1-D7
_DERIVED_SQL = FX.oracle(ALL, f"""
select event_id,
  {s_r3f(s_mt('lepton_pt', 'lepton_phi', 'missing_energy_magnitude', 'missing_energy_phi'))} as transverse_mass_lv,
  {s_r3f(s_dr('lepton_eta', 'lepton_phi', 'jet1_eta', 'jet1_phi'))} as delta_r_lepton_jet1,
  case when jet2_pt = 0e0 then null else {s_r3f(s_dr('jet1_eta', 'jet1_phi', 'jet2_eta', 'jet2_phi'))} end as delta_r_jet1_jet2,
  {s_r3f(s_dphi('lepton_phi', 'missing_energy_phi'))} as delta_phi_lepton_met,
  round(ht, 3) as ht,
  {s_r3f('missing_energy_magnitude / sqrt(greatest(ht, 1e0))')} as met_significance,
  {s_r3f('ht / greatest(ht + lepton_pt + missing_energy_magnitude, 1e-10)')} as centrality
from (select *, cast(cast({s_ht('jet1_pt', 'jet2_pt', 'jet3_pt', 'jet4_pt')} as float) as double) as ht from collisions) t
""")


@query("derived_features", _DERIVED_SQL)
def derived_features(spark, sf):
    """The seven derived columns of the feature builder."""
    d = D.derived(_coll(spark, sf))
    return d.select("event_id", *[r3(c).alias(c) for c in S.DERIVED])


@query("masked_delta_r", FX.oracle(ALL, f"""
select event_id, jet2_pt = 0e0 as jet2_padded,
  case when jet2_pt = 0e0 then null else {s_r3f(s_dr('jet1_eta', 'jet1_phi', 'jet2_eta', 'jet2_phi'))} end as delta_r_jet1_jet2
from collisions"""))
def masked_delta_r(spark, sf):
    """D3: delta R(jet1, jet2), missing where jet2 is zero-padded."""
    d = D.derived(_coll(spark, sf))
    return d.select("event_id", (F.col("jet2_pt") == 0.0).alias("jet2_padded"),
                    r3("delta_r_jet1_jet2").alias("delta_r_jet1_jet2"))


# ---------------------------------------------------------------- M1-M10
@query("four_vector", FX.oracle(ALL, f"""
select event_id,
  {s_r3('lepton_pt*cos(lepton_phi)')} as px, {s_r3('lepton_pt*sin(lepton_phi)')} as py,
  {s_r3('lepton_pt*sinh(lepton_eta)')} as pz, {s_r3(s_e('lepton_pt', 'lepton_eta', 'lepton_phi', '0.106e0'))} as e
from collisions"""))
def four_vector(spark, sf):
    """M1: lepton (px, py, pz, E) with mass 0.106, DOUBLE."""
    v = K.four_vector("lepton_pt", "lepton_eta", "lepton_phi", S.LEPTON_MASS)
    return _coll(spark, sf).select("event_id", r3(v["px"]).alias("px"), r3(v["py"]).alias("py"),
                                   r3(v["pz"]).alias("pz"), r3(v["E"]).alias("e"))


def _s_minv(a, b):
    (pt1, eta1, phi1, m1), (pt2, eta2, phi2, m2) = a, b
    e = f"({s_e(pt1, eta1, phi1, m1)} + {s_e(pt2, eta2, phi2, m2)})"
    px = f"({pt1}*cos({phi1}) + {pt2}*cos({phi2}))"
    py = f"({pt1}*sin({phi1}) + {pt2}*sin({phi2}))"
    pz = f"({pt1}*sinh({eta1}) + {pt2}*sinh({eta2}))"
    return f"sqrt(greatest(pow({e}, 2) - pow({px}, 2) - pow({py}, 2) - pow({pz}, 2), 0e0))"


_LEP = ("lepton_pt", "lepton_eta", "lepton_phi", "0.106e0")
_J = {i: (f"jet{i}_pt", f"jet{i}_eta", f"jet{i}_phi", "0e0") for i in range(1, 5)}


@query("invariant_mass", FX.oracle(ALL, f"""
select event_id, {s_r3f(_s_minv(_LEP, _J[1]))} as m_lep_j1, {s_r3f(_s_minv(_J[1], _J[2]))} as m_j1_j2
from collisions"""))
def invariant_mass(spark, sf):
    """M2: two-body invariant masses (lepton, jet1) and (jet1, jet2)."""
    m1 = K.invariant_mass("lepton_pt", "lepton_eta", "lepton_phi", S.LEPTON_MASS,
                          "jet1_pt", "jet1_eta", "jet1_phi", S.JET_MASS)
    m2 = K.invariant_mass("jet1_pt", "jet1_eta", "jet1_phi", 0.0, "jet2_pt", "jet2_eta", "jet2_phi", 0.0)
    return _coll(spark, sf).select("event_id", r3(m1).alias("m_lep_j1"), r3(m2).alias("m_j1_j2"))


@query("delta_r", FX.oracle(ALL, f"""
select event_id, {s_r3f(s_dr('lepton_eta', 'lepton_phi', 'jet1_eta', 'jet1_phi'))} as dr_lep_j1,
  {s_r3f(s_dr('jet2_eta', 'jet2_phi', 'jet3_eta', 'jet3_phi'))} as dr_j2_j3,
  {s_r3f(s_dr('lepton_eta', 'lepton_phi', '0e0', 'missing_energy_phi'))} as dr_lep_met
from collisions"""))
def delta_r(spark, sf):
    """M3: angular separations with one phi wrap."""
    return _coll(spark, sf).select(
        "event_id", r3(K.delta_r("lepton_eta", "lepton_phi", "jet1_eta", "jet1_phi")).alias("dr_lep_j1"),
        r3(K.delta_r("jet2_eta", "jet2_phi", "jet3_eta", "jet3_phi")).alias("dr_j2_j3"),
        r3(K.delta_r("lepton_eta", "lepton_phi", 0.0, "missing_energy_phi")).alias("dr_lep_met"))


@query("transverse_mass", FX.oracle(ALL, f"""
select event_id, {s_r3f(s_mt('lepton_pt', 'lepton_phi', 'missing_energy_magnitude', 'missing_energy_phi'))} as mt_lep,
  {s_r3f(s_mt('jet1_pt', 'jet1_phi', 'missing_energy_magnitude', 'missing_energy_phi'))} as mt_j1
from collisions"""))
def transverse_mass(spark, sf):
    """M4: transverse masses of (lepton, MET) and (jet1, MET)."""
    return _coll(spark, sf).select(
        "event_id",
        r3(K.transverse_mass("lepton_pt", "lepton_phi", "missing_energy_magnitude", "missing_energy_phi")).alias("mt_lep"),
        r3(K.transverse_mass("jet1_pt", "jet1_phi", "missing_energy_magnitude", "missing_energy_phi")).alias("mt_j1"))


@query("rapidity", FX.oracle(ALL, f"""
select event_id,
  {s_r3f("0.5e0 * ln(greatest(e + pz, 1e-10) / greatest(e - pz, 1e-10))")} as y_lep,
  {s_r3f("0.5e0 * ln(greatest(lepton_pt + pz, 1e-10) / greatest(lepton_pt - pz, 1e-10))")} as y_clamped
from (select event_id, lepton_pt, {s_e('lepton_pt', 'lepton_eta', 'lepton_phi', '0.106e0')} as e,
             lepton_pt*sinh(lepton_eta) as pz from collisions) t"""))
def rapidity(spark, sf):
    """M5: lepton rapidity from its four-vector; and a clamped case (E := pt < |pz|)."""
    v = K.four_vector("lepton_pt", "lepton_eta", "lepton_phi", S.LEPTON_MASS)
    return _coll(spark, sf).select("event_id", r3(K.rapidity(v["E"], v["pz"])).alias("y_lep"),
                                   r3(K.rapidity("lepton_pt", v["pz"])).alias("y_clamped"))


@query("ht_scalar", FX.oracle(ALL, f"""
select event_id, {s_r3f(s_ht('jet1_pt', 'jet2_pt', 'jet3_pt', 'jet4_pt'))} as ht,
  {s_r3f(s_ht('jet1_eta', 'jet2_eta', 'jet3_eta', 'jet4_eta'))} as ht_signed,
  {s_r3f(s_ht('jet1_eta', 'jet2_eta', 'jet3_eta', 'jet4_eta'))} as ht_array
from collisions"""))
def ht_scalar(spark, sf):
    """M6: sum of max(x, 0) over columns, and the array form over a packed array."""
    etas = [S.jet(i, "eta") for i in range(1, 5)]
    return _coll(spark, sf).select(
        "event_id", r3(K.ht_scalar(*[S.jet(i, "pt") for i in range(1, 5)])).alias("ht"),
        r3(K.ht_scalar(*etas)).alias("ht_signed"),
        r3(K.ht_array(F.array(*[F.col(e) for e in etas]))).alias("ht_array"))


@query("centrality", FX.oracle(ALL, f"""
select event_id, {s_r3f(f"({s_ht('jet1_pt', 'jet2_pt', 'jet3_pt', 'jet4_pt')}) / greatest({' + '.join(s_e(*_J[i]) for i in range(1, 5))}, 1e-10)")} as centrality
from collisions"""))
def centrality(spark, sf):
    """M7: H_T over the summed jet energies (clamped at 1e-10; zero-jet events give 0)."""
    ht = F.lit(0.0)
    e = F.lit(0.0)
    for i in range(1, 5):
        ht = ht + F.greatest(F.col(S.jet(i, "pt")), F.lit(0.0))
        e = e + K.four_vector(S.jet(i, "pt"), S.jet(i, "eta"), S.jet(i, "phi"), 0.0)["E"]
    return _coll(spark, sf).select("event_id", r3(K.centrality(ht, e)).alias("centrality"))


@query("delta_phi", FX.oracle(ALL, f"""
select event_id, {s_r3f(s_dphi('lepton_phi', 'missing_energy_phi'))} as dphi_lep_met,
  {s_r3f(s_dphi('jet1_phi', 'jet2_phi'))} as dphi_j1_j2,
  {s_r3f(s_dphi('3e0 * lepton_phi', 'jet1_phi'))} as dphi_wide
from collisions"""))
def delta_phi(spark, sf):
    """M8: single-fold |delta phi|; the wide case (|d| up to 4pi) shows the fold is not a modulo."""
    return _coll(spark, sf).select(
        "event_id", r3(K.delta_phi("lepton_phi", "missing_energy_phi")).alias("dphi_lep_met"),
        r3(K.delta_phi("jet1_phi", "jet2_phi")).alias("dphi_j1_j2"),
        r3(K.delta_phi(F.col("lepton_phi") * 3.0, "jet1_phi")).alias("dphi_wide"))


@query("pseudorapidity", FX.oracle(ALL, f"""
select event_id,
  {s_r3f("-ln(tan(least(greatest(2e0 * atan(exp(-lepton_eta)), 1e-7), pi() - 1e-7) / 2e0))")} as eta_roundtrip,
  {s_r3f("-ln(tan(least(greatest(lepton_phi * 1.2e0 + 1.6e0, 1e-7), pi() - 1e-7) / 2e0))")} as eta_clipped
from collisions"""))
def pseudorapidity(spark, sf):
    """M9: eta from theta with clipping to [1e-7, pi - 1e-7]."""
    theta = 2.0 * F.atan(F.exp(-F.col("lepton_eta")))
    wide = F.col("lepton_phi") * 1.2 + 1.6
    return _coll(spark, sf).select("event_id", r3(K.pseudorapidity(theta)).alias("eta_roundtrip"),
                                   r3(K.pseudorapidity(wide)).alias("eta_clipped"))


@query("met_significance", FX.oracle(ALL, f"""
select event_id, {s_r3f(f"missing_energy_magnitude / sqrt(greatest({s_ht('jet1_pt', 'jet2_pt', 'jet3_pt', 'jet4_pt')}, 1e0))")} as met_sig,
  {s_r3f("missing_energy_magnitude / sqrt(greatest(jet4_pt, 1e0))")} as met_sig_floor
from collisions"""))
def met_significance(spark, sf):
    """MET / sqrt(max(H_T, 1)); jet4_pt is mostly 0, so the floor at 1.0 shows."""
    ht = F.lit(0.0)
    for i in range(1, 5):
        ht = ht + F.greatest(F.col(S.jet(i, "pt")), F.lit(0.0))
    return _coll(spark, sf).select(
        "event_id", r3(K.met_significance("missing_energy_magnitude", ht)).alias("met_sig"),
        r3(K.met_significance("missing_energy_magnitude", "jet4_pt")).alias("met_sig_floor"))


# ---------------------------------------------------------------- P1-P15
_FEAT_SQL = ", ".join(S.FEATURES)


@query("select_feature_set", FX.oracle(ALL, f"select event_id, label, {', '.join(S.LOW_LEVEL)} from collisions"))
def select_feature_set(spark, sf):
    """Label first, then the low_level set (pruned into the scan)."""
    return P.select_feature_set(_coll(spark, sf), "low_level")


@query("extract_low_level", FX.oracle(ALL, f"select {', '.join(S.LOW_LEVEL)} from collisions"))
def extract_low_level(spark, sf):
    """The 21 raw columns, no label."""
    return P.extract_low_level(_coll(spark, sf))


@query("extract_high_level", FX.oracle(ALL, f"select {', '.join(s_r3(m) + ' as ' + m for m in S.HIGH_LEVEL)} from collisions"))
def extract_high_level(spark, sf):
    """The 7 dataset masses."""
    return P.extract_high_level(_coll(spark, sf)).select(*[r3(m).alias(m) for m in S.HIGH_LEVEL])


@query("accessors", FX.oracle(ALL, "select event_id, lepton_pt, lepton_eta, lepton_phi, "
                                 "missing_energy_magnitude as met_magnitude, missing_energy_phi as met_phi, "
                              + ", ".join(f"jet{i}_{src} as jet{i}_{k}_f64" for i in range(1, 5)
                                          for k, src in (("pt", "pt"), ("eta", "eta"), ("phi", "phi"), ("btag", "b_tag")))
                              + " from collisions"))
def accessors(spark, sf):
    """P5: named accessors as DOUBLE."""
    return P.accessors(_coll(spark, sf))


@query("four_vector_struct", FX.oracle(ALL, """
select event_id, lepton_pt as lep_pt, lepton_eta as lep_eta, lepton_phi as lep_phi, 0.106e0 as lep_mass,
       jet1_pt as j1_pt, jet1_eta as j1_eta, jet1_phi as j1_phi, 0e0 as j1_mass from collisions"""))
def four_vector_struct(spark, sf):
    """Lepton and jet1 as struct(pt, eta, phi, mass), fields flattened."""
    d = _coll(spark, sf).select("event_id", P.lepton_four_vector().alias("lep"), P.jet_four_vector(1).alias("j1"))
    return d.select("event_id", *[F.col(f"{s}.{k}").alias(f"{s}_{k}") for s in ("lep", "j1")
                                  for k in ("pt", "eta", "phi", "mass")])


@query("pack_jet_pts", FX.oracle(ALL, "select event_id, jet1_pt as p1, jet2_pt as p2, jet3_pt as p3, jet4_pt as p4 from collisions"))
def pack_jet_pts(spark, sf):
    """array(jet1_pt..jet4_pt), elements flattened."""
    d = _coll(spark, sf).select("event_id", P.pack_jet_pts().alias("pts"))
    return d.select("event_id", *[F.col("pts")[i].alias(f"p{i + 1}") for i in range(4)])


def _ranked_sql(where: str = "true", key: str = "pt", value: str = "pt") -> str:
    """SQL: per-event collection members ranked like the ragged fixture (key desc, then rk)."""
    return (f"select event_id, row_number() over (partition by event_id order by {key} desc, rk) as pos, "
            f"cast({value} as float) as v from constituents where {where}")


@query("pad_truncate", FX.oracle(["base", "constituents"], f"""
select b.event_id, {', '.join(f"cast(coalesce(max(case when pos = {i + 1} then v end), 0e0) as double) as jet_pt_{i}" for i in range(6))}
from base b left join ({_ranked_sql()}) r on b.event_id = r.event_id
group by b.event_id"""))
def pad_truncate(spark, sf):
    """Ragged jet pt padded/truncated to 6 (0.0 fill); elements flattened."""
    d = FX.ragged(spark, sf).select("event_id", P.pad_truncate("Jet_pt", 6).alias("a"))
    return d.select("event_id", *[F.col("a")[i].alias(f"jet_pt_{i}") for i in range(6)])


def _flatten_sql() -> str:
    jets = _ranked_sql()
    jcols = []
    for j in range(1, 5):
        for feat, expr in (("pt", "pt"), ("eta", "eta"), ("phi", "phi"), ("mass", "mass"), ("b_tag", "b_tag / 2e0")):
            jcols.append(f"coalesce(max(case when pos = {j} then cast({expr} as float) end), cast(0 as float)) as jet{j}_{feat}")
    lep = []
    for name, flag in (("muon", "R"), ("electron", "A")):
        for feat in ("pt", "eta", "phi"):
            expr = "lep_pt" if feat == "pt" else feat
            lep.append(f"coalesce(max(case when flag = '{flag}' and lpos = 1 then cast({expr} as float) end), "
                       f"cast(0 as float)) as {name}_leading_{feat}_0")
    return FX.oracle(["base", "constituents"], f"""
select b.event_id, cast(b.missing_energy_magnitude as float) as met_pt, cast(b.missing_energy_phi as float) as met_phi,
  cast(coalesce(count(r.event_id), 0) as float) as n_jets,
  cast(coalesce(sum(case when flag = 'R' then 1 else 0 end), 0) as float) as n_muons,
  cast(coalesce(sum(case when flag = 'A' then 1 else 0 end), 0) as float) as n_electrons,
  {', '.join(jcols)}, {', '.join(lep)}
from base b left join (
  select *, row_number() over (partition by event_id order by pt desc, rk) as pos,
            row_number() over (partition by event_id, flag order by lep_pt desc, rk) as lpos
  from constituents) r on b.event_id = r.event_id
group by b.event_id, b.missing_energy_magnitude, b.missing_energy_phi""", )


@query("flatten_objects", _flatten_sql())
def flatten_objects(spark, sf):
    """P9 (+P1, P10): rename branches, keep scalars as FLOAT, fan out 4 jets and the leading leptons."""
    r = P.rename_branches(FX.ragged(spark, sf))
    return P.flatten_objects(r)


@query("rename_branches", FX.oracle(["base", "constituents"], """
select b.event_id, cast(coalesce(count(c.event_id), 0) as int) as n_jets,
       cast(coalesce(sum(case when flag = 'R' then 1 else 0 end), 0) as int) as n_muons,
       cast(coalesce(sum(case when flag = 'A' then 1 else 0 end), 0) as int) as n_electrons,
       cast(b.missing_energy_magnitude as float) as met_pt
from base b left join constituents c on b.event_id = c.event_id
group by b.event_id, b.missing_energy_magnitude"""))
def rename_branches(spark, sf):
    """Ragged source branches renamed to local names; counts and MET shown."""
    r = P.rename_branches(FX.ragged(spark, sf))
    return r.select("event_id", "n_jets", "n_muons", "n_electrons", "met_pt")


@query("scalar_branches", FX.oracle(["base", "constituents"], """
select b.event_id, cast(coalesce(sum(case when flag = 'R' then 1 else 0 end), 0) as float) as nMuon,
       cast(coalesce(sum(case when flag = 'A' then 1 else 0 end), 0) as float) as nElectron,
       cast(coalesce(count(c.event_id), 0) as float) as nJet,
       cast(b.missing_energy_magnitude as float) as MET_pt, cast(b.missing_energy_phi as float) as MET_phi
from base b left join constituents c on b.event_id = c.event_id
group by b.event_id, b.missing_energy_magnitude, b.missing_energy_phi"""))
def scalar_branches(spark, sf):
    """P10: scalar branches picked by schema type, as FLOAT; ragged ones skipped."""
    return P.scalar_branches(FX.ragged(spark, sf))


@query("particle_tokens", FX.oracle(ALL, "select event_id, particle, feature, value from ("
                                    + " union all ".join(
    f"select event_id, {i // 7} as particle, {i % 7} as feature, {s_r3(c) if c in S.HIGH_LEVEL else c} as value from collisions"
    for i, c in enumerate(S.LOW_LEVEL + S.HIGH_LEVEL[:7])) + ") t"))
def particle_tokens(spark, sf):
    """28 features -> 4 x 7 row-major tokens, as long rows (event, particle, feature, value)."""
    d = P.particle_tokens_frame(_coll(spark, sf).select("event_id", *S.FEATURES),
                                F.array(*[F.col(c) for c in S.FEATURES]), "tok").select("event_id", "tok")
    # one generator over the row-major token matrix (a nested generator re-evaluates the matrix)
    d = d.select("event_id", F.size(F.col("tok")[0]).alias("w"),
                 F.posexplode(F.flatten("tok")).alias("pos", "value"))
    return d.select("event_id", (F.col("pos") / F.col("w")).cast("int").alias("particle"),
                    (F.col("pos") % F.col("w")).cast("int").alias("feature"),
                    # computed masses (slots 21..27) differ in the last ulp between engines: round those only
                    F.when(F.col("pos") >= len(S.LOW_LEVEL), r3("value")).otherwise(F.col("value")).alias("value"))


@query("coerce_types", FX.oracle([], """
select o_orderkey as event_id, coalesce(try_cast(o_orderpriority as int), -1) as priority_int,
       try_cast(substr(o_orderpriority, 1, 1) as int) as priority_digit,
       cast(o_totalprice as float) as price_f32,
       cast((o_orderpriority is not null and try_cast(o_orderpriority as int) is null) as int)
       + cast((o_orderpriority is not null and try_cast(substr(o_orderpriority, 1, 1) as int) is null) as int) as n_failed
from orders"""))
def coerce_types(spark, sf):
    """try_cast with a count of values that failed to convert."""
    FX.register_raw(spark, sf, ("orders",))
    o = spark.table("orders").select(F.col("o_orderkey").alias("event_id"),
                                     F.col("o_orderpriority").alias("priority_int"),
                                     F.substring("o_orderpriority", 1, 1).alias("priority_digit"),
                                     F.col("o_totalprice").alias("price_f32"))
    out = P.coerce_types(o, {"priority_int": "int", "priority_digit": "int", "price_f32": "float"})
    return out.select("event_id", F.coalesce("priority_int", F.lit(-1)).alias("priority_int"),
                      "priority_digit", "price_f32",
                      F.col("__coerce_failed").alias("n_failed"))


@query("attach_label", FX.oracle(ALL, "select event_id, label, lepton_pt, jet1_pt from collisions"))
def attach_label(spark, sf):
    """Features and label stay in one row with their key (never aligned by position or join)."""
    return _coll(spark, sf).select("event_id", "label", "lepton_pt", "jet1_pt")


@query("feature_columns", FX.oracle(ALL, "select event_id, " + ", ".join(S.LOW_LEVEL) + ", "
                                    + ", ".join(s_r3(c) + " as " + c for c in S.HIGH_LEVEL) + ", "
                                    + f"{s_r3f(s_dphi('lepton_phi', 'missing_energy_phi'))} as delta_phi_lepton_met"
                                    + " from collisions"))
def feature_columns(spark, sf):
    """Ordered, de-duplicated list from the three switches applied as a projection."""
    d = D.derived(_coll(spark, sf))
    cols = D.feature_columns(S.LOW_LEVEL + S.HIGH_LEVEL + S.LOW_LEVEL + ["delta_phi_lepton_met", "label"])
    return d.select("event_id", *[r3(c).alias(c) if c not in S.LOW_LEVEL else F.col(c) for c in cols])


@query("feature_catalog", FX.oracle(ALL, ", d(feature, description) as (values " + ", ".join(
    f"('{c}', '{t}')" for c, t in S.DERIVED_DESCRIPTIONS.items()) + """),
n as (select count(*) as n, count(*) filter (where jet2_pt <> 0e0) as n2 from collisions)
select d.feature, d.description, case when d.feature = 'delta_r_jet1_jet2' then n.n2 else n.n end as n_present from d, n"""))
def feature_catalog(spark, sf):
    """Derived feature descriptions joined with per-feature non-missing counts from the data."""
    d = D.derived(_coll(spark, sf))
    counts = d.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v"))
                                         for c in S.DERIVED])))
    counts = counts.groupBy("feature").agg(F.count("v").alias("n_present"))
    return P.feature_catalog(spark).join(counts, "feature", "left")


# ---------------------------------------------------------------- F1-F10
@query("cut_lepton", FX.oracle(ALL, "select event_id from collisions where lepton_pt > 30e0"))
def cut_lepton(spark, sf):
    """lepton_pt > 30."""
    d = _coll(spark, sf)
    return d.filter(C.lepton_cut(d, 30.0)).select("event_id")


@query("cut_met", FX.oracle(ALL, "select event_id from collisions where missing_energy_magnitude > 150e0"))
def cut_met(spark, sf):
    """MET > 150."""
    d = _coll(spark, sf)
    return d.filter(C.met_cut(d, 150.0)).select("event_id")


@query("cut_zero_kinematics", FX.oracle(ALL, "select event_id, label from collisions "
                                        "where coalesce(lepton_pt, 0e0) + coalesce(jet1_pt, 0e0) > 0e0"))
def cut_zero_kinematics(spark, sf):
    """drop events with lepton_pt + jet1_pt <= 0."""
    d = _coll(spark, sf)
    return d.filter(C.zero_kinematics_cut(d)).select("event_id", "label")


_DET_SQL = FX.oracle(["base", "constituents"], """,
flat as (
  select b.event_id, cast(b.missing_energy_magnitude as float) as met_pt,
    coalesce(max(case when flag = 'R' and lpos = 1 then cast(lep_pt as float) end), 0) as mu0,
    coalesce(max(case when flag = 'A' and lpos = 1 then cast(lep_pt as float) end), 0) as el0,
    coalesce(sum(case when pos <= 4 and cast(pt as float) > 30 then 1 else 0 end), 0) as nj
  from base b left join (
    select *, row_number() over (partition by event_id order by pt desc, rk) as pos,
              row_number() over (partition by event_id, flag order by lep_pt desc, rk) as lpos
    from constituents) r on b.event_id = r.event_id
  group by b.event_id, b.missing_energy_magnitude)
select event_id from flat where mu0 > 25 and el0 > 25 and met_pt > 20 and nj >= 2""")


@query("detector_selection", _DET_SQL.replace("with ", "with ", 1))
def detector_selection(spark, sf):
    """muon > 25, electron > 25, MET > 20, >= 2 jets with pt > 30 (on flattened ragged events)."""
    flat = P.flatten_objects(P.rename_branches(FX.ragged(spark, sf)))
    return C.apply_cuts(flat, C.detector_selection(flat)).select("event_id")


@query("cut_flow", FX.oracle(ALL, """,
c as (select count(*) as n0,
        count(*) filter (where lepton_pt > 30e0) as n1,
        count(*) filter (where lepton_pt > 30e0 and missing_energy_magnitude > 50e0) as n2,
        count(*) filter (where lepton_pt > 30e0 and missing_energy_magnitude > 50e0
                         and coalesce(lepton_pt, 0e0) + coalesce(jet1_pt, 0e0) > 0e0) as n3
      from collisions)
select step, cut, cast(n_before as bigint) as n_before, cast(n_after as bigint) as n_after,
       case when n_before = 0 then null else n_after / n_before end as efficiency,
       case when n0 = 0 then null else n_after / n0 end as cumulative_efficiency
from (select 1 as step, 'lepton_pt' as cut, n0 as n_before, n1 as n_after, n0 from c
      union all select 2, 'met', n1, n2, n0 from c
      union all select 3, 'zero_kinematics', n2, n3, n0 from c) t"""))
def cut_flow(spark, sf):
    """cut flow of the ETL cuts (lepton > 30, MET > 50, zero kinematics) in one aggregate."""
    d = _coll(spark, sf)
    return C.cut_flow(d, C.quality_cuts(d, lepton_pt_min=30.0, met_min=50.0))


@query("n_jets_above", FX.oracle(ALL, "select event_id, "
                                 + " + ".join(f"cast(jet{i}_pt > 30e0 as int)" for i in range(1, 5))
                                 + " as n_jets_30, "
                                 + " + ".join(f"cast(jet{i}_pt > 50e0 as int)" for i in range(1, 5))
                                 + " as n_jets_50 from collisions"))
def n_jets_above(spark, sf):
    """jets above 30 (default) and 50."""
    return _coll(spark, sf).select("event_id", C.n_jets_above().alias("n_jets_30"),
                                   C.n_jets_above(50.0).alias("n_jets_50"))


@query("has_b_tag", FX.oracle(ALL, "select event_id, "
                              + " or ".join(f"jet{i}_b_tag > 0.5e0" for i in range(1, 5)) + " as has_b_tag, "
                              + " or ".join(f"jet{i}_b_tag > 1.5e0" for i in range(1, 5)) + " as has_b_tag_tight "
                              "from collisions"))
def has_b_tag(spark, sf):
    """any jet with b_tag > 0.5 (default) and > 1.5."""
    return _coll(spark, sf).select("event_id", C.has_b_tag().alias("has_b_tag"),
                                   C.has_b_tag(1.5).alias("has_b_tag_tight"))


@query("class_counts", FX.oracle(ALL, "select cast(count(*) filter (where label = 1) as bigint) as n_signal, "
                                 "cast(count(*) filter (where label = 0) as bigint) as n_background from collisions"))
def class_counts(spark, sf):
    """F8: signal / background counts."""
    return C.class_counts(_coll(spark, sf))


@query("rule_predicates", FX.oracle(ALL, """
select event_id, lepton_pt between 0e0 and 150e0 as pt_in_range, label in (0, 1) as label_ok,
       lepton_eta is not null and not isnan(lepton_eta) as eta_not_null,
       not (abs(m_wwbb) = 'inf'::double) as mass_not_inf
from collisions"""))
def rule_predicates(spark, sf):
    """in_range (inclusive), isin {0,1}, not null, not inf."""
    return _coll(spark, sf).select(
        "event_id", C.in_range("lepton_pt", 0.0, 150.0).alias("pt_in_range"),
        C.is_in("label", S.LABEL_VALUES).alias("label_ok"),
        C.not_null("lepton_eta").alias("eta_not_null"), C.not_inf("m_wwbb").alias("mass_not_inf"))


@query("predict_threshold", FX.oracle(["scored"], """
select event_id, cast(cast(cast(score as float) as double) >= 0.5e0 as int) as pred,
       cast(cast(cast(score as float) as double) >= 0.3e0 as int) as pred_03 from scored"""))
def predict_threshold(spark, sf):
    """0/1 decision at 0.5 (default) and 0.3 on FLOAT scores widened to DOUBLE."""
    s = FX.scored(spark, sf).withColumn("s32", F.col("score").cast("float"))
    return s.select("event_id", C.predict_threshold("s32").alias("pred"),
                    C.predict_threshold("s32", 0.3).alias("pred_03"))
