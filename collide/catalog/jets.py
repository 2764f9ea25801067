"""Queries for jet substructure and graphs.

Spark computes everything inside each jet's constituent array; the DuckDB
oracles use relational self-joins on (event_id, rk) instead, so the two
sides share no formulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide.catalog import query
from collide.operators import jets as J
from collide.operators import neighbours as NB

CV = ["constituents"]


def _jets(spark, sf):
    return FX.jets_array(spark, sf)


def _r(c, n=9):
    return (F.round(F.col(c), n) + F.lit(0.0)).alias(c)


def _s_dr(a: str, b: str) -> str:
    d = f"({a}.phi - {b}.phi)"
    return (f"sqrt(pow({a}.eta - {b}.eta, 2) + pow(case when {d} > pi() then {d} - 2e0*pi() "
            f"when {d} < -pi() then {d} + 2e0*pi() else {d} end, 2))")


def _tau_sql(n: int) -> str:
    return f"""tau{n} as (
  select m.event_id, case when sum(m.pt) * 0.4e0 < 1e-10 then null else sum(m.pt * m.mdr) / (sum(m.pt) * 0.4e0) end as tau{n}
  from (select c.event_id, c.rk, c.pt, min({_s_dr('c', 'a')}) as mdr
        from constituents c join ax a on c.event_id = a.event_id and a.ar <= {n}
        group by c.event_id, c.rk, c.pt) m
  group by m.event_id)"""


_AX = "ax as (select event_id, rk, eta, phi, row_number() over (partition by event_id order by pt desc, rk desc) as ar from constituents)"
_TAUS = f", {_AX}, {_tau_sql(1)}, {_tau_sql(2)}, {_tau_sql(3)}\n"


@query("n_subjettiness", FX.oracle(CV, _TAUS + """
select t1.event_id, round(tau1, 9) + 0e0 as tau1, round(tau2, 9) + 0e0 as tau2, round(tau3, 9) + 0e0 as tau3
from tau1 t1 join tau2 t2 on t1.event_id = t2.event_id join tau3 t3 on t1.event_id = t3.event_id"""))
def n_subjettiness(spark, sf):
    """tau1, tau2, tau3 with R = 0.4, beta = 1; axes = hardest constituents."""
    j = F.col("jet")
    d = _jets(spark, sf).select("event_id", J.n_subjettiness(j, 1).alias("tau1"),
                                J.n_subjettiness(j, 2).alias("tau2"), J.n_subjettiness(j, 3).alias("tau3"))
    return d.select("event_id", _r("tau1"), _r("tau2"), _r("tau3"))


@query("tau_ratio", FX.oracle(CV, _TAUS + """
select t1.event_id,
  round(case when tau1 is null or tau2 is null or tau1 < 1e-10 then null else tau2 / tau1 end, 9) + 0e0 as tau21,
  round(case when tau2 is null or tau3 is null or tau2 < 1e-10 then null else tau3 / tau2 end, 9) + 0e0 as tau32
from tau1 t1 join tau2 t2 on t1.event_id = t2.event_id join tau3 t3 on t1.event_id = t3.event_id"""))
def tau_ratio(spark, sf):
    """tau21 = tau2/tau1 and tau32 = tau3/tau2 (null when the denominator < 1e-10)."""
    d = J.substructure(_jets(spark, sf))
    return d.select("event_id", _r("tau21"), _r("tau32"))


@query("jet_mass", FX.oracle(CV, """
select event_id, round(sqrt(greatest(pow(sum(pt), 2) - (pow(sum(pt * cos(phi)), 2) + pow(sum(pt * sin(phi)), 2)
       + pow(sum(pt * sinh(eta)), 2)), 0e0)), 6) + 0e0 as jet_mass
from constituents group by event_id"""))
def jet_mass(spark, sf):
    """Constituent invariant mass with E = pt (so m^2 < 0 clamps to 0)."""
    d = _jets(spark, sf).select("event_id", J.jet_mass(J.with_energy(F.col("jet"))).alias("jet_mass"))
    return d.select("event_id", _r("jet_mass", 6))


@query("ecf2", FX.oracle(CV, f"""
select t.event_id, round(case when t.n < 2 or t.ptj < 1e-10 then null else coalesce(p.s, 0e0) / pow(t.ptj, 2) end, 9) + 0e0 as ecf2
from (select event_id, count(*) as n, sum(pt) as ptj from constituents group by event_id) t
left join (select a.event_id, sum(a.pt * b.pt * {_s_dr('a', 'b')}) as s
           from constituents a join constituents b on a.event_id = b.event_id and a.rk < b.rk group by a.event_id) p
  on t.event_id = p.event_id"""))
def ecf2(spark, sf):
    """e2 = sum_{i<j} pt_i pt_j dR_ij / pt_jet^2 (null for fewer than 2 constituents)."""
    return _jets(spark, sf).select("event_id", J.ecf(F.col("jet"), 2).alias("ecf2")).select("event_id", _r("ecf2"))


@query("ecf3", FX.oracle(CV, f"""
select t.event_id, round(case when t.n < 3 or t.ptj < 1e-10 then null else coalesce(p.s, 0e0) / pow(t.ptj, 3) end, 9) + 0e0 as ecf3
from (select event_id, count(*) as n, sum(pt) as ptj from constituents group by event_id) t
left join (select a.event_id, sum(a.pt * b.pt * c.pt * {_s_dr('a', 'b')} * {_s_dr('a', 'c')} * {_s_dr('b', 'c')}) as s
           from constituents a join constituents b on a.event_id = b.event_id and a.rk < b.rk
           join constituents c on a.event_id = c.event_id and b.rk < c.rk group by a.event_id) p
  on t.event_id = p.event_id"""))
def ecf3(spark, sf):
    """e3 over triples (null for fewer than 3 constituents); triples are summed in the row."""
    return _jets(spark, sf).select("event_id", J.ecf(F.col("jet"), 3).alias("ecf3")).select("event_id", _r("ecf3"))


@query("ecf_other", FX.oracle(CV, "select count(distinct event_id) as n_jets, cast(0 as bigint) as n_defined from constituents"))
def ecf_other(spark, sf):
    """N other than 2 or 3 is not defined: a null column (with N = 4 requested)."""
    d = _jets(spark, sf).select("event_id", J.ecf(F.col("jet"), 4).alias("ecf4"))
    return d.groupBy().agg(F.count(F.lit(1)).alias("n_jets"), F.count("ecf4").alias("n_defined"))


@query("substructure_unavailable", FX.oracle(["collisions"], "select event_id, "
                                            + ", ".join(f"cast(null as float) as {c}" for c in J.SUBSTRUCTURE)
                                            + " from collisions"))
def substructure_unavailable(spark, sf):
    """Events without constituent data get the eight columns as FLOAT nulls."""
    return J.substructure_unavailable(FX.collisions(spark, sf).select("event_id"))


@query("leading_constituents", FX.oracle(CV, """
select event_id, cast(ar - 1 as int) as pos, idx, pt from (
  select event_id, cast(rk - 1 as int) as idx, pt, row_number() over (partition by event_id order by pt desc, rk desc) as ar
  from constituents) t where ar <= 3"""))
def leading_constituents(spark, sf):
    """A5: the 3 hardest constituents of each jet (position, index, pt)."""
    d = _jets(spark, sf).select("event_id", F.posexplode(J.leading(F.col("jet"), 3)).alias("pos", "c"))
    return d.select("event_id", "pos", F.col("c.idx").alias("idx"), F.col("c.pt").alias("pt"))


@query("nearest_axis", FX.oracle(CV, f""", {_AX},
d as (select c.event_id, cast(c.rk - 1 as int) as idx, cast(a.ar - 1 as int) as axis, {_s_dr('c', 'a')} as dr
      from constituents c join ax a on c.event_id = a.event_id and a.ar <= 2),
r as (select *, row_number() over (partition by event_id, idx order by dr, axis) as k from d)
select event_id, idx, axis, round(dr, 9) + 0e0 as min_dr from r where k = 1"""))
def nearest_axis(spark, sf):
    """Each constituent's nearest of the 2 leading axes (min dR, axis id; ties by axis)."""
    d = J.nearest_axis(_jets(spark, sf), 2)
    return d.select("event_id", "idx", "axis", _r("min_dr"))


_KNN = """knn as (
  select a.event_id, cast(a.rk - 1 as int) as src, cast(b.rk - 1 as int) as dst,
         pow(a.eta - b.eta, 2) + pow(a.phi - b.phi, 2) as d2,
         row_number() over (partition by a.event_id, a.rk order by pow(a.eta - b.eta, 2) + pow(a.phi - b.phi, 2), b.rk) as rnk
  from constituents a join constituents b on a.event_id = b.event_id and a.rk <> b.rk)"""


@query("knn_edges", FX.oracle(CV, f", {_KNN}\nselect event_id, src, dst, cast(rnk as int) as rank, round(d2, 9) + 0e0 as d2 "
                               "from knn where rnk <= 3"))
def knn_edges(spark, sf):
    """3 nearest neighbours per constituent in (eta, phi), no self loop, no phi wrap."""
    d = J.knn_edges(_jets(spark, sf), 3)
    return d.select("event_id", "src", "dst", F.col("rank").cast("int").alias("rank"), _r("d2"))


@query("edge_features", FX.oracle(CV, f", {_KNN},\n" + """
nb as (select k.event_id, k.src, max(b.pt - a.pt) as mpt, max(b.eta - a.eta) as meta, max(b.phi - a.phi) as mphi
       from knn k join constituents a on k.event_id = a.event_id and k.src = a.rk - 1
       join constituents b on k.event_id = b.event_id and k.dst = b.rk - 1
       where k.rnk <= 3 group by k.event_id, k.src),
nodes as (select c.event_id, c.pt, c.eta, c.phi, coalesce(nb.mpt, 0e0) as mpt, coalesce(nb.meta, 0e0) as meta,
                 coalesce(nb.mphi, 0e0) as mphi
          from constituents c left join nb on c.event_id = nb.event_id and nb.src = c.rk - 1)
select event_id, round(avg(pt), 9) + 0e0 as mean_pt, round(avg(eta), 9) + 0e0 as mean_eta, round(avg(phi), 9) + 0e0 as mean_phi,
       round(avg(mpt), 9) + 0e0 as mean_max_d_pt, round(avg(meta), 9) + 0e0 as mean_max_d_eta,
       round(avg(mphi), 9) + 0e0 as mean_max_d_phi
from nodes group by event_id"""))
def edge_features(spark, sf):
    """Per node h_i and max over its 3 nearest neighbours of (h_j - h_i), averaged over the event's nodes."""
    d = J.edge_features(_jets(spark, sf), 3)
    return d.select("event_id", *[_r(c) for c in d.columns if c != "event_id"])


# 64 events read out together (pile-up): groups of some hundreds of nodes, each node numbered within its event.
_PILED = """piled as (
  select event_id // 64 as readout, event_id * 64 + rk as node, pt, eta, phi from constituents),
near as (
  select a.readout, a.node as src, b.node as dst, a.pt as apt, b.pt as bpt, a.eta as aeta, b.eta as beta, a.phi as aphi, b.phi as bphi,
         pow(a.eta - b.eta, 2) + pow(least(abs(a.phi - b.phi), 2e0 * pi() - abs(a.phi - b.phi)), 2) as d2
  from piled a join piled b on a.readout = b.readout and a.node <> b.node),
knn as (select * from (
  select *, row_number() over (partition by readout, src order by round(d2, 9), dst) as rnk from near) t where rnk <= 3)"""


def _piled(spark, sf):
    c = FX.constituents(spark, sf)
    return c.select(F.expr("event_id div 64").alias("readout"), (F.col("event_id") * 64 + F.col("rk")).alias("node"), "pt", "eta", "phi")


@query("knn_cells", FX.oracle(CV, f", {_PILED}\nselect readout, src, count(*) as n, round(sum(d2), 6) + 0e0 as d2_sum, "
                               "round(max(d2), 6) + 0e0 as d2_max from knn group by readout, src"))
def knn_cells(spark, sf):
    """N3 by grid cells: 3 nearest neighbours among 64 events read out together, phi around the circle."""
    e = NB.knn_cells(_piled(spark, sf), 3, key="readout", node="node", wrap=True)
    d = e.groupBy("readout", "src").agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("d2_sum"), F.max("d2").alias("d2_max"))
    return d.select("readout", "src", "n", _r("d2_sum", 6), _r("d2_max", 6))


@query("ecf3_spread", FX.oracle(CV, f"""
select t.event_id, round(case when t.n < 3 or t.ptj < 1e-10 then null else coalesce(p.s, 0e0) / pow(t.ptj, 3) end, 9) + 0e0 as ecf3
from (select event_id, count(*) as n, sum(pt) as ptj from constituents group by event_id) t
left join (select a.event_id, sum(a.pt * b.pt * c.pt * {_s_dr('a', 'b')} * {_s_dr('a', 'c')} * {_s_dr('b', 'c')}) as s
           from constituents a join constituents b on a.event_id = b.event_id and a.rk < b.rk
           join constituents c on a.event_id = c.event_id and b.rk < c.rk group by a.event_id) p
  on t.event_id = p.event_id"""))
def ecf3_spread(spark, sf):
    """J5 with the jets of more than four constituents summed by leading indices over several tasks."""
    return NB.ecf3_spread(_jets(spark, sf), large=4, triples=4).select("event_id", _r("ecf3"))
