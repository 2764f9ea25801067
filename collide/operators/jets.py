"""Jet substructure, nearest axes, kNN graphs and edge features.

Input: one row per jet with ``jet ARRAY<STRUCT<pt, eta, phi, E>>`` (the
constituents, E defaults to pt).  Everything is computed inside the row
with array higher-order functions (``transform``, ``aggregate``,
``array_sort``, ``slice``): pair and triple sums are accumulated, never
materialised, and nothing is shuffled.  Only per-node outputs (one row per
constituent, or k edges per node) are ever exploded.

Missing results are null (the reference's NaN): empty jet, d0 < 1e-10,
fewer than N constituents for ECF_N.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PI = math.pi


def _dr(a: Column, b: Column) -> Column:
    """delta R between two constituent structs; phi wrapped once (if / else-if)."""
    deta = a["eta"] - b["eta"]
    d = a["phi"] - b["phi"]
    dphi = F.when(d > F.lit(PI), d - F.lit(2 * PI)).when(d < F.lit(-PI), d + F.lit(2 * PI)).otherwise(d)
    return F.sqrt(deta * deta + dphi * dphi)


def _pow(x: Column, beta: float) -> Column:
    return x if beta == 1.0 else F.pow(x, F.lit(float(beta)))


def _bound(value: Column, f) -> Column:
    """f(value) with ``value`` worked out once per row: a lambda variable is bound, whereas a column
    used inside a lambda is computed again at every step of the loop."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def with_energy(jet: Column) -> Column:
    """Fill E with pt where it is missing (the reference's default)."""
    return F.transform(jet, lambda x: F.struct(x["pt"].alias("pt"), x["eta"].alias("eta"), x["phi"].alias("phi"),
                                               F.coalesce(x["E"], x["pt"]).alias("E")))


def pt_sum(jet: Column) -> Column:
    return F.aggregate(jet, F.lit(0.0), lambda acc, x: acc + x["pt"])


def leading(jet: Column, n: int) -> Column:
    """A5: the n hardest constituents (pt desc; ties: the later index first, as a stable
    ascending sort read from the end does)."""
    keyed = F.transform(jet, lambda x, i: F.struct((-x["pt"]).alias("k"), (-i).alias("ki"), x["pt"].alias("pt"),
                                                   x["eta"].alias("eta"), x["phi"].alias("phi"), i.alias("idx")))
    return F.slice(F.array_sort(keyed), 1, n)


def n_subjettiness(jet: Column, n: int, r: float = 0.4, beta: float = 1.0) -> Column:
    """tau_N = sum_i pt_i min_k dR(i, axis_k)^beta / (sum_i pt_i * R^beta); axes = N hardest."""
    d0 = pt_sum(jet) * F.lit(float(r) ** beta)
    num = _bound(leading(jet, n), lambda axes: F.aggregate(jet, F.lit(0.0), lambda acc, x: acc + x["pt"] * _pow(
        F.array_min(F.transform(axes, lambda a: _dr(x, a))), beta)))
    empty = jet.isNull() | (F.size(jet) == 0)
    return F.when(empty | (d0 < F.lit(1e-10)), F.lit(None).cast("double")).otherwise(num / d0)


def tau_ratio(tau_n1: Column, tau_n2: Column) -> Column:
    """tau_N2 / tau_N1; null if either is null or tau_N1 < 1e-10."""
    return F.when(tau_n1.isNull() | tau_n2.isNull() | (tau_n1 < F.lit(1e-10)), F.lit(None).cast("double")) \
        .otherwise(tau_n2 / tau_n1)


def jet_mass(jet: Column) -> Column:
    """sqrt(max(E^2 - |p|^2, 0)) from the constituents' given E; null if empty."""
    e = F.aggregate(jet, F.lit(0.0), lambda acc, x: acc + x["E"])
    px = F.aggregate(jet, F.lit(0.0), lambda acc, x: acc + x["pt"] * F.cos(x["phi"]))
    py = F.aggregate(jet, F.lit(0.0), lambda acc, x: acc + x["pt"] * F.sin(x["phi"]))
    pz = F.aggregate(jet, F.lit(0.0), lambda acc, x: acc + x["pt"] * F.sinh(x["eta"]))
    m = F.sqrt(F.greatest(e * e - (px * px + py * py + pz * pz), F.lit(0.0)))
    return F.when(jet.isNull() | (F.size(jet) == 0), F.lit(None).cast("double")).otherwise(m)


def _indexed(jet: Column) -> Column:
    return F.transform(jet, lambda x, i: F.struct(x["pt"].alias("pt"), x["eta"].alias("eta"),
                                                  x["phi"].alias("phi"), i.alias("i")))


def _after(js: Column, x: Column) -> Column:
    return F.slice(js, x["i"] + 2, F.greatest(F.size(js) - x["i"] - 1, F.lit(0)))


def ecf3_sum(jet: Column, beta: float = 1.0, leads=None) -> Column:
    """The sum over triples i < j < k of J5, of the leading indices i for which ``leads(i)`` holds (None: all)."""
    def triples(js: Column) -> Column:
        chosen = js if leads is None else F.filter(js, lambda x: leads(x["i"]))
        return F.aggregate(chosen, F.lit(0.0), lambda acc, x: acc + F.aggregate(
            _after(js, x), F.lit(0.0), lambda a2, y: a2 + F.aggregate(
                _after(js, y), F.lit(0.0), lambda a3, z: a3 + x["pt"] * y["pt"] * z["pt"]
                * _pow(_dr(x, y) * _dr(x, z) * _dr(y, z), beta))))
    return _bound(_indexed(jet), triples)


def ecf(jet: Column, n: int = 2, beta: float = 1.0) -> Column:
    """Energy correlation function e_N for N = 2, 3 (null otherwise).

    e2 = sum_{i<j} pt_i pt_j dR_ij^beta / pt_jet^2;
    e3 = sum_{i<j<k} pt_i pt_j pt_k (dR_ij dR_ik dR_jk)^beta / pt_jet^3.
    Later partners are taken with ``slice`` so each pair / triple is visited once.
    """
    if n not in (2, 3):
        return F.lit(None).cast("double")
    size = F.size(jet)
    pt_jet = pt_sum(jet)

    def pairs(js: Column) -> Column:
        return F.aggregate(js, F.lit(0.0), lambda acc, x: acc + F.aggregate(
            _after(js, x), F.lit(0.0), lambda a2, y: a2 + x["pt"] * y["pt"] * _pow(_dr(x, y), beta)))
    total = _bound(_indexed(jet), pairs) if n == 2 else ecf3_sum(jet, beta)
    norm = pt_jet * pt_jet if n == 2 else pt_jet * pt_jet * pt_jet
    bad = jet.isNull() | (size < F.lit(n)) | (pt_jet < F.lit(1e-10))
    return F.when(bad, F.lit(None).cast("double")).otherwise(total / norm)


SUBSTRUCTURE = ["tau1", "tau2", "tau21", "tau3", "tau32", "jet_mass_j1", "ecf2", "ecf3"]


def substructure(df: DataFrame, jet_col: str = "jet", r: float = 0.4, beta: float = 1.0) -> DataFrame:
    """J1-J5 for every jet row in one projection."""
    j = F.col(jet_col)
    d = df.withColumns({"tau1": n_subjettiness(j, 1, r, beta), "tau2": n_subjettiness(j, 2, r, beta),
                        "tau3": n_subjettiness(j, 3, r, beta)})
    return d.withColumns({"tau21": tau_ratio(F.col("tau1"), F.col("tau2")),
                          "tau32": tau_ratio(F.col("tau2"), F.col("tau3")),
                          "jet_mass_j1": jet_mass(with_energy(j)),
                          "ecf2": ecf(j, 2, beta), "ecf3": ecf(j, 3, beta)})


def substructure_unavailable(df: DataFrame) -> DataFrame:
    """Without constituents, the eight substructure columns as FLOAT nulls."""
    return df.withColumns({c: F.lit(None).cast("float") for c in SUBSTRUCTURE})


def nearest_axis(df: DataFrame, n: int = 2, jet_col: str = "jet", key: str = "event_id") -> DataFrame:
    """For every constituent, the nearest of the N leading axes (min dR, and which axis)."""
    j = F.col(jet_col)
    per = _bound(leading(j, n), lambda axes: F.transform(_indexed(j), lambda x: F.struct(
        x["i"].alias("idx"),
        F.array_min(F.transform(axes, lambda a, k: F.struct(_dr(x, a).alias("dr"), k.alias("axis"))))
        .alias("best"))))
    out = df.select(key, F.inline(per))
    return out.select(key, "idx", F.col("best.axis").alias("axis"), F.col("best.dr").alias("min_dr"))


def knn_edges(df: DataFrame, k: int, coord1: str = "eta", coord2: str = "phi", nodes_col: str = "jet",
              key: str = "event_id") -> DataFrame:
    """K nearest neighbours of each node inside its event in (coord1, coord2), no self loop.

    Squared Euclidean distance, no phi wrap (as the reference); ties by node index.
    Every node's candidates are ranked inside the row; only its k edges are emitted.
    """
    nodes = F.transform(F.col(nodes_col), lambda x, i: F.struct(
        x[coord1].alias("c1"), x[coord2].alias("c2"), i.alias("i")))

    def neigh(own: Column, x: Column) -> Column:
        cand = F.filter(own, lambda y: y["i"] != x["i"])
        scored = F.transform(cand, lambda y: F.struct(
            (F.pow(x["c1"] - y["c1"], 2) + F.pow(x["c2"] - y["c2"], 2)).alias("d2"), y["i"].alias("dst")))
        return F.slice(F.array_sort(scored), 1, k)
    per = _bound(nodes, lambda own: F.transform(own, lambda x: F.struct(x["i"].alias("src"), neigh(own, x).alias("nb"))))
    d = df.select(key, F.explode(per).alias("n"))
    d = d.select(key, F.col("n.src").alias("src"), F.posexplode(F.col("n.nb")).alias("pos", "e"))
    return d.select(key, "src", F.col("e.dst").alias("dst"), (F.col("pos") + 1).alias("rank"),
                    F.col("e.d2").alias("d2"))


def edge_features(df: DataFrame, k: int, feats=("pt", "eta", "phi"), coord1: str = "eta", coord2: str = "phi",
                  nodes_col: str = "jet", key: str = "event_id") -> DataFrame:
    """EdgeConv data part without weights: per node, h_i and max over its kNN of (h_j - h_i);
    then the mean over the event's nodes.  One row per event."""
    nodes = F.transform(F.col(nodes_col), lambda x, i: F.struct(
        x[coord1].alias("c1"), x[coord2].alias("c2"), i.alias("i"), *[x[f].alias(f) for f in feats]))

    def diff_max(nb: Column, f: str) -> Column:
        return F.array_max(F.transform(nb, lambda e: e[f"d_{f}"]))

    def node_out(own: Column, x: Column) -> Column:
        cand = F.filter(own, lambda y: y["i"] != x["i"])
        scored = F.transform(cand, lambda y: F.struct(
            (F.pow(x["c1"] - y["c1"], 2) + F.pow(x["c2"] - y["c2"], 2)).alias("d2"), y["i"].alias("i"),
            *[(y[f] - x[f]).alias(f"d_{f}") for f in feats]))
        nb = F.slice(F.array_sort(scored), 1, k)
        return F.struct(*[x[f].alias(f) for f in feats],
                        *[diff_max(nb, f).alias(f"max_d_{f}") for f in feats])
    names = [*feats, *[f"max_d_{f}" for f in feats]]

    def _adder(field: str):
        return lambda acc, x: acc + F.coalesce(x[field], F.lit(0.0))

    def means(per: Column) -> Column:
        # events without neighbours have no max: counted as 0
        return F.struct(*[(F.aggregate(per, F.lit(0.0), _adder(field)) / F.size(per).cast("double"))
                          .alias(f"mean_{field}") for field in names])
    per = _bound(nodes, lambda own: F.transform(own, lambda x: node_out(own, x)))
    out = df.where(F.size(F.col(nodes_col)) > 0).select(key, _bound(per, means).alias("m"))
    return out.select(key, *[f"m.mean_{f}" for f in names])
