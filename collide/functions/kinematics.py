"""Kinematic Column functions.

All are native Spark expressions (whole-stage codegen, no UDF).  They
compute in DOUBLE and, like the reference, round the result to FLOAT
(``cast("float")``) unless noted.  NaN behaviour follows NumPy where Spark's
NaN ordering would differ (NaN is the largest value in Spark).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = math.pi
TWO_PI = 2.0 * math.pi

ColLike = Column | str | float | int


def c(x: ColLike) -> Column:
    """Column from a name, a literal number or a Column, as DOUBLE."""
    if isinstance(x, Column):
        return x.cast("double")
    if isinstance(x, str):
        return F.col(x).cast("double")
    return F.lit(float(x))


def f32(x: Column) -> Column:
    return x.cast("float")


def wrap_phi(d: ColLike) -> Column:
    """One wrap into [-pi, pi]: if d > pi subtract 2pi, then if d < -pi add 2pi (not a modulo)."""
    d = c(d)
    d1 = F.when(d > F.lit(PI), d - F.lit(TWO_PI)).otherwise(d)
    return F.when(d1 < F.lit(-PI), d1 + F.lit(TWO_PI)).otherwise(d1)


def four_vector(pt: ColLike, eta: ColLike, phi: ColLike, mass: ColLike) -> Column:
    """M1: struct(px, py, pz, E) in DOUBLE; E = sqrt(px^2 + py^2 + pz^2 + m^2)."""
    pt, eta, phi, mass = c(pt), c(eta), c(phi), c(mass)
    px = pt * F.cos(phi)
    py = pt * F.sin(phi)
    pz = pt * F.sinh(eta)
    e = F.sqrt(px * px + py * py + pz * pz + mass * mass)
    return F.struct(px.alias("px"), py.alias("py"), pz.alias("pz"), e.alias("E"))


def invariant_mass(pt1: ColLike, eta1: ColLike, phi1: ColLike, m1: ColLike,
                   pt2: ColLike, eta2: ColLike, phi2: ColLike, m2: ColLike) -> Column:
    """M2: sqrt(max((E1+E2)^2 - |p1+p2|^2, 0)) as FLOAT."""
    a = four_vector(pt1, eta1, phi1, m1)
    b = four_vector(pt2, eta2, phi2, m2)
    e = a["E"] + b["E"]
    px = a["px"] + b["px"]
    py = a["py"] + b["py"]
    pz = a["pz"] + b["pz"]
    m_sq = e * e - (px * px + py * py + pz * pz)
    return f32(F.sqrt(F.greatest(m_sq, F.lit(0.0))))


def delta_r(eta1: ColLike, phi1: ColLike, eta2: ColLike, phi2: ColLike, as_float: bool = True) -> Column:
    """M3: sqrt(deta^2 + dphi^2) with dphi wrapped once."""
    deta = c(eta1) - c(eta2)
    dphi = wrap_phi(c(phi1) - c(phi2))
    r = F.sqrt(deta * deta + dphi * dphi)
    return f32(r) if as_float else r


def transverse_mass(pt: ColLike, phi: ColLike, met: ColLike, met_phi: ColLike) -> Column:
    """M4: sqrt(max(2 pt met (1 - cos dphi), 0)) as FLOAT."""
    dphi = wrap_phi(c(phi) - c(met_phi))
    mt_sq = F.lit(2.0) * c(pt) * c(met) * (F.lit(1.0) - F.cos(dphi))
    return f32(F.sqrt(F.greatest(mt_sq, F.lit(0.0))))


def rapidity(e: ColLike, pz: ColLike) -> Column:
    """M5: 0.5 ln(max(E+pz, 1e-10) / max(E-pz, 1e-10)) as FLOAT (clamps, never null)."""
    e, pz = c(e), c(pz)
    num = F.greatest(e + pz, F.lit(1e-10))
    den = F.greatest(e - pz, F.lit(1e-10))
    return f32(F.lit(0.5) * F.log(num / den))


def ht_scalar(*pts: ColLike) -> Column:
    """M6 (2-D form): sum of max(pt, 0) over the given columns; NaN propagates. FLOAT."""
    total = None
    for p in pts:
        term = F.greatest(c(p), F.lit(0.0))
        total = term if total is None else total + term
    return f32(total)


def ht_array(arr: ColLike) -> Column:
    """M6 over an ARRAY<DOUBLE>: aggregate(arr, 0, (a, x) -> a + max(x, 0)). FLOAT."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return f32(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.greatest(x.cast("double"), F.lit(0.0))))


def ht_event(arr: ColLike) -> Column:
    """M6 (1-D form) over an ARRAY: the sum of the values above 0; zero, negative, missing and NaN ones drop out. FLOAT."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    kept = F.filter(F.transform(arr, lambda x: x.cast("double")), lambda x: (x > F.lit(0.0)) & ~F.isnan(x))
    return f32(F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x))


def centrality(ht: ColLike, e_total: ColLike) -> Column:
    """M7: ht / max(E, 1e-10) as FLOAT (the clamp also keeps ANSI division safe)."""
    return f32(c(ht) / F.greatest(c(e_total), F.lit(1e-10)))


def delta_phi(phi1: ColLike, phi2: ColLike) -> Column:
    """M8: d = |phi1 - phi2|; if d > pi then 2pi - d (single fold). FLOAT."""
    d = F.abs(c(phi1) - c(phi2))
    # NumPy: NaN > pi is False, so NaN stays NaN; Spark would take the branch,
    # and 2pi - NaN is NaN as well.
    return f32(F.when(d > F.lit(PI), F.lit(TWO_PI) - d).otherwise(d))


def pseudorapidity(theta: ColLike) -> Column:
    """M9: -ln tan(clip(theta, 1e-7, pi - 1e-7) / 2) as FLOAT; NaN stays NaN."""
    t = c(theta)
    clipped = F.least(F.greatest(t, F.lit(1e-7)), F.lit(PI - 1e-7))
    clipped = F.when(F.isnan(t), t).otherwise(clipped)
    return f32(-F.log(F.tan(clipped / F.lit(2.0))))


def met_significance(met: ColLike, ht: ColLike) -> Column:
    """Met / sqrt(max(ht, 1.0)) as FLOAT."""
    return f32(c(met) / F.sqrt(F.greatest(c(ht), F.lit(1.0))))


def signal_significance(s: ColLike, b: ColLike) -> Column:
    """S / sqrt(max(B, 1e-10)) (DOUBLE)."""
    return c(s) / F.sqrt(F.greatest(c(b), F.lit(1e-10)))


def punzi_efficiency(eff: ColLike, b: ColLike, sigma: float = 5.0) -> Column:
    """Eff / (sigma/2 + sqrt(max(B, 1e-10))) (DOUBLE)."""
    return c(eff) / (F.lit(sigma / 2.0) + F.sqrt(F.greatest(c(b), F.lit(1e-10))))
