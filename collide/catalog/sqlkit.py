"""Small helpers shared by catalog queries (Spark side) and oracle text (SQL side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PI_SQL = "pi()"


def r3(col: Column | str) -> Column:
    """Spark: round a (FLOAT or DOUBLE) column to 3 decimals as DOUBLE."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), 3) + F.lit(0.0)  # +0.0 folds -0.0 into 0.0


# --- SQL text helpers (oracle side) ---------------------------------------

def s_wrap(d: str) -> str:
    """One phi wrap: if d > pi subtract 2pi, then if < -pi add 2pi."""
    w1 = f"(case when ({d}) > pi() then ({d}) - 2e0*pi() else ({d}) end)"
    return f"(case when {w1} < -pi() then {w1} + 2e0*pi() else {w1} end)"


def s_f32(expr: str) -> str:
    return f"cast(cast({expr} as float) as double)"


def s_r3(expr: str) -> str:
    return f"(round(cast({expr} as double), 3) + 0e0)"


def s_r3f(expr: str) -> str:
    """Round to FLOAT (like the reference), then to 3 decimals."""
    return f"(round({s_f32(expr)}, 3) + 0e0)"


def s_dr(eta1: str, phi1: str, eta2: str, phi2: str) -> str:
    dphi = s_wrap(f"{phi1} - {phi2}")
    return f"sqrt(pow({eta1} - {eta2}, 2) + pow({dphi}, 2))"


def s_mt(pt: str, phi: str, met: str, met_phi: str) -> str:
    dphi = s_wrap(f"{phi} - {met_phi}")
    return f"sqrt(greatest(2e0 * {pt} * {met} * (1e0 - cos({dphi})), 0e0))"


def s_dphi(phi1: str, phi2: str) -> str:
    d = f"abs({phi1} - {phi2})"
    return f"(case when {d} > pi() then 2e0*pi() - {d} else {d} end)"


def s_ht(*pts: str) -> str:
    return " + ".join(f"greatest({p}, 0e0)" for p in pts)


def s_e(pt: str, eta: str, phi: str, m: str) -> str:
    """Energy: sqrt(px^2 + py^2 + pz^2 + m^2)."""
    return (f"sqrt(pow({pt}*cos({phi}), 2) + pow({pt}*sin({phi}), 2) "
            f"+ pow({pt}*sinh({eta}), 2) + pow({m}, 2))")
