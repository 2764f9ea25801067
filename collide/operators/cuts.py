"""Selections, cut flow and predicates.

NaN semantics follow NumPy/pandas: a comparison with NaN is False (Spark
would order NaN above everything), so every comparison goes through
``gt``/``ge`` which exclude NaN and null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collide import schema as S


def _v(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def gt(x: Column | str, t: float) -> Column:
    x = _v(x)
    return F.coalesce((x > F.lit(float(t))) & ~F.isnan(x), F.lit(False))


def above(x: Column | str, t: float) -> Column:
    """x > t as a filter: null stays null (a filter drops it), so the comparison reaches the Parquet scan."""
    x = F.col(x) if isinstance(x, str) else x
    return (x > F.lit(float(t))) & ~F.isnan(x)


def ge(x: Column | str, t: float) -> Column:
    x = _v(x)
    return F.coalesce((x >= F.lit(float(t))) & ~F.isnan(x), F.lit(False))


def lepton_cut(df: DataFrame, min_pt: float) -> Column | None:
    """lepton_pt > min, only if min > 0 and the column exists."""
    return above("lepton_pt", min_pt) if min_pt > 0 and "lepton_pt" in df.columns else None


def met_cut(df: DataFrame, min_met: float) -> Column | None:
    """missing_energy_magnitude > min, same guards."""
    col = "missing_energy_magnitude"
    return above(col, min_met) if min_met > 0 and col in df.columns else None


def zero_kinematics_cut(df: DataFrame) -> Column | None:
    """keep events with sum(lepton_pt, jet1_pt) > 0 over the existing ones; missing counts 0."""
    cols = [c for c in ("lepton_pt", "jet1_pt") if c in df.columns]
    if not cols:
        return None
    total = None
    for c in cols:
        v = F.coalesce(F.nanvl(_v(c), F.lit(None).cast("double")), F.lit(0.0))
        total = v if total is None else total + v
    return total > F.lit(0.0)


def quality_cuts(df: DataFrame, lepton_pt_min: float = 0.0, met_min: float = 0.0,
                 lepton_eta_max: float | None = None, min_jets: int | None = None,
                 jet_pt_min: float = 30.0) -> list[tuple[str, Column]]:
    """The ETL cut sequence (F1, F2, F3, plus the optional X4 cuts) as named predicates."""
    cuts: list[tuple[str, Column | None]] = [
        ("lepton_pt", lepton_cut(df, lepton_pt_min)),
        ("met", met_cut(df, met_min)),
    ]
    if lepton_eta_max is not None and "lepton_eta" in df.columns:
        e = _v("lepton_eta")
        cuts.append(("lepton_eta", F.coalesce((F.abs(e) <= F.lit(float(lepton_eta_max))) & ~F.isnan(e), F.lit(False))))
    if min_jets is not None and min_jets > 0:
        cuts.append(("min_jets", n_jets_above(jet_pt_min) >= F.lit(int(min_jets))))
    cuts.append(("zero_kinematics", zero_kinematics_cut(df)))
    return [(n, c) for n, c in cuts if c is not None]


def apply_cuts(df: DataFrame, cuts: Sequence[tuple[str, Column]]) -> DataFrame:
    for _, pred in cuts:
        df = df.filter(pred)
    return df


def cut_flow(df: DataFrame, cuts: Sequence[tuple[str, Column]]) -> DataFrame:
    """one aggregate with ``count_if`` of the cumulative conjunctions, then unpivoted.

    Columns: step, cut, n_before, n_after, efficiency (after/before, null on
    empty input), cumulative_efficiency (after/total).
    """
    aggs = [F.count(F.lit(1)).alias("n0")]
    acc = F.lit(True)
    for i, (_, pred) in enumerate(cuts, start=1):
        acc = acc & pred
        aggs.append(F.count_if(acc).alias(f"n{i}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("cut"),
                     F.col(f"n{i - 1}").alias("n_before"), F.col(f"n{i}").alias("n_after"))
            for i, (name, _) in enumerate(cuts, start=1)]
    if not rows:
        rows = [F.struct(F.lit(0).alias("step"), F.lit("none").alias("cut"),
                         F.col("n0").alias("n_before"), F.col("n0").alias("n_after"))]
    long = one.select(F.col("n0"), F.inline(F.array(*rows)))
    return long.select(
        "step", "cut", F.col("n_before").cast("bigint").alias("n_before"),
        F.col("n_after").cast("bigint").alias("n_after"),
        F.try_divide(F.col("n_after").cast("double"), F.col("n_before").cast("double")).alias("efficiency"),
        F.try_divide(F.col("n_after").cast("double"), F.col("n0").cast("double")).alias("cumulative_efficiency"))


def n_jets_above(threshold: float = 30.0, cols: Sequence[str] | None = None) -> Column:
    """number of jets with pt > threshold (0..4), INT."""
    cols = cols or [S.jet(i, "pt") for i in range(1, 5)]
    total = None
    for c in cols:
        t = gt(c, threshold).cast("int")
        total = t if total is None else total + t
    return total


def has_b_tag(threshold: float = 0.5, cols: Sequence[str] | None = None) -> Column:
    """at least one jet with b_tag > threshold."""
    cols = cols or [S.jet(i, "b_tag") for i in range(1, 5)]
    out = None
    for c in cols:
        t = gt(c, threshold)
        out = t if out is None else out | t
    return out


def detector_selection(df: DataFrame, muon_pt_min: float = 25.0, electron_pt_min: float = 25.0,
                       met_min: float = 20.0, jet_pt_min: float = 30.0, min_jets: int = 2,
                       muon_col: str = "muon_leading_pt_0", electron_col: str = "electron_leading_pt_0",
                       met_col: str = "met_pt", lepton_mode: str = "all") -> list[tuple[str, Column]]:
    """muon pt, electron pt, MET and >= min_jets jets above jet_pt_min; each only if present.

    ``lepton_mode="all"`` requires both leptons (as the flat reference does);
    ``"any"`` requires either.
    """
    cuts: list[tuple[str, Column]] = []
    lep = []
    if muon_col in df.columns:
        lep.append(("muon_pt", above(muon_col, muon_pt_min)))
    if electron_col in df.columns:
        lep.append(("electron_pt", above(electron_col, electron_pt_min)))
    if lepton_mode == "all":
        cuts += lep
    elif lepton_mode == "any" and lep:
        any_lep = lep[0][1]
        for _, p in lep[1:]:
            any_lep = any_lep | p
        cuts.append(("lepton_any", any_lep))
    else:
        raise ValueError(f"unknown lepton_mode {lepton_mode!r}")
    if met_col in df.columns:
        cuts.append(("met", gt(met_col, met_min)))
    jet_cols = [c for c in df.columns if c.startswith("jet") and c.endswith("_pt")]
    if jet_cols:
        cuts.append(("n_jets", n_jets_above(jet_pt_min, jet_cols) >= F.lit(min_jets)))
    return cuts


def class_counts(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """F8: signal and background counts in one pass."""
    return df.agg(F.count_if(F.col(label) == 1).cast("bigint").alias("n_signal"),
                  F.count_if(F.col(label) == 0).cast("bigint").alias("n_background"))


def signal(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.filter(F.col(label) == 1)


def background(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.filter(F.col(label) == 0)


def in_range(x: Column | str, lo: float, hi: float) -> Column:
    """lo <= x <= hi (NaN and null fail)."""
    x = _v(x)
    return F.coalesce(x.between(F.lit(float(lo)), F.lit(float(hi))) & ~F.isnan(x), F.lit(False))


def is_in(x: Column | str, values) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(x.isin(list(values)), F.lit(False))


def not_null(x: Column | str) -> Column:
    """not null and not NaN (pandas' isnull covers both)."""
    x = F.col(x) if isinstance(x, str) else x
    return x.isNotNull() & ~F.coalesce(F.isnan(x.cast("double")), F.lit(False))


def not_inf(x: Column | str) -> Column:
    x = _v(x)
    return ~F.coalesce(F.abs(x) == F.lit(float("inf")), F.lit(False))


def predict_threshold(score: Column | str, threshold: float = 0.5) -> Column:
    """(score >= threshold) as 0/1 INT."""
    return ge(score, threshold).cast("int")
