"""Derived high-level features and missing-value fills.

``derived`` adds seven columns in one projection and never changes an
existing column.  ``fill`` replaces missing values (null or NaN) per split,
with zero or with that split's exact median, in one aggregate that is
joined back on the split key (one row per split, so the broadcast is
bounded by the number of splits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide import schema as S
from collide.functions import kinematics as K


def accessor(name: str) -> Column:
    """P5: named accessor as DOUBLE."""
    return F.col(name).cast("double")


def derived_columns(df: DataFrame, masked_value: str = "null") -> dict[str, Column]:
    """D1-D7 as a dict of Column expressions over a HIGGS-format frame.

    ``ht`` is rounded to FLOAT before it is reused by D6 and D7, as the
    reference does.  D3 is missing where jet2_pt == 0: null by default,
    NaN with ``masked_value="nan"``.
    """
    lep_pt, lep_phi, lep_eta = accessor("lepton_pt"), accessor("lepton_phi"), accessor("lepton_eta")
    met, met_phi = accessor("missing_energy_magnitude"), accessor("missing_energy_phi")
    ht = K.ht_scalar(*[S.jet(i, "pt") for i in range(1, 5)])          # D5, FLOAT
    missing = F.lit(float("nan")) if masked_value == "nan" else F.lit(None).cast("float")
    dr12 = K.delta_r(S.jet(1, "eta"), S.jet(1, "phi"), S.jet(2, "eta"), S.jet(2, "phi"))
    return {
        "transverse_mass_lv": K.transverse_mass(lep_pt, lep_phi, met, met_phi),            # D1
        "delta_r_lepton_jet1": K.delta_r(lep_eta, lep_phi, S.jet(1, "eta"), S.jet(1, "phi")),  # D2
        "delta_r_jet1_jet2": F.when(accessor(S.jet(2, "pt")) == 0.0, missing).otherwise(dr12),  # D3
        "delta_phi_lepton_met": K.delta_phi(lep_phi, met_phi),                              # D4
        "ht": ht,                                                                           # D5
        "met_significance": K.met_significance(met, ht),                                    # D6
        "centrality": K.centrality(ht, ht.cast("double") + lep_pt + met),                   # D7
    }


def derived(df: DataFrame, include_derived: bool = True, masked_value: str = "null") -> DataFrame:
    """Add the derived columns in a single ``withColumns``."""
    if not include_derived:
        return df
    return df.withColumns(derived_columns(df, masked_value))


def _missing(colname: str) -> Column:
    """Null for null or NaN (pandas' notion of missing)."""
    return F.nanvl(F.col(colname).cast("double"), F.lit(None).cast("double"))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    num = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num) and f.name not in exclude]


def fill(df: DataFrame, strategy: str = "median", group_cols=("split",), columns=None,
         exclude=(S.EVENT_ID, S.LABEL)) -> DataFrame:
    """Fill missing values per group with ``zero`` or the group's exact median of non-missing values
    (the distributed exact quantile; a group without any value keeps null).  For medians one job over the
    columns tells which have missing values at all; the others are left out.  The medians are one row
    per group, joined back on it (null groups included)."""
    cols = list(columns) if columns is not None else numeric_columns(df, exclude)
    group_cols = [g for g in group_cols if g in df.columns]
    if strategy == "zero":
        return df.withColumns({
            col: F.coalesce(_missing(col), F.lit(0.0)).cast(df.schema[col].dataType)
            for col in cols})
    if strategy != "median":
        raise ValueError(f"unknown fill strategy {strategy!r}")
    if not cols:
        return df
    from collide.operators.quantiles import few_groups, quantile_wide
    counts = df.agg(*[F.sum(_missing(c).isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    cols = [c for c, m in zip(cols, counts) if m]
    if not cols:
        return df
    q = quantile_wide(df, cols, [0.5], group_cols)
    medians = q.select(*[F.col(g).alias(f"__g_{g}") for g in group_cols],
                       *[F.col(f"{col}__q1").alias(f"__med_{i}") for i, col in enumerate(cols)])
    if group_cols:
        on = None
        for g in group_cols:
            same = F.col(g).eqNullSafe(F.col(f"__g_{g}"))
            on = same if on is None else on & same
        joined = df.join(F.broadcast(medians) if few_groups(df, group_cols) else medians, on, "left")
    else:
        joined = df.join(F.broadcast(medians), F.lit(True), "left")  # one row
    out = joined.withColumns({
        col: F.coalesce(_missing(col), F.col(f"__med_{i}")).cast(df.schema[col].dataType)
        for i, col in enumerate(cols)})
    return out.select(*df.columns)


def feature_columns(columns, include_low_level: bool = True, include_dataset_hl: bool = True,
                    include_derived_hl: bool = True, exclude=(S.LABEL,)) -> list[str]:
    """Ordered, de-duplicated feature list from three switches; label excluded."""
    present = set(columns)
    desired: list[str] = []
    if include_low_level:
        desired += [c for c in S.LOW_LEVEL if c in present]
    if include_dataset_hl:
        desired += [c for c in S.HIGH_LEVEL if c in present]
    if include_derived_hl:
        desired += [c for c in S.DERIVED if c in present]
    out: list[str] = []
    for c in desired:
        if c not in out and c not in exclude:
            out.append(c)
    return out


def builder_feature_names(include_dataset_hl: bool = True, include_derived: bool = True) -> list[str]:
    """Names the derived builder reports (the dataset masses only change this list)."""
    return (list(S.HIGH_LEVEL) if include_dataset_hl else []) + (list(S.DERIVED) if include_derived else [])


def feature_matrix(df: DataFrame, fill_strategy: str = "median", split_col: str = "split",
                   include_low_level: bool = True, include_dataset_hl: bool = True,
                   include_derived_hl: bool = True) -> DataFrame:
    """Derive -> fill per split -> order columns.  One plan for all splits."""
    d = derived(df, include_derived=include_derived_hl)
    d = fill(d, fill_strategy, group_cols=(split_col,))
    feats = feature_columns(d.columns, include_low_level, include_dataset_hl, include_derived_hl)
    keys = [c for c in (S.EVENT_ID, split_col) if c in d.columns]
    return d.select(*keys, *feats, S.LABEL)
