"""Projections and reshaping.

All are single ``select`` / ``withColumns`` projections, so Catalyst prunes
unused columns into the Parquet scan and the work stays inside one
whole-stage-codegen span (array higher-order functions run interpreted, but
row-local: nothing is shuffled).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide import schema as S
from collide.operators.features import accessor


def rename_branches(df: DataFrame, branch_map: dict[str, str] | None = None) -> DataFrame:
    """Keep the mapped source branches that exist, renamed to their local names."""
    branch_map = branch_map or S.BRANCH_MAP
    keep = [F.col(src).alias(local) for local, src in branch_map.items() if src in df.columns]
    extra = [F.col(k) for k in (S.EVENT_ID,) if k in df.columns]
    return df.select(*extra, *keep)


def select_feature_set(df: DataFrame, feature_set: str = "all") -> DataFrame:
    """Label first, then the named feature set; unknown name raises."""
    cols = S.feature_set(feature_set)
    keys = [S.EVENT_ID] if S.EVENT_ID in df.columns else []
    return df.select(*keys, *cols)


def extract_low_level(df: DataFrame) -> DataFrame:
    """The 21 raw columns that exist, no label."""
    return df.select(*[c for c in S.LOW_LEVEL if c in df.columns])


def extract_high_level(df: DataFrame) -> DataFrame:
    """The 7 dataset masses that exist."""
    return df.select(*[c for c in S.HIGH_LEVEL if c in df.columns])


def accessors(df: DataFrame) -> DataFrame:
    """P5: lepton pt/eta/phi, MET magnitude/phi and jet i pt/eta/phi/btag as DOUBLE."""
    cols = {"lepton_pt": "lepton_pt", "lepton_eta": "lepton_eta", "lepton_phi": "lepton_phi",
            "met_magnitude": "missing_energy_magnitude", "met_phi": "missing_energy_phi"}
    out = [accessor(src).alias(name) for name, src in cols.items()]
    for i in range(1, 5):
        for k, src in (("pt", "pt"), ("eta", "eta"), ("phi", "phi"), ("btag", "b_tag")):
            out.append(accessor(S.jet(i, src)).alias(f"jet{i}_{k}_f64"))
    keys = [S.EVENT_ID] if S.EVENT_ID in df.columns else []
    return df.select(*keys, *out)


def lepton_four_vector(mass: float = S.LEPTON_MASS) -> Column:
    """struct(pt, eta, phi, mass) of the lepton; mass is a constant."""
    return F.struct(accessor("lepton_pt").alias("pt"), accessor("lepton_eta").alias("eta"),
                    accessor("lepton_phi").alias("phi"), F.lit(float(mass)).alias("mass"))


def jet_four_vector(i: int, mass: float = S.JET_MASS) -> Column:
    """struct(pt, eta, phi, mass) of jet i (massless by default)."""
    return F.struct(accessor(S.jet(i, "pt")).alias("pt"), accessor(S.jet(i, "eta")).alias("eta"),
                    accessor(S.jet(i, "phi")).alias("phi"), F.lit(float(mass)).alias("mass"))


def pack_jet_pts() -> Column:
    """array(jet1_pt, ..., jet4_pt) as ARRAY<DOUBLE>."""
    return F.array(*[accessor(S.jet(i, "pt")) for i in range(1, 5)])


def pad_truncate(arr: Column | str, k: int, fill: float = 0.0) -> Column:
    """Keep the first k elements, pad with ``fill`` to length k (null array -> all fill)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    a = F.transform(F.coalesce(a, F.array()), lambda x: F.coalesce(x.cast("double"), F.lit(float(fill))))
    return F.slice(F.concat(a, F.array_repeat(F.lit(float(fill)), k)), 1, k)


JET_FEATS = ("jet_pt", "jet_eta", "jet_phi", "jet_mass", "jet_btag")
LEPTON_FEATS = ("muon_pt", "muon_eta", "muon_phi", "electron_pt", "electron_eta", "electron_phi")


def _jet_out_name(feat: str, j: int) -> str:
    # the ragged btag branch comes out as the HIGGS-style ``b_tag`` name
    base = feat.replace("jet_", f"jet{j}_", 1)
    return base.replace("_btag", "_b_tag")


def flatten_objects(df: DataFrame, max_jets: int = S.MAX_JETS, max_leptons: int = S.MAX_LEPTONS) -> DataFrame:
    """Scalar branches as FLOAT; jets padded to ``max_jets`` and fanned out to
    ``jet{j}_{feat}``; leptons padded to ``max_leptons``, leading one as ``<x>_leading_<feat>_0``.

    Input: a frame with local (renamed, P1) branch names.
    """
    out: list[Column] = [F.col(S.EVENT_ID)] if S.EVENT_ID in df.columns else []
    out += scalar_branch_columns(df)
    for feat in JET_FEATS:
        if feat in df.columns:
            padded = pad_truncate(feat, max_jets)
            out += [padded[j].cast("float").alias(_jet_out_name(feat, j + 1)) for j in range(max_jets)]
    for feat in LEPTON_FEATS:
        if feat in df.columns:
            padded = pad_truncate(feat, max_leptons)
            out.append(padded[0].cast("float").alias(feat.replace("_", "_leading_", 1) + "_0"))
    return df.select(*out)


def scalar_branch_columns(df: DataFrame) -> list[Column]:
    """P10: non-array branches (except the key) as FLOAT columns."""
    return [F.col(f.name).cast("float").alias(f.name) for f in df.schema.fields
            if f.name != S.EVENT_ID and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]


def scalar_branches(df: DataFrame) -> DataFrame:
    """P10 as a frame."""
    keys = [F.col(S.EVENT_ID)] if S.EVENT_ID in df.columns else []
    return df.select(*keys, *scalar_branch_columns(df))


def particle_tokens(vec: Column, n_particles: int = 4, n_features: int = 7) -> Column:
    """Flat vector -> n_particles x n_features tokens, row-major; cut or zero-padded.

    Built as an array of ``slice``s of the padded vector (no nested lambda, so the
    padded vector is evaluated once per row).
    """
    padded = pad_truncate(vec, n_particles * n_features)
    return F.array(*[F.slice(padded, i * n_features + 1, n_features) for i in range(n_particles)])


def particle_tokens_frame(df: DataFrame, vec: Column, out: str = "tokens", n_particles: int = 4,
                          n_features: int = 7) -> DataFrame:
    """P11 on a frame: the padded vector is projected once, then cut into tokens."""
    padded = df.withColumn("__padded", pad_truncate(vec, n_particles * n_features))
    toks = F.array(*[F.slice(F.col("__padded"), i * n_features + 1, n_features) for i in range(n_particles)])
    return padded.withColumn(out, toks).drop("__padded")


def coerce_types(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast columns; ``strict`` uses ANSI ``cast`` (raises on a bad value),
    otherwise ``try_cast`` and a ``__coerce_failed`` count of values turned null."""
    if strict:
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    casted = {c: F.col(c).try_cast(t) for c, t in types.items()}
    failed = None
    for c, e in casted.items():
        bad = (F.col(c).isNotNull() & e.isNull()).cast("int")
        failed = bad if failed is None else failed + bad
    # one projection: the failure count must see the input columns, not the cast ones
    if failed is not None:
        casted["__coerce_failed"] = failed
    return df.withColumns(casted)


def attach_label(features: DataFrame, key: str = S.EVENT_ID) -> tuple[DataFrame, DataFrame]:
    """Split X from y.  Both keep the key; the label is never re-attached by position."""
    x = features.drop(S.LABEL)
    y = features.select(key, S.LABEL)
    return x, y


def feature_catalog(spark: SparkSession) -> DataFrame:
    """Derived feature name -> description."""
    return spark.createDataFrame(list(S.DERIVED_DESCRIPTIONS.items()), "feature string, description string")


def list_columns(df: DataFrame) -> DataFrame:
    """The schema as a DataFrame (name, type, position)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "name string, type string, position int")
