"""ETL flow (X1), its settings (X4) and dataset description (A1).

``etl`` is a composition of lazy operators with exactly two actions: the
validation gate (one aggregate, one row back) and the scaler fit (one
aggregate over the train rows, one row back).  The result is a lazy
DataFrame with a ``split`` column; ``sources.io.write_splits`` persists it
partitioned by split with the scaler beside it.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collide import schema as S
from collide.operators import cuts as C
from collide.operators import prepare as T
from collide.operators import validate as V
from collide.sources import io as IO


# Sections and names of the nested settings shape.
_SECTIONS = ("data", "higgs", "quality_cuts", "preprocessing", "split")
_RENAMED = {("quality_cuts", "apply"): "apply_quality_cuts", ("split", "train"): "train_frac",
            ("split", "val"): "val_frac", ("split", "test"): "test_frac", ("split", "stratify"): "exact_split",
            ("higgs", "n_samples_dev"): "n_samples", ("higgs", "n_samples"): "n_samples_full"}


@dataclass(frozen=True)
class ETLConfig:
    """ETL settings.  Cut thresholds default to 0 (off); the optional cuts
    ``lepton_eta_max``, ``min_jets`` and ``jet_pt_min`` are off when None."""
    n_samples: int | None = None
    apply_quality_cuts: bool = True
    lepton_pt_min: float = 0.0
    met_min: float = 0.0
    lepton_eta_max: float | None = None
    min_jets: int | None = None
    jet_pt_min: float = 30.0
    normalization: str = "standard"
    train_frac: float = 0.70
    val_frac: float = 0.15
    test_frac: float = 0.15
    random_seed: int = 42
    exact_split: bool = False
    validate: bool = True
    dataset_name: str = "higgs"

    @staticmethod
    def from_dict(d: dict) -> ETLConfig:
        """Flat field names, or nested settings of any depth (``data.quality_cuts.lepton_pt_min``,
        ``data.split.train``, ...).  Sections of other parts of a system file are skipped; a name
        that is unknown inside the ETL sections raises."""
        names = {f.name for f in fields(ETLConfig)}
        found: dict = {}

        def take(node: dict, section: str) -> None:
            for k, v in node.items():
                if isinstance(v, dict):
                    if k in _SECTIONS:
                        take(v, k)
                    elif section:
                        raise ValueError(f"unknown section {k!r} in the settings")
                    continue
                name = _RENAMED.get((section, k), k)
                if name in names:
                    found[name] = v
                elif section != "higgs":
                    raise ValueError(f"unknown setting {k!r} in section {section or 'top level'!r}")
        take(d, "")
        return ETLConfig(**found)

    def config_hash(self, n: int = 10) -> str:
        """sha256 of the sorted JSON of stringified fields, first n hex digits."""
        return fingerprint(asdict(self), n)


def fingerprint(cfg: dict, n: int = 12) -> str:
    """Content hash of a config: sha256(json.dumps(sorted, str values))[:n]."""
    text = json.dumps({k: str(v) for k, v in cfg.items()}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:n]


def cuts_for(df: DataFrame, cfg: ETLConfig):
    if not cfg.apply_quality_cuts:
        return []
    return C.quality_cuts(df, cfg.lepton_pt_min, cfg.met_min, cfg.lepton_eta_max, cfg.min_jets, cfg.jet_pt_min)


def cut_flow_for(df: DataFrame, cfg: ETLConfig) -> DataFrame:
    """F5 for the configured cut sequence."""
    return C.cut_flow(df, cuts_for(df, cfg))


def split(df: DataFrame, cfg: ETLConfig) -> DataFrame:
    if cfg.exact_split:
        return T.stratified_split(df, cfg.train_frac, cfg.val_frac, cfg.test_frac, cfg.random_seed)
    return T.hash_split(df, cfg.train_frac, cfg.val_frac, cfg.random_seed)


def etl(df: DataFrame, cfg: ETLConfig = ETLConfig(), return_scaler: bool = False):
    """Validate (gate) -> cut -> split -> scale (fit on train).  Lazy result with ``split``."""
    d = df
    if cfg.n_samples:
        d = T.balanced_sample(d, cfg.n_samples, cfg.random_seed)
    if cfg.validate:
        d = V.validate_gate(d)                       # action 1: one-row summary
    d = C.apply_cuts(d, cuts_for(d, cfg))
    d = split(d, cfg)
    feats = [c for c in S.FEATURES if c in d.columns]
    scaler = T.fit_scaler(d.filter(F.col("split") == "train"), feats, cfg.normalization)  # action 2
    out = scaler.transform(d)
    return (out, scaler) if return_scaler else out


def run(spark: SparkSession, df: DataFrame, root: str, cfg: ETLConfig = ETLConfig(), force: bool = False) -> str:
    """X1 as one entry point: run the flow and store its splits under the hash of the settings; a version
    that is there already is kept unless ``force``.  Returns the version."""
    version = cfg.config_hash()
    if force or not IO.version_exists(spark, root, version):
        out, scaler = etl(df, cfg, return_scaler=True)
        IO.write_splits(spark, out, root, version, scaler, {"config": asdict(cfg)})
    return version


def describe(df: DataFrame, columns, decimals: int = 3) -> DataFrame:
    """A1: per column count, mean, sample std, min, exact quartiles, max, rounded.

    Moments come from one long-form ``groupBy(feature)``; the quartiles from
    the distributed exact quantile (no column held whole in one buffer).
    """
    from collide.operators.quantiles import exact_quantiles
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
                                        for c in columns])))

    def rd(x):
        return F.round(x, decimals) + F.lit(0.0)
    agg = long.groupBy("feature").agg(
        F.count("v").cast("bigint").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_quantiles(df, list(columns), [0.25, 0.5, 0.75]).groupBy(F.col("column").alias("feature")) \
        .pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    q = q.select("feature", *[F.col(f"`{p}`").alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    out = agg.join(q, "feature", "left")
    return out.select("feature", "count", rd(F.col("mean")).alias("mean"), rd(F.col("std")).alias("std"),
                      rd(F.col("min")).alias("min"), rd(F.col("q25")).alias("q25"), rd(F.col("q50")).alias("q50"),
                      rd(F.col("q75")).alias("q75"), rd(F.col("max")).alias("max"))


def label_balance(df: DataFrame) -> DataFrame:
    """A1: label counts and shares."""
    from pyspark.sql import Window
    c = df.groupBy(S.LABEL).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return c.select(S.LABEL, "n", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))
