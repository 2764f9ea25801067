"""Analytic points and seeded invariants for the kinematic Column functions."""
import math

import numpy as np
from pyspark.sql import functions as F

from collide.functions import kinematics as K
from collide.operators import features as D


def one(spark, expr, **cols):
    names = list(cols)
    row = spark.createDataFrame([tuple(float(cols[n]) for n in names)], ", ".join(f"{n} double" for n in names))
    return row.select(expr.alias("x")).first()["x"]


def test_z_mass_back_to_back(spark):
    m = one(spark, K.invariant_mass("pt1", "eta1", "phi1", 0.106, "pt2", "eta2", "phi2", 0.106),
            pt1=45.6, eta1=0.0, phi1=0.0, pt2=45.6, eta2=0.0, phi2=math.pi)
    assert abs(m - 91.2) < 0.01


def test_delta_r_identical_and_wrap(spark):
    assert one(spark, K.delta_r("a", "b", "a", "b"), a=1.0, b=0.5) == 0.0
    # phi 3.1 and -3.1 are 0.083 apart, not 6.2
    d = one(spark, K.delta_r("e", "p1", "e", "p2"), e=0.0, p1=3.1, p2=-3.1)
    assert abs(d - (2 * math.pi - 6.2)) < 1e-5


def test_transverse_mass_collinear_and_back_to_back(spark):
    assert one(spark, K.transverse_mass("pt", "phi", "met", "mphi"), pt=40.0, phi=1.0, met=30.0, mphi=1.0) == 0.0
    mt = one(spark, K.transverse_mass("pt", "phi", "met", "mphi"), pt=40.0, phi=0.0, met=40.0, mphi=math.pi)
    assert abs(mt - 80.0) < 1e-4


def test_ht_padded_and_nan(spark):
    assert one(spark, K.ht_scalar("a", "b", "c", "d"), a=100.0, b=80.0, c=60.0, d=0.0) == 240.0
    assert one(spark, K.ht_scalar("a", "b"), a=-5.0, b=10.0) == 10.0
    assert math.isnan(one(spark, K.ht_scalar("a", "b"), a=float("nan"), b=10.0))


def test_rapidity_zero_and_antisymmetric(spark):
    assert one(spark, K.rapidity("e", "pz"), e=50.0, pz=0.0) == 0.0
    a = one(spark, K.rapidity("e", "pz"), e=100.0, pz=50.0)
    b = one(spark, K.rapidity("e", "pz"), e=100.0, pz=-50.0)
    assert abs(a + b) < 1e-6


def test_centrality_and_met_significance_clamps(spark):
    assert one(spark, K.centrality("h", "e"), h=0.0, e=0.0) == 0.0
    assert one(spark, K.met_significance("m", "h"), m=10.0, h=0.25) == 10.0   # floor at 1.0


def test_delta_phi_single_fold(spark):
    assert abs(one(spark, K.delta_phi("a", "b"), a=3.0, b=-3.0) - (2 * math.pi - 6.0)) < 1e-6
    # more than 2 pi apart: a single fold gives a negative value (not a modulo)
    assert one(spark, K.delta_phi("a", "b"), a=7.0, b=0.0) < 0


def test_pseudorapidity_clip_and_nan(spark):
    assert abs(one(spark, K.pseudorapidity("t"), t=math.pi / 2)) < 1e-6
    assert one(spark, K.pseudorapidity("t"), t=-1.0) > 15          # clipped at 1e-7
    assert math.isnan(one(spark, K.pseudorapidity("t"), t=float("nan")))


def test_random_invariants_against_numpy(spark):
    rng = np.random.default_rng(0)
    n = 500
    pt = rng.uniform(10, 200, (n, 2)); eta = rng.uniform(-3, 3, (n, 2)); phi = rng.uniform(-np.pi, np.pi, (n, 2))
    rows = [tuple(float(v) for v in (pt[i, 0], eta[i, 0], phi[i, 0], pt[i, 1], eta[i, 1], phi[i, 1])) for i in range(n)]
    df = spark.createDataFrame(rows, "pt1 double, eta1 double, phi1 double, pt2 double, eta2 double, phi2 double")
    out = df.select(K.invariant_mass("pt1", "eta1", "phi1", 0.0, "pt2", "eta2", "phi2", 0.0).alias("m"),
                    K.delta_r("eta1", "phi1", "eta2", "phi2").alias("dr"),
                    K.delta_phi("phi1", "phi2").alias("dp")).toPandas()
    assert (out.m >= 0).all() and (out.dr >= 0).all()
    assert ((out.dp >= 0) & (out.dp <= np.pi + 1e-6)).all()
    d = phi[:, 0] - phi[:, 1]
    d = np.where(d > np.pi, d - 2 * np.pi, d); d = np.where(d < -np.pi, d + 2 * np.pi, d)
    ref = np.sqrt((eta[:, 0] - eta[:, 1]) ** 2 + d ** 2).astype(np.float32)
    assert np.allclose(out.dr.to_numpy(), ref, rtol=1e-6)


def test_builder_adds_seven_and_keeps_input(spark):
    from collide import fixtures as FX, schema as S
    from tests.conftest import SF_SMALL
    c = FX.collisions(spark, SF_SMALL)
    d = D.derived(c)
    assert set(S.DERIVED) <= set(d.columns) and d.columns[: len(c.columns)] == c.columns
    pdf = d.select("jet1_pt", "jet2_pt", "jet3_pt", "jet4_pt", "ht", "delta_r_jet1_jet2").toPandas()
    manual = pdf[["jet1_pt", "jet2_pt", "jet3_pt", "jet4_pt"]].clip(lower=0).sum(axis=1)
    assert np.allclose(pdf.ht, manual, rtol=1e-4)
    assert pdf.loc[pdf.jet2_pt == 0, "delta_r_jet1_jet2"].isna().all()
