"""Event-shaped views over the driver's tables (FIXTURES.md part B).

The SQL here only reshapes the driver tables into the schemas the
operators expect (one order = one event, its line items = its jets).  It
does none of an operator's work.  The same text is used by Spark (to build
the input DataFrame) and by the DuckDB oracles (as leading CTEs), so both
sides start from identical rows.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")

_CONSTITUENTS = """select l_orderkey as event_id,
       row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax) as rk,
       l_extendedprice / 500e0 as pt,
       cast((l_partkey * 29) % 501 - 250 as double) / 100e0 as eta,
       cast((l_suppkey * 41 + cast(l_quantity as bigint) * 17) % 629 - 314 as double) / 100e0 as phi,
       l_discount * 20e0 as b_tag,
       l_tax * 100e0 as mass,
       l_quantity * 2e0 as lep_pt,
       l_returnflag as flag
from lineitem"""


def _jet_cols(i: int) -> str:
    return ", ".join(
        f"coalesce(max(case when rk = {i} then {k} end), 0e0) as jet{i}_{k}"
        for k in ("pt", "eta", "phi", "b_tag"))


_JETS = ("select event_id,\n         "
         + ",\n         ".join(_jet_cols(i) for i in range(1, 5))
         + "\nfrom constituents where rk <= 4 group by event_id")

#: What an event has from its order alone.
_OWN = """select o_orderkey as event_id,
       cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as label,
       case when o_custkey % 50 = 0 then 0e0 else o_totalprice / 2000e0 end as lepton_pt,
       cast((o_custkey * 37) % 481 - 240 as double) / 100e0 as lepton_eta,
       cast((o_orderkey * 53) % 629 - 314 as double) / 100e0 as lepton_phi,
       cast((o_orderkey * 97 + o_custkey * 31) % 30000 as double) / 100e0 as missing_energy_magnitude,
       cast((o_orderkey * 71 + 13) % 629 - 314 as double) / 100e0 as missing_energy_phi,
       """
_BASE = _OWN + ",\n       ".join(
    f"coalesce(jet{i}_{k}, 0e0) as jet{i}_{k}" for i in range(1, 5) for k in ("pt", "eta", "phi", "b_tag")
) + "\nfrom orders left join jets j on o_orderkey = j.event_id"


def _mass(parts: list[str]) -> str:
    """Invariant mass of massless objects given as (pt, eta, phi) prefixes; 'met' has eta 0."""
    def comp(fn: str, p: str) -> str:
        if p == "met":
            pt, eta, phi = "missing_energy_magnitude", "0e0", "missing_energy_phi"
        else:
            pt, eta, phi = f"{p}_pt", f"{p}_eta", f"{p}_phi"
        return {"e": f"{pt}*cosh({eta})", "x": f"{pt}*cos({phi})",
                "y": f"{pt}*sin({phi})", "z": f"{pt}*sinh({eta})"}[fn]
    s = {fn: " + ".join(comp(fn, p) for p in parts) for fn in "exyz"}
    return (f"sqrt(greatest(pow({s['e']}, 2) - pow({s['x']}, 2) - pow({s['y']}, 2) "
            f"- pow({s['z']}, 2), 0e0))")


_COLLISIONS = ("select b.*,\n       " + ",\n       ".join([
    _mass(["jet1", "jet2"]) + " as m_jj",
    _mass(["jet1", "jet2", "jet3"]) + " as m_jjj",
    _mass(["lepton", "met"]) + " as m_lv",
    _mass(["jet1", "lepton", "met"]) + " as m_jlv",
    _mass(["jet3", "jet4"]) + " as m_bb",
    _mass(["jet2", "jet3", "jet4"]) + " as m_wbb",
    _mass(["lepton", "met", "jet1", "jet2", "jet3", "jet4"]) + " as m_wwbb",
]) + "\nfrom base b")

# label + score on a 1e-4 grid; many ties, some exact zeros.
_SCORED = """select o_orderkey as event_id, cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as label,
       cast(7 * ((o_orderkey * 7919) % 1001)
          + 3 * (case when o_orderstatus = 'F' then 1 else 0 end) * ((o_orderkey * 104729) % 1001) as double) / 10010e0 as score
from orders"""

# A second, weaker model's score on the same events (for model comparison).
_SCORED2 = """select o_orderkey as event_id, cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as label,
       cast(9 * ((o_orderkey * 6007) % 1001)
          + 1 * (case when o_orderstatus = 'F' then 1 else 0 end) * ((o_custkey * 7927) % 1001) as double) / 10010e0 as score
from orders"""

# five model names, ordered registrations
_RUNS = """select event_type as model_name, event_id as run_id, ts as registered_at,
       0.5e0 + least(value, 499e0) / 1000e0 as val_auc
from events"""

# per-epoch metric history: run = user, epoch order = (ts, event_id); 'error' rows have a NaN loss
_HISTORY_FLAT = """select user_id as run_id, ts, event_id,
       0.5e0 + least(value, 499e0) / 1000e0 as val_auc,
       case when event_type = 'error' then cast('NaN' as double) else 1e0 / (1e0 + value) end as train_loss
from events"""

_FAULTS = {  # column -> faulty value on some rows (input construction only)
    "label": "case when event_id % 173 = 0 then 2 else label end",
    "lepton_eta": "case when event_id % 97 = 0 then cast('NaN' as double) else lepton_eta end",
    "missing_energy_magnitude": "case when event_id % 79 = 0 then missing_energy_magnitude * 20e0 else missing_energy_magnitude end",
    "jet1_pt": "case when event_id % 89 = 0 then null else jet1_pt end",
    "jet2_b_tag": "case when event_id % 71 = 0 then -jet2_b_tag - 1e0 else jet2_b_tag end",
    "m_jj": "case when event_id % 83 = 0 then cast('Infinity' as double) else m_jj end",
}


def _dirty_sql() -> str:
    from collide.schema import FEATURES
    cols = ["event_id"] + [f"{_FAULTS[c]} as {c}" if c in _FAULTS else c for c in ["label"] + FEATURES]
    return "select " + ", ".join(cols) + " from collisions"


VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "constituents": (_CONSTITUENTS, ()),
    "jets": (_JETS, ("constituents",)),
    "base": (_BASE, ("jets",)),
    "collisions": (_COLLISIONS, ("base",)),
    "dirty": (_dirty_sql(), ("collisions",)),
    "scored": (_SCORED, ()),
    "scored2": (_SCORED2, ()),
    "runs": (_RUNS, ()),
    "history_flat": (_HISTORY_FLAT, ()),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in VIEWS[n][1]:
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(names, *ctes: tuple[str, str]) -> str:
    """Leading ``with`` clause holding the fixture views and extra CTEs."""
    parts = [f"{n} as ({VIEWS[n][0]})" for n in _closure(names)]
    parts += [f"{n} as ({body})" for n, body in ctes]
    return "with " + ",\n".join(parts) + "\n"


def oracle(names, select: str, *ctes: tuple[str, str]) -> str:
    """Full DuckDB oracle text: fixture CTEs, the operator's own CTEs, then ``select``.

    A ``select`` text that starts with a comma continues the CTE list.
    """
    if not names and not ctes:
        return select.lstrip().lstrip(",")
    return with_views(names, *ctes) + select


#: Rows of orders or line items that one task holds while it ranks, groups and joins them.
ROWS_PER_TASK = 400_000
_ORDER_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def register_raw(spark: SparkSession, sf_dir: str, tables=("orders", "lineitem", "events"), rows_per_task: int = ROWS_PER_TASK) -> None:
    """The tables as temp views; orders and line items are dealt by their order key.

    Both go to the same number of tasks, which grows with their rows (counted from the file footers), so
    the rank window, the groups and the join over that key need no exchange besides this one, and no task sorts
    more than about ``rows_per_task`` rows, whatever the size of a file split or the session's number of partitions.
    """
    frames = {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables}
    dealt = [t for t in tables if t in _ORDER_KEYS]
    tasks = max([spark.sparkContext.defaultParallelism, *[-(-frames[t].count() // rows_per_task) for t in dealt]])
    for t, df in frames.items():
        (df.repartition(tasks, _ORDER_KEYS[t]) if t in dealt else df).createOrReplaceTempView(t)


def _materialized(spark: SparkSession, sf_dir: str, name: str, text: str, build) -> DataFrame:
    """Write a fixture once as Parquet in the shared folder and read it back.

    The events then enter every query as a Parquet table -- as they would in
    production -- so scans show pushed filters and pruned read schemas, the
    fixture SQL runs once per session, and lineage is cut at the table.
    """
    from collide.session import shared_dir
    from collide.sources import io as IO
    key = hashlib.sha1((os.path.abspath(sf_dir) + "\n" + text).encode()).hexdigest()[:12]
    path = shared_dir(spark, "fixtures", f"{name}-{key}")
    if not IO.exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str, materialize: bool = True) -> DataFrame:
    """One fixture view as a Spark DataFrame (Parquet-backed unless ``materialize=False``)."""
    text = with_views([name]) + f"select * from {name}"

    def build() -> DataFrame:
        register_raw(spark, sf_dir)
        return spark.sql(text)
    if name == "dirty" and materialize:  # a projection of the events: nothing to sort, nothing to store twice
        collisions(spark, sf_dir).createOrReplaceTempView("collisions")
        return spark.sql(VIEWS[name][0])
    return _materialized(spark, sf_dir, name, text, build) if materialize else build()


def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HIGGS-format events: event_id, label, 28 features (DOUBLE)."""
    return view(spark, sf_dir, "collisions")


def scored(spark: SparkSession, sf_dir: str, which: str = "scored") -> DataFrame:
    return view(spark, sf_dir, which)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "runs")


def constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat constituents: one row per (event_id, rk)."""
    return view(spark, sf_dir, "constituents")


def jets_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constituent schema: event_id, jet ARRAY<STRUCT<pt, eta, phi, E>> ordered by rank (E = pt)."""
    return _materialized(spark, sf_dir, "jets_array", "jets_array-v1", lambda: _jets_array(spark, sf_dir))


def _jets_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_raw(spark, sf_dir, ("lineitem",))
    return spark.sql(with_views(["constituents"]) + """
        select event_id,
               transform(array_sort(collect_list(struct(rk, pt, eta, phi))),
                         x -> named_struct('pt', x.pt, 'eta', x.eta, 'phi', x.phi, 'E', x.pt)) as jet
        from constituents group by event_id""")


def ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NanoAOD-like ragged events: Muon_*, Electron_*, Jet_* float arrays, counts, MET.

    Jets are all line items; muons the 'R' lines, electrons the 'A' lines
    (lepton pt = 2 * quantity).  Each collection is ordered by pt desc, then rank.
    """
    return _materialized(spark, sf_dir, "ragged", "ragged-v1", lambda: _ragged(spark, sf_dir))


def _ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_raw(spark, sf_dir, ("orders", "lineitem"))
    return spark.sql(with_views(["constituents"], ("own", f"{_OWN.rstrip().rstrip(',')} from orders")).rstrip() + """,
        g as (
          select event_id,
            array_sort(collect_list(struct(-pt as k, rk, cast(pt as float) as pt, cast(eta as float) as eta,
                       cast(phi as float) as phi, cast(mass as float) as mass, cast(b_tag / 2e0 as float) as btag))) as jets,
            array_sort(collect_list(case when flag = 'R' then struct(-lep_pt as k, rk, cast(lep_pt as float) as pt,
                       cast(eta as float) as eta, cast(phi as float) as phi, cast(0.106e0 as float) as mass) end)) as mus,
            array_sort(collect_list(case when flag = 'A' then struct(-lep_pt as k, rk, cast(lep_pt as float) as pt,
                       cast(eta as float) as eta, cast(phi as float) as phi, cast(0.000511e0 as float) as mass) end)) as els
          from constituents group by event_id)
        select b.event_id,
          coalesce(transform(mus, x -> x.pt), array()) as Muon_pt,
          coalesce(transform(mus, x -> x.eta), array()) as Muon_eta,
          coalesce(transform(mus, x -> x.phi), array()) as Muon_phi,
          coalesce(transform(mus, x -> x.mass), array()) as Muon_mass,
          coalesce(size(mus), 0) as nMuon,
          coalesce(transform(els, x -> x.pt), array()) as Electron_pt,
          coalesce(transform(els, x -> x.eta), array()) as Electron_eta,
          coalesce(transform(els, x -> x.phi), array()) as Electron_phi,
          coalesce(transform(els, x -> x.mass), array()) as Electron_mass,
          coalesce(size(els), 0) as nElectron,
          coalesce(transform(jets, x -> x.pt), array()) as Jet_pt,
          coalesce(transform(jets, x -> x.eta), array()) as Jet_eta,
          coalesce(transform(jets, x -> x.phi), array()) as Jet_phi,
          coalesce(transform(jets, x -> x.mass), array()) as Jet_mass,
          coalesce(transform(jets, x -> x.btag), array()) as Jet_btagDeepFlavB,
          coalesce(size(jets), 0) as nJet,
          cast(b.missing_energy_magnitude as float) as MET_pt,
          cast(b.missing_energy_phi as float) as MET_phi
        from own b left join g on b.event_id = g.event_id""")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run metric history arrays: run_id, val_auc ARRAY<DOUBLE>, train_loss ARRAY<DOUBLE>."""
    return _materialized(spark, sf_dir, "history", "history-v1", lambda: _history(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = view(spark, sf_dir, "history_flat")
    h.createOrReplaceTempView("_history_flat")
    return h.sparkSession.sql("""
        select run_id,
               transform(array_sort(collect_list(struct(ts, event_id, val_auc))), x -> x.val_auc) as val_auc,
               transform(array_sort(collect_list(struct(ts, event_id, train_loss))), x -> x.train_loss) as train_loss
        from _history_flat group by run_id""")
