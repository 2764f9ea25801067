"""Queries for the validation gate (V1-V9) on the ``dirty`` view: the clean
events with a few injected nulls, NaN, inf, out-of-range values and bad
labels, so that every rule has something to find."""

from __future__ import annotations

from pyspark.sql import functions as F

from collide import fixtures as FX
from collide import schema as S
from collide.catalog import query
from collide.operators import validate as V

DIRTY = ["dirty"]
_COLS = ["event_id", "label"] + S.FEATURES
_INTS = {"event_id", "label"}


def _dirty(spark, sf):
    return FX.view(spark, sf, "dirty")


def _missing_sql(c: str) -> str:
    return f"{c} is null" if c in _INTS else f"({c} is null or isnan({c}))"


def _inf_sql(c: str) -> str:
    return "false" if c in _INTS else f"coalesce(abs({c}) = 'inf'::double, false)"


def _rules_sql(which: str) -> list[tuple[str, str, str]]:
    """(column, rule, failing predicate) in SQL -- written independently of the Spark rule engine."""
    out = [("label", "not_nullable", "label is null"),
           ("label", "isin_0_1", "label is not null and label not in (0, 1)")]
    for c, lo, hi in S.bounds(which):
        out.append((c, "not_nullable", _missing_sql(c)))
        out.append((c, "in_range", f"not {_missing_sql(c)} and not ({c} >= {lo!r}e0 and {c} <= {hi!r}e0)"
                    .replace(".0e0", ".0e0")))
        out.append((c, "no_inf", _inf_sql(c)))
    return out


def _counts_sql(which: str) -> str:
    parts = [f"select '{c}' as \"column\", '{r}' as rule, cast(count(*) filter (where {p}) as bigint) as n_fail from dirty"
             for c, r, p in _rules_sql(which)]
    return FX.oracle(DIRTY, " union all ".join(parts))


@query("range_violations", _counts_sql("validator"))
def range_violations(spark, sf):
    """V3: not-null, in-range and no-inf per column + label domain, one aggregate."""
    return V.range_violations(_dirty(spark, sf))


@query("schema_range_violations", _counts_sql("schema"))
def schema_range_violations(spark, sf):
    """V9: the same engine with the tighter JSON-schema bounds."""
    return V.range_violations(_dirty(spark, sf), which="schema")


@query("null_census", FX.oracle(DIRTY, " union all ".join(
    f"select '{c}' as \"column\", cast(count(*) filter (where {_missing_sql(c)}) as bigint) as n_null from dirty"
    for c in _COLS)))
def null_census(spark, sf):
    """V1: null-or-NaN count over all columns."""
    return V.null_census(_dirty(spark, sf))


@query("inf_census", FX.oracle(DIRTY, " union all ".join(
    f"select '{c}' as \"column\", cast(count(*) filter (where {_inf_sql(c)}) as bigint) as n_inf from dirty"
    for c in _COLS)))
def inf_census(spark, sf):
    """V2: +-inf count over numeric columns."""
    return V.inf_census(_dirty(spark, sf))


@query("label_domain", FX.oracle(DIRTY, """
select cast(count(*) filter (where label is not null and label not in (0, 1)) as bigint) as n_bad_label,
       cast(count(*) filter (where label is null) as bigint) as n_null_label from dirty"""))
def label_domain(spark, sf):
    """V4: labels outside {0, 1}."""
    return V.label_domain(_dirty(spark, sf))


@query("dataset_checks", FX.oracle(DIRTY, """
select cast(count(*) as bigint) as n_rows, avg(cast(label as double)) as label_mean, count(*) > 0 as non_empty,
       coalesce(avg(cast(label as double)) between 0.1e0 and 0.9e0, false) as balance_ok from dirty"""))
def dataset_checks(spark, sf):
    """V5: non-empty and 0.10 <= mean(label) <= 0.90."""
    return V.dataset_checks(_dirty(spark, sf))


def _cells_sql() -> str:
    parts = []
    for c, r, p in _rules_sql("validator"):
        parts.append(f"select event_id, '{c}' as \"column\", '{r}' as rule, cast({c} as double) as value "
                     f"from dirty where {p}")
    return " union all ".join(parts)


@query("failure_cases", FX.oracle(DIRTY, f"""
select * from ({_cells_sql()}) t order by event_id, "column", rule limit 20"""))
def failure_cases(spark, sf):
    """V6: first 20 failing cells by (event_id, column, rule): a bounded top-k."""
    return V.failure_cases(_dirty(spark, sf), 20)


def _report_sql() -> str:
    cell = " + ".join(f"count(*) filter (where {p})" for _, _, p in _rules_sql("validator"))
    nulls = " + ".join(f"count(*) filter (where {_missing_sql(c)})" for c in _COLS)
    return FX.oracle(DIRTY, f""", r as (
  select count(*) as n_rows, {cell} as cells, {nulls} as nulls, avg(cast(label as double)) as sf from dirty)
select cast(n_rows as bigint) as n_rows, {len(_COLS)} as n_cols,
  cast(cells + (case when n_rows > 0 then 0 else 1 end)
       + (case when coalesce(sf between 0.1e0 and 0.9e0, false) then 0 else 1 end) as bigint) as n_failures,
  cells + (case when n_rows > 0 then 0 else 1 end)
       + (case when coalesce(sf between 0.1e0 and 0.9e0, false) then 0 else 1 end) = 0 as passed,
  cast(nulls as bigint) as null_count, sf as signal_fraction
from r""")


@query("validation_report", _report_sql())
def validation_report(spark, sf):
    """V8: non-raising one-row report."""
    return V.validation_report(_dirty(spark, sf))


@query("validate_gate")
def validate_gate(spark, sf):
    """V7: the gate passes on clean events (coerced to DOUBLE) and raises on the dirty ones;
    the result row records both outcomes."""
    clean = V.validate_gate(FX.collisions(spark, sf))
    try:
        V.validate_gate(_dirty(spark, sf))
        dirty_raised, first = False, ""
    except V.ValidationError as e:
        dirty_raised, first = True, str(e.failures[:1])
    return clean.agg(F.count(F.lit(1)).alias("n_passed")).select(
        "n_passed", F.lit(dirty_raised).alias("dirty_raised"), F.lit(first).alias("first_failure"))


@query("schema_rules", FX.oracle(["collisions"], ", r(feature, lo, hi, unit, category) as (values " + ", ".join(
    f"('{c}', {float(lo)!r}::double, {float(hi)!r}::double, {'null' if u is None else repr(u)}, '{cat}')"
    for c, lo, hi, u, cat in S.SCHEMA_RULES) + "), o as (" + " union all ".join(
    f"select '{c}' as feature, min({c}) as observed_min, max({c}) as observed_max from collisions" for c in S.FEATURES) + """)
select r.*, o.observed_min, o.observed_max from r left join o on o.feature = r.feature"""))
def schema_rules(spark, sf):
    """The JSON-schema rules table joined with each feature's observed min/max on the events."""
    c = FX.collisions(spark, sf)
    long = c.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in S.FEATURES])))
    stats = long.groupBy("feature").agg(F.min("v").alias("observed_min"), F.max("v").alias("observed_max"))
    return S.rules_df(spark, "schema").join(stats, "feature", "left")
