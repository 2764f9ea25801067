"""One-pass rule engine for the event table (V1-V9).

Every rule is a boolean Column; all counters for all columns are computed
in a single aggregate (map-side partial aggregation, one tiny final row),
then unpivoted with ``inline``.  Failing cells are only materialised by
``failure_cases`` (a bounded top-k) and only when asked for.

Semantics follow the reference's schema checks: ``not_nullable`` counts
null *and* NaN; ``in_range`` ignores missing values (they are reported by
``not_nullable``) and fails +-inf; ``no_inf`` counts +-inf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collide import schema as S


class ValidationError(ValueError):
    """Raised by the gate; carries the one-row summary and the first failures."""

    def __init__(self, message: str, summary: dict, failures: list[dict]):
        super().__init__(message)
        self.summary = summary
        self.failures = failures


_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)
_FLOATING = (T.DoubleType, T.FloatType)


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}   # one schema fetch per operator call


def _missing_sql(types: dict, c: str) -> str:
    if isinstance(types[c], _FLOATING):
        return f"({_q(c)} is null or isnan({_q(c)}))"
    return f"({_q(c)} is null)"


def _inf_sql(types: dict, c: str) -> str:
    if not isinstance(types[c], _FLOATING):
        return "false"
    return f"coalesce(abs(cast({_q(c)} as double)) = double('inf'), false)"


def rule_sql(df: DataFrame, which: str = "validator") -> list[tuple[str, str, str]]:
    """(column, rule, ok-predicate as SQL) for every rule of the schema that applies to ``df``.

    Rules are SQL expression text so that ~100 of them cost one parse each
    instead of many driver round trips per Column operation."""
    types = _types(df)
    out: list[tuple[str, str, str]] = []
    if S.LABEL in types:
        miss = _missing_sql(types, S.LABEL)
        vals = ", ".join(str(v) for v in S.LABEL_VALUES)
        out.append((S.LABEL, "not_nullable", f"not {miss}"))
        out.append((S.LABEL, "isin_0_1", f"({miss} or {_q(S.LABEL)} in ({vals}))"))
    for c, lo, hi in S.bounds(which):
        if c not in types:
            continue
        miss = _missing_sql(types, c)
        out.append((c, "not_nullable", f"not {miss}"))
        out.append((c, "in_range", f"({miss} or cast({_q(c)} as double) between {float(lo)!r}D and {float(hi)!r}D)"))
        out.append((c, "no_inf", f"not {_inf_sql(types, c)}"))
    return out


def _counts_sql(df: DataFrame, rs: list[tuple[str, str, str]]) -> DataFrame:
    """One aggregate with one failure counter per rule; unpivoted to long rows (column, rule, n_fail)."""
    aggs = [F.expr(f"coalesce(sum(cast(not coalesce({ok}, false) as bigint)), 0) as __r{i}")
            for i, (_, _, ok) in enumerate(rs)]
    one = df.agg(*aggs)
    rows = ", ".join(f"struct('{c}' as `column`, '{r}' as rule, __r{i} as n_fail)" for i, (c, r, _) in enumerate(rs))
    return one.selectExpr(f"inline(array({rows}))").selectExpr("`column`", "rule", "cast(n_fail as bigint) as n_fail")


def range_violations(df: DataFrame, which: str = "validator") -> DataFrame:
    """V3 / V9: (column, rule, n_fail) for every rule, in one pass."""
    return _counts_sql(df, rule_sql(df, which))


def null_census(df: DataFrame) -> DataFrame:
    """V1: (column, n_null) over **all** columns (null or NaN), one pass."""
    types = _types(df)
    rs = [(c, "null", f"not {_missing_sql(types, c)}") for c in types]
    return _counts_sql(df, rs).selectExpr("`column`", "n_fail as n_null")


def inf_census(df: DataFrame) -> DataFrame:
    """V2: (column, n_inf) over numeric columns, one pass."""
    types = _types(df)
    rs = [(c, "inf", f"not {_inf_sql(types, c)}") for c, t in types.items() if isinstance(t, _NUMERIC)]
    return _counts_sql(df, rs).selectExpr("`column`", "n_fail as n_inf")


def label_domain(df: DataFrame) -> DataFrame:
    """V4: rows whose label is not in {0, 1} (null counted separately)."""
    lab = F.col(S.LABEL)
    return df.agg(F.count_if(lab.isNotNull() & ~lab.isin(*S.LABEL_VALUES)).cast("bigint").alias("n_bad_label"),
                  F.count_if(lab.isNull()).cast("bigint").alias("n_null_label"))


def dataset_checks(df: DataFrame) -> DataFrame:
    """V5: rows > 0 and 0.10 <= mean(label) <= 0.90, in the same pass."""
    lo, hi = S.LABEL_MEAN_RANGE
    one = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.avg(F.col(S.LABEL).cast("double")).alias("label_mean"))
    return one.select("n_rows", "label_mean", (F.col("n_rows") > 0).alias("non_empty"),
                      F.coalesce(F.col("label_mean").between(F.lit(lo), F.lit(hi)), F.lit(False)).alias("balance_ok"))


def failing_cells(df: DataFrame, which: str = "validator", key: str = S.EVENT_ID) -> DataFrame:
    """V6: every failing cell as (key, column, rule, value), built row-locally."""
    rs = rule_sql(df, which)
    cells = ", ".join(f"struct('{c}' as `column`, '{r}' as rule, cast({_q(c)} as double) as value, "
                      f"coalesce({ok}, false) as ok)" for c, r, ok in rs)
    out = df.selectExpr(_q(key), f"inline(filter(array({cells}), x -> not x.ok))")
    return out.select(key, "column", "rule", "value")


def failure_cases(df: DataFrame, limit: int = 20, which: str = "validator", key: str = S.EVENT_ID) -> DataFrame:
    """V6: the first ``limit`` failing cells by (key, column, rule): a distributed top-k."""
    return failing_cells(df, which, key).orderBy(key, "column", "rule").limit(limit)


def missing_columns(df: DataFrame) -> list[str]:
    """Required columns (label and all features) that the frame lacks."""
    have = set(df.columns)
    return [c for c in S.HIGGS_COLUMNS if c not in have]


def summary(df: DataFrame, which: str = "validator", scope: str = "schema") -> DataFrame:
    """One-row summary: n_rows, n_cols, n_failures, passed, null_count, signal_fraction.

    ``scope="all"`` is the gate: required columns that are absent count as failures, the
    columns outside the schema are checked for missing values and every floating column for
    infinity; ``"schema"`` checks the schema columns only.
    """
    types = _types(df)
    rs = rule_sql(df, which)
    if scope == "all":
        known = {c for c, _, _ in rs}
        rs = rs + [(c, "not_nullable", f"not {_missing_sql(types, c)}") for c in types if c not in known]
        bounded = {c for c, r, _ in rs if r == "no_inf"}
        rs = rs + [(c, "no_inf", f"not {_inf_sql(types, c)}") for c, t in types.items()
                   if isinstance(t, _FLOATING) and c not in bounded]
    absent = len(missing_columns(df)) if scope == "all" else 0
    # one small counter per rule / column (lean generated code); they are added up on the one-row result
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_rows"),
            F.avg(F.col(S.LABEL).cast("double")).alias("signal_fraction")]
    aggs += [F.expr(f"coalesce(sum(cast(not coalesce({ok}, false) as bigint)), 0) as __f{i}") for i, (_, _, ok) in enumerate(rs)]
    aggs += [F.expr(f"coalesce(sum(cast({_missing_sql(types, c)} as bigint)), 0) as __m{i}") for i, c in enumerate(types)]
    raw = df.agg(*aggs)
    fails = " + ".join([f"__f{i}" for i in range(len(rs))] + [str(absent)])
    nulls = " + ".join(f"__m{i}" for i in range(len(types))) or "0"
    one = raw.selectExpr("n_rows", "signal_fraction", f"cast({fails} as bigint) as n_cell_failures",
                         f"cast({nulls} as bigint) as null_count")
    lo, hi = S.LABEL_MEAN_RANGE
    ds = (f"(case when n_rows > 0 then 0 else 1 end + "
          f"case when coalesce(signal_fraction between {lo!r}D and {hi!r}D, false) then 0 else 1 end)")
    return one.selectExpr("n_rows", f"{len(types)} as n_cols", f"cast(n_cell_failures + {ds} as bigint) as n_failures",
                          f"(n_cell_failures + {ds}) = 0 as passed", "null_count", "signal_fraction")


def validation_report(df: DataFrame, which: str = "validator", details: int = 0, key: str = S.EVENT_ID) -> DataFrame:
    """V8: non-raising one-row report (n_rows, n_cols, passed, n_failures, null_count, signal_fraction);
    with ``details`` also the first so many failing cells as an array."""
    one = summary(df, which, scope="schema")
    if not details:
        return one
    cells = failure_cases(df, details, which, key).agg(F.array_sort(F.collect_list(F.struct(
        key, "column", "rule", "value"))).alias("details"))  # at most ``details`` cells
    return one.join(F.broadcast(cells), F.lit(True), "left")


def coerce(df: DataFrame) -> DataFrame:
    """Coercion applied by the gate: label INT, features DOUBLE (one projection)."""
    casts = {c: F.col(c).cast("double") for c in S.FEATURES if c in df.columns}
    if S.LABEL in df.columns:
        casts[S.LABEL] = F.col(S.LABEL).cast("int")
    return df.withColumns(casts)


def validate_gate(df: DataFrame, raise_on_failure: bool = True, which: str = "validator",
                  log_limit: int = 5) -> DataFrame:
    """V7: one action on the one-row summary; raise (with the first failures) or return the coerced input.

    The failing cells are only computed when the gate fails.
    """
    row = summary(df, which, scope="all").first().asDict()
    if row["passed"]:
        return coerce(df)
    key = S.EVENT_ID if S.EVENT_ID in df.columns else df.columns[0]
    first = [{"column": c, "rule": "required"} for c in missing_columns(df)][:log_limit]
    first += [r.asDict() for r in failure_cases(df, log_limit - len(first), which, key).collect()]
    msg = f"validation failed: {row['n_failures']} failures; first: {first}"
    if raise_on_failure:
        raise ValidationError(msg, row, first)
    return df
