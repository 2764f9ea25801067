"""How the events are built from the tables: one exchange per table, tasks of bounded size, same rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from collide import fixtures as FX


@pytest.fixture()
def tables(spark, tmp_path):
    day = dt.datetime(2020, 1, 1)
    orders = [(i, i % 7 + 1, "F" if i % 3 else "O", 1000.0 + i, day, "1") for i in range(60)] + [(None, 3, "F", 1.0, day, "1")]
    lines = [(o, (o * 5 + n) % 40, n % 6, n, float(n + 1), 500.0 + 37.0 * ((o * 3 + n) % 11), 0.01 * n, 0.02, "RAN"[n % 3], "O", day)
             for o in range(50) for n in range(o % 7)] + [(None, 1, 1, 1, 1.0, 9.0, 0.0, 0.0, "R", "O", day)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                  "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                 "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, day, 1, "click", 1.0, "{}")], "event_id long, ts timestamp, user_id long, event_type string, "
                          "value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_rows(spark, tables):
    FX.register_raw(spark, tables, ("orders", "lineitem"), rows_per_task=1)
    want = max(spark.sparkContext.defaultParallelism, spark.read.parquet(f"{tables}/lineitem.parquet").count())
    for t in ("orders", "lineitem"):
        assert spark.table(t).rdd.getNumPartitions() == want


@pytest.mark.parametrize("name,exchanges", [("collisions", 2), ("ragged", 2), ("jets_array", 1)])
def test_one_exchange_per_table_and_no_sort_before_it(spark, tables, name, exchanges):
    df = {"collisions": lambda: FX.view(spark, tables, "collisions", materialize=False),
          "ragged": lambda: FX._ragged(spark, tables), "jets_array": lambda: FX._jets_array(spark, tables)}[name]()
    plan = _plan(df)
    assert plan.count("Exchange hashpartitioning") == exchanges
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "Exchange hashpartitioning" not in plan[:plan.index("Exchange hashpartitioning")]
    for part in below.split("Exchange hashpartitioning")[1:]:
        own = part[:part.index("FileScan")]
        assert "WindowGroupLimit" not in own and "Sort " not in own


def test_dirty_is_a_projection_of_the_events(spark, tables):
    dirty = FX.view(spark, tables, "dirty")
    assert "Exchange" not in _plan(dirty)
    want = FX.view(spark, tables, "dirty", materialize=False)
    assert sorted(map(str, dirty.collect())) == sorted(map(str, want.collect()))


def test_ragged_keeps_orders_without_lines_and_without_key(spark, tables):
    rows = {r["event_id"]: r for r in FX.ragged(spark, tables).collect()}
    assert len(rows) == 61 and rows[55]["nJet"] == 0 and rows[None]["nJet"] == 0
    assert [rows[i]["nJet"] for i in range(50)] == [i % 7 for i in range(50)]
    sizes = FX.jets_array(spark, tables).select("event_id", F.size("jet").alias("n")).collect()
    assert {r["event_id"]: r["n"] for r in sizes} == {**{i: i % 7 for i in range(50) if i % 7}, None: 1}
