"""What the plans must and must not contain."""

import contextlib
import io
import re
from datetime import datetime

import pytest

from tidemark.operators.incremental import newer_than
from tidemark.plans import inventory
from tidemark.plans.catalog import QUERIES, models
from tidemark.session import stage

# Streams and repeated loads end in a plain scan; their steps are checked by the tests of the operators.
LAZY = sorted(n for n in QUERIES if not n.startswith(("incremental", "stream", "mart_")))


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def nothing_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, small, nothing_broadcast, name):
    text = plan(QUERIES[name](spark, small))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SerializeFromObject"):
        assert operator not in text


def test_scans_read_only_what_the_report_needs(spark, small):
    text = plan(QUERIES["sales_velocity"](spark, small))
    read = dict(re.findall(r"Location: InMemoryFileIndex \[file:\S*/(\w+)\.parquet\](?:.|\n)*?ReadSchema: struct<(.*?)>", text))
    assert read["lineitem"] == "l_orderkey:bigint,l_partkey:bigint,l_quantity:double"
    assert read["orders"] == "o_orderkey:bigint,o_orderdate:timestamp_ntz"


def test_running_balance_moves_the_ledger_once(spark, small, nothing_broadcast):
    fact = stage(models(spark, small).fact_stock_movements, "fact")
    text = plan(inventory.running_balance(fact))
    # The rows; and of the totals a shuffle each to sum, to put in order and to join.
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) <= 4


def test_attribution_counts_days_not_orders(spark, small):
    text = plan(QUERIES["range_join_attribution"](spark, small))
    assert text.index("HashAggregate") < text.index("Join")


def test_line_items_are_not_numbered_where_ids_are_not_used(spark, small):
    assert "Window" not in plan(QUERIES["fact_orders"](spark, small))


def test_stock_levels_aggregate_without_a_window(spark, small):
    fact = stage(models(spark, small).fact_stock_movements, "fact")
    text = plan(inventory.current_stock_levels(fact))
    assert "Window" not in text and "HashAggregate" in text


def test_top_customers_keep_ten_per_task(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_customers_by_ltv"](spark, small))


def test_watermark_reaches_the_scan(spark):
    rows = [(i, datetime(2024, 1, 1 + i)) for i in range(9)]
    source = stage(spark.createDataFrame(rows, "id long, loaded_at timestamp_ntz"), "source")
    fresh = newer_than(source, source.where("id < 5"))
    assert sorted(r.id for r in fresh.collect()) == [5, 6, 7, 8]
    assert re.search(r"PushedFilters: \[.*GreaterThan\(loaded_at,ScalarSubquery", plan(fresh))
