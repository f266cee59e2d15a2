"""The same results when one order with one part, and one part on one day, hold a third of the rows each."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, compare, oracle_connection

from tidemark.session import new_folder


@pytest.fixture(scope="module")
def skewed(spark, small):
    folder = new_folder(spark, "skewed")
    third = F.pmod(F.xxhash64("*"), F.lit(3))
    changes = {
        "lineitem": {
            "l_orderkey": F.when(third == 0, F.lit(7).cast("long")).otherwise(F.col("l_orderkey")),
            "l_partkey": F.when(third <= 1, F.lit(11).cast("long")).otherwise(F.col("l_partkey")),
        },
        "orders": {
            "o_custkey": F.when(third == 0, F.lit(5).cast("long")).otherwise(F.col("o_custkey")),
            "o_orderdate": F.when(third == 1, F.lit("1998-05-05").cast("timestamp_ntz")).otherwise(F.col("o_orderdate")),
        },
        # A third of the balances are equal, the others lie in a narrow band.
        "supplier": {"s_acctbal": F.when(third == 0, F.lit(100.0)).otherwise(100 + F.col("s_acctbal") / 1e5)},
    }
    for table in TABLES:
        df = spark.read.parquet(f"{small}/{table}.parquet")
        df.withColumns(changes.get(table, {})).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.fixture(scope="module")
def con(skewed):
    return oracle_connection(skewed)


@pytest.mark.parametrize(
    "name",
    [
        "dim_customers", "fact_orders", "rpt_monthly_revenue", "rpt_campaign_performance",
        "rpt_customer_acquisition_cohorts", "stock_running_balance", "rpt_current_stock_levels",
        "rpt_inventory_reorder_alerts", "salary_distribution", "gen_order_attribution", "range_join_attribution",
        "metric_by_segment", "dq_unique", "incremental_stock_movements", "gen_stock_movements", "stg_order_items",
    ],
)
def test_skewed_tables(spark, con, skewed, name):
    assert compare(spark, con, name, skewed) == ""
