"""Named business metrics over the marts, whole or sliced by a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import to_double


def _divide(numerator: Column, denominator: Column) -> Column:
    """Blank (NULL) instead of 0 when nothing is counted."""
    return to_double(numerator) / F.nullif(to_double(denominator), F.lit(0.0))


def total_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("revenue").alias("total_revenue"))


def total_orders(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("order_id").alias("total_orders"))


def average_order_value(fact: DataFrame) -> DataFrame:
    return fact.agg(_divide(F.sum("revenue"), F.count_distinct("order_id")).alias("average_order_value"))


def products_needing_reorder(alerts: DataFrame) -> DataFrame:
    """Product-warehouse rows to reorder."""
    return alerts.agg(F.count_if(F.col("stock_status") == "reorder_now").alias("products_needing_reorder"))


def order_metrics_by(fact: DataFrame, key: str, dimension: DataFrame, attribute: str) -> DataFrame:
    """The order metrics per attribute of a related dimension.

    Orders are summed per key before the join: a customer or employee with a
    third of all orders joins as one row. The fact has one row per order, so its
    orders add up without a distinct count.
    """
    per_key = fact.groupBy(key).agg(F.sum("revenue").alias("_revenue"), F.count("order_id").alias("_orders"))
    return (
        per_key.join(dimension.select(key, attribute), key, "left")
        .groupBy(attribute)
        .agg(F.sum("_revenue").alias("total_revenue"), F.sum("_orders").alias("total_orders"))
        .withColumn("average_order_value", _divide(F.col("total_revenue"), F.col("total_orders")))
    )


def campaign_table(performance: DataFrame) -> DataFrame:
    """The rows of the campaign report."""
    return performance.select("campaign_name", "channel", "total_spend", "roas").distinct()
