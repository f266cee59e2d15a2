"""Inventory marts: the movement ledger, stock levels, reorder alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_between, div0
from tidemark.operators.ordered import rank_ascending, running_sum
from tidemark.session import stage

# Fixed value: days of sales that a reorder must cover.
LEAD_TIME_DAYS = 14


def fact_stock_movements(movements: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Every movement with product and warehouse attributes."""
    return _with_attributes(movements, products, warehouses)


def _with_attributes(movements: DataFrame, products: DataFrame, warehouses: DataFrame, *more: str) -> DataFrame:
    product = products.select("product_id", "product_name", "category_name")
    warehouse = warehouses.select("warehouse_id", "warehouse_name", F.col("state").alias("warehouse_state"))
    return (
        movements.join(product, "product_id", "left")
        .join(warehouse, "warehouse_id", "left")
        .select(
            "movement_id", "product_id", "product_name", "category_name", "warehouse_id", "warehouse_name",
            "warehouse_state", "movement_date", "movement_type", "quantity_change", "loaded_at", *more,
        )
    )


def running_balance(fact: DataFrame) -> DataFrame:
    """The ledger with the stock of its product and warehouse after each movement.

    Summed day by day: a product that holds a third of the ledger spreads over as
    many tasks as it has days.
    """
    return running_sum(
        fact, "quantity_change", "running_balance", ["product_id", "warehouse_id"], F.col("movement_date"),
        [F.col("movement_id")],
    )


def balanced_ledger(movements: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """``running_balance`` of a fact that is not stored.

    While products and warehouses are known once each, a movement is one row of the fact, so the
    balances are summed over the narrow movements, and attributes join the result. Else the fact
    has a row per version of them, and its rows are summed.
    """
    keys = [products.select(F.lit("p").alias("of"), F.col("product_id").alias("k")), warehouses.select(F.lit("w"), "warehouse_id")]
    several = keys[0].union(keys[1]).groupBy("of", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and k is not null")
    if several.isEmpty():
        return _with_attributes(running_balance(movements), products, warehouses, "running_balance")
    return running_balance(stage(fact_stock_movements(movements, products, warehouses), "fact_stock_movements"))


def closing_balances(balanced: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """(product_id, warehouse_id, balance) after a load of the ledger, which is an aggregate of its own rows."""
    sums = balanced.groupBy("product_id", "warehouse_id").agg(F.sum("quantity_change").alias("balance"))
    if opening is None:
        return sums
    return opening.unionByName(sums).groupBy("product_id", "warehouse_id").agg(F.sum("balance").alias("balance"))


def continued_balance(fact: DataFrame, opening: DataFrame) -> DataFrame:
    """``running_balance`` of a load whose movements all follow those that ``opening`` sums up.

    Reads the load and one row per product and warehouse, not the earlier ledger. A NULL
    product or warehouse is a group like any other.
    """
    at = [F.struct(F.col(k).alias("k")).alias(f"_{k}") for k in ("product_id", "warehouse_id")]
    before = opening.select(*at, F.col("balance").alias("_opening"))
    rows = running_balance(fact).select("*", *at).join(before, ["_product_id", "_warehouse_id"], "left")
    total = F.coalesce(F.col("_opening") + F.col("running_balance"), "running_balance", "_opening")
    return rows.withColumn("running_balance", total).select(*fact.columns, "running_balance")


def stock_totals(movements: DataFrame) -> DataFrame:
    """Balance and last movement date per product and warehouse.

    The running balance at the last movement is the sum of all of them, so no
    window is needed, and partial sums are combined before the shuffle.
    """
    return movements.groupBy("product_id", "warehouse_id").agg(
        F.max("movement_date").alias("as_of_date"), F.sum("quantity_change").alias("current_stock")
    )


def current_stock_levels(fact: DataFrame) -> DataFrame:
    """The latest balance per product and warehouse, with its attributes.

    Needs the whole ledger. Rows that differ in attributes (renamed while older
    movements kept the old name) are summed apart and then together; the shown
    attributes are those of the latest movement.
    """
    attributes = ["product_name", "category_name", "warehouse_name", "warehouse_state"]
    # Date and id as one exact number, which (unlike a struct) a hash aggregate can keep the maximum of.
    day = F.unix_date("movement_date").cast("decimal(9,0)")
    moment = day * F.lit("100000000000000000000").cast("decimal(21,0)") + F.col("movement_id").cast("decimal(19,0)")
    versions = fact.groupBy("product_id", "warehouse_id", *attributes).agg(
        F.sum("quantity_change").alias("_sum"),
        F.max("movement_date").alias("_date"),
        F.max(moment).alias("_moment"),
    )
    return (
        versions.groupBy("product_id", "warehouse_id")
        .agg(
            F.max_by(F.struct(*attributes), F.col("_moment")).alias("_latest"),
            F.max("_date").alias("as_of_date"),
            F.sum("_sum").alias("current_stock"),
        )
        .select(
            "product_id", "_latest.product_name", "_latest.category_name", "warehouse_id", "_latest.warehouse_name",
            "_latest.warehouse_state", "as_of_date", "current_stock",
        )
    )


def planned_stock_levels(movements: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """The stock levels of a fact that is not stored: all its rows show the attributes of today.

    No movement need be known as the latest one then, so movements need no ids, and
    attributes join the totals instead of every movement.
    """
    product = products.select("product_id", "product_name", "category_name")
    warehouse = warehouses.select("warehouse_id", "warehouse_name", F.col("state").alias("warehouse_state"))
    return (
        stock_totals(movements)
        .join(product, "product_id", "left")
        .join(warehouse, "warehouse_id", "left")
        .select(
            "product_id", "product_name", "category_name", "warehouse_id", "warehouse_name", "warehouse_state",
            "as_of_date", "current_stock",
        )
    )


def sales_velocity(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Units sold per day between a product's first and last order, any status."""
    span = days_between(F.min("order_date"), F.max("order_date")) + 1
    return (
        items.select("order_id", "product_id", "quantity")
        .join(orders.select("order_id", "order_date"), "order_id")
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            div0(F.sum("quantity"), span).alias("avg_daily_units_sold"),
        )
    )


def reorder_alerts(stock: DataFrame, velocity: DataFrame) -> DataFrame:
    """Stock against the demand of the lead time, most urgent first.

    The joined rows are staged once, because the global rank reads them twice.
    """
    speed = F.coalesce(F.col("avg_daily_units_sold"), F.lit(0.0))
    joined = stock.join(velocity.select("product_id", "avg_daily_units_sold"), "product_id", "left").select(
        "product_id", "product_name", "category_name", "warehouse_id", "warehouse_name", "current_stock",
        speed.alias("avg_daily_units_sold"),
        F.round(speed * LEAD_TIME_DAYS).alias("reorder_point"),
        # NULL, not 0, for a product without sales.
        div0(F.col("current_stock"), F.nullif(F.col("avg_daily_units_sold"), F.lit(0.0)))
        .alias("days_of_stock_remaining"),
    )
    status = (
        F.when(F.col("current_stock") <= 0, "out_of_stock")
        .when(F.col("current_stock") <= F.col("reorder_point"), "reorder_now")
        .otherwise("ok")
    )
    alerts = joined.withColumn("stock_status", status)
    return rank_ascending(stage(alerts, "reorder-alerts"), "days_of_stock_remaining", "urgency_rank")
