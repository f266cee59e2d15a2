"""Deterministic sample data: ad spend, attribution and the stock ledger.

Rows are generated inside Spark from the raw tables they refer to. "Random"
values are hashes of the row's keys, so a rerun gives the same rows, on any
number of executors.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import add_weeks, hash_bucket, stable_hash, week_start, weeks_crossed
from tidemark.operators.joins import choose_by_hash, interval_join, with_every
from tidemark.operators.ordered import numbered, running_sum
from tidemark.session import COMPACT, spread, stage

# Cost per click in cents and clicks per thousand impressions by channel.
COST_PER_CLICK = {
    "google_ads": 120, "facebook_ads": 85, "instagram_ads": 95, "tiktok_ads": 60, "email": 15, "affiliate": 200,
}
CLICKS_PER_THOUSAND = {
    "google_ads": 30, "facebook_ads": 15, "instagram_ads": 18, "tiktok_ads": 25, "email": 80, "affiliate": 40,
}
# Share of orders attributed (percent), ids, restock rhythm and sizes.
ATTRIBUTED_PERCENT = 65
FIRST_SPEND_ID = 6000
RESTOCK_CYCLES, RESTOCK_WEEKS = 8, 8
RESTOCK_LEAST, RESTOCK_SPREAD = 30, 40
CORRECTION_ONE_IN = 60
CORRECTION_DAYS_LEAST, CORRECTION_DAYS_SPREAD = 5, 30
ADJUSTMENT_MOST, RETURN_MOST = 8, 5


def _by_channel(values: dict[str, int]) -> Column:
    result = F.lit(None).cast("long")
    for channel, value in values.items():
        result = F.when(F.lower("channel") == channel, F.lit(value).cast("long")).otherwise(result)
    return result


def _rounded_ratio(numerator: str, denominator: str) -> Column:
    """Quotient of two non-negative longs, rounded half up, in whole numbers."""
    return F.expr(f"(2 * ({numerator}) + ({denominator})) div (2 * ({denominator}))")


def ad_spend(campaigns: DataFrame, as_of: Column) -> DataFrame:
    """One row per campaign and week it ran: an even share of the budget, +-30 %.

    The id numbers the rows by campaign and date. Only campaigns are put in
    order, with the number of weeks before each; the weeks then count themselves.
    """
    last_day = F.coalesce(F.col("end_date"), as_of)
    spans = (
        campaigns.withColumn("_first", week_start(F.col("start_date")))
        .withColumn("_last", last_day)
        .where(F.col("_first") <= F.col("_last"))
        .select(
            "campaign_id", "_first",
            (weeks_crossed(F.col("_first"), F.col("_last")) + 1).alias("_weeks"),
            (F.col("budget") * 100).cast("long").alias("_budget"),
            _by_channel(COST_PER_CLICK).alias("_cpc"),
            _by_channel(CLICKS_PER_THOUSAND).alias("_ctr"),
        )
    )
    numbered = running_sum(
        spans, "_weeks", "_upto", [], F.floor(F.col("campaign_id") / 1000), [F.col("campaign_id")]
    )
    weekly = numbered.withColumn("_week", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_weeks") - 1)))
    # Between 0.70 and 1.30 of the weekly budget, in ten-thousandths.
    share = 7000 + 6 * hash_bucket(1000, F.col("campaign_id"), F.col("_week"))
    spend_date = add_weeks(F.col("_first"), F.col("_week"))
    return (
        weekly.withColumn("_share", share)
        .withColumn("_cents", _rounded_ratio("_budget * _share", "_weeks * 10000"))
        .withColumn("clicks", _rounded_ratio("_cents", "_cpc"))
        .select(
            (F.col("_upto") - F.col("_weeks") + F.col("_week") + 1 + FIRST_SPEND_ID).alias("ad_spend_id"),
            "campaign_id",
            spend_date.alias("spend_date"),
            _rounded_ratio("clicks * 1000", "_ctr").alias("impressions"),
            "clicks",
            (F.col("_cents").cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).alias("spend_amount"),
            spend_date.cast("timestamp_ntz").alias("loaded_at"),
        )
    )


def eligible_campaigns(orders: DataFrame, campaigns: DataFrame, as_of: Column) -> DataFrame:
    """Pairs of an order and a campaign that ran on the order date."""
    windows = campaigns.select(
        "campaign_id", "channel", "start_date", F.coalesce(F.col("end_date"), as_of).alias("_last")
    )
    return interval_join(
        orders.select("order_id", "order_date"), "order_date", windows, "start_date", "_last"
    ).select("order_id", "order_date", "campaign_id", "channel")


def order_attribution(orders: DataFrame, campaigns: DataFrame, as_of: Column) -> DataFrame:
    """Credit 65 % of the orders, chosen by hash, to one eligible campaign each.

    Orders are spread by id first, and sampled before the interval join. While the
    campaigns are small enough to broadcast, joining and choosing then need no
    other shuffle; else a partial minimum keeps one row per order in each task.
    """
    sampled = spread(orders.select("order_id", "order_date"), "order_id").where(
        hash_bucket(100, F.col("order_id")) < ATTRIBUTED_PERCENT
    )
    pairs = eligible_campaigns(sampled, campaigns, as_of)
    # Hash, then id, as one exact number: a plain minimum that a hash aggregate keeps in place.
    place = stable_hash(F.col("order_id"), F.col("campaign_id")).cast("decimal(10,0)") * F.lit(
        "100000000000000000000"
    ).cast("decimal(21,0)") + F.col("campaign_id").cast("decimal(19,0)")
    chosen = pairs.groupBy("order_id", "order_date").agg(F.min_by("campaign_id", place).alias("campaign_id"))
    channel = campaigns.select("campaign_id", F.col("channel").alias("attribution_channel"))
    return chosen.join(channel, "campaign_id").select(
        "order_id", "campaign_id", "attribution_channel", F.col("order_date").cast("timestamp_ntz").alias("attributed_at")
    )


def _ledger_rows(df: DataFrame, source: Column, day: Column, kind: Column, quantity: Column) -> DataFrame:
    return df.select(
        source.alias("_source"), "product_id", "warehouse_id", day.alias("movement_date"),
        kind.alias("movement_type"), quantity.cast("long").alias("quantity_change"),
        day.cast("timestamp_ntz").alias("loaded_at"),
    )


def restock_grid(products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Every product, warehouse and restock cycle, generated inside each product row.

    The narrow product rows are spread first, because each one multiplies.
    """
    return with_every(spread(products.select("product_id"), "product_id"), warehouses, "warehouse_id").withColumn(
        "_cycle", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(RESTOCK_CYCLES - 1).cast("long")))
    )


def ledger(
    products: DataFrame, warehouses: DataFrame, items: DataFrame, orders: DataFrame, first_restock: date
) -> DataFrame:
    """Restocks, their occasional corrections, and one sale per order item, without ids.

    ``_source`` is the product or order item a row comes from.
    """
    grid = restock_grid(products, warehouses)
    cell = [F.col("product_id"), F.col("warehouse_id"), F.col("_cycle")]
    day = add_weeks(F.lit(first_restock), F.col("_cycle") * RESTOCK_WEEKS)

    restocks = _ledger_rows(
        grid, F.col("product_id"), day, F.lit("restock"), RESTOCK_LEAST + hash_bucket(RESTOCK_SPREAD, *cell)
    )
    picked = grid.where(hash_bucket(CORRECTION_ONE_IN, *cell, F.lit("pick")) == 0)
    is_adjustment = hash_bucket(2, *cell, F.lit("kind")) == 0
    size = stable_hash(*cell, F.lit("qty"))
    delay = CORRECTION_DAYS_LEAST + hash_bucket(CORRECTION_DAYS_SPREAD, *cell, F.lit("day"))
    corrections = _ledger_rows(
        picked,
        F.col("product_id"),
        F.date_add(day, delay.cast("int")),
        F.when(is_adjustment, "adjustment").otherwise("return"),
        F.when(is_adjustment, -(1 + size % ADJUSTMENT_MOST)).otherwise(1 + size % RETURN_MOST),
    )
    sold = items.select("order_item_id", "order_id", "product_id", "quantity").join(
        orders.select("order_id", "order_date"), "order_id"
    )
    sales = _ledger_rows(
        choose_by_hash(sold, "order_item_id", warehouses, "warehouse_id"),
        F.col("order_item_id"), F.col("order_date"), F.lit("sale"), -F.col("quantity"),
    )
    return restocks.unionByName(corrections).unionByName(sales)


def stock_movements(
    products: DataFrame, warehouses: DataFrame, items: DataFrame, orders: DataFrame, first_restock: date
) -> DataFrame:
    """The ledger with ids by date, so that a later load has the greater ids; within a date by type, source and warehouse.

    Staged first, as the range shuffle reads its rows twice, once to sample them.
    """
    rows = stage(ledger(products, warehouses, items, orders, first_restock), "ledger", **COMPACT)
    order = [F.col("_source"), F.col("warehouse_id"), F.col("product_id"), F.col("quantity_change")]
    return numbered(rows, "movement_id", F.col("movement_date"), F.col("movement_type"), order)
