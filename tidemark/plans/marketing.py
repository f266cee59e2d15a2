"""Marketing marts: ad spend, campaign performance, acquisition cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import div0, months_crossed
from tidemark.operators.ordered import running_sum


def fact_ad_spend(ad_spend: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Weekly spend with the campaign's attributes as of the load."""
    campaign = campaigns.select("campaign_id", "campaign_name", "channel", F.col("status").alias("campaign_status"))
    return ad_spend.join(campaign, "campaign_id", "left").select(
        "ad_spend_id", "campaign_id", "campaign_name", "channel", "campaign_status", "spend_date", "spend_month",
        "impressions", "clicks", "spend_amount", "click_through_rate", "cost_per_click", "loaded_at",
    )


def campaign_performance(
    campaigns: DataFrame, spend: DataFrame, attribution: DataFrame, orders: DataFrame
) -> DataFrame:
    """Spend, attributed revenue and return per campaign.

    Both sides are summed per campaign before they are joined. Shown totals turn
    NULL into 0; ratios, the rank and the running sum use the NULLs, and a NULL
    return ranks first.
    """
    spent = spend.groupBy("campaign_id").agg(
        F.sum("impressions").alias("_impressions"),
        F.sum("clicks").alias("_clicks"),
        F.sum("spend_amount").alias("_spend"),
    )
    earned = (
        attribution.select("campaign_id", "order_id")
        .join(orders.select("order_id", "revenue"), "order_id", "left")
        .groupBy("campaign_id")
        .agg(F.count_distinct("order_id").alias("_orders"), F.sum("revenue").alias("_revenue"))
    )
    # The running sum over all campaigns goes day by day; campaign_id settles equal start dates.
    summed = running_sum(
        campaigns.join(spent, "campaign_id", "left"), "_spend", "cumulative_spend_by_start_date", [],
        F.col("start_date"), [F.col("campaign_id")],
    )
    joined = summed.join(earned, "campaign_id", "left").withColumn("roas", div0(F.col("_revenue"), F.col("_spend")))
    in_channel = Window.partitionBy("channel").orderBy(F.col("roas").desc_nulls_first())
    zero = F.lit(0)
    return joined.select(
        "campaign_id", "campaign_name", "channel", "status", "start_date", "end_date", "budget",
        F.coalesce("_impressions", zero).alias("total_impressions"),
        F.coalesce("_clicks", zero).alias("total_clicks"),
        F.coalesce("_spend", zero).alias("total_spend"),
        div0(F.col("_clicks"), F.col("_impressions")).alias("click_through_rate"),
        div0(F.col("_spend"), F.col("_clicks")).alias("cost_per_click"),
        F.coalesce("_orders", zero).alias("attributed_orders"),
        F.coalesce("_revenue", zero).alias("attributed_revenue"),
        "roas",
        F.rank().over(in_channel).cast("long").alias("roas_rank_in_channel"),
        "cumulative_spend_by_start_date",
    )


def acquisition_cohorts(orders: DataFrame) -> DataFrame:
    """Retention and cumulative revenue of customers by month of first delivery.

    Orders shrink to one row per customer and month at once; everything after
    that, the windows included, has at most one row per month in any group.
    """
    monthly = (
        orders.where(F.col("status") == "delivered")
        .groupBy("customer_id", "order_month")
        .agg(F.sum("delivered_amount").alias("_amount"))
        .withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("customer_id")))
    )
    # Orders without a customer have no activity, but count as one member of their cohort.
    cells = monthly.groupBy("cohort_month", "order_month").agg(
        F.count("customer_id").alias("active_customers"),
        F.sum(F.when(F.col("customer_id").isNotNull(), F.col("_amount"))).alias("revenue"),
        F.count(F.lit(1)).alias("_members"),
    )
    cohort = Window.partitionBy("cohort_month")
    so_far = cohort.orderBy("order_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_cell = F.when(F.col("order_month") == F.col("cohort_month"), F.col("_members"))
    return (
        cells.withColumn("cohort_size", F.max(first_cell).over(cohort))
        .withColumn("cumulative_cohort_revenue", F.sum("revenue").over(so_far))
        .where(F.col("active_customers") > 0)
        .select(
            "cohort_month", "order_month",
            months_crossed(F.col("cohort_month"), F.col("order_month")).alias("months_since_acquisition"),
            "cohort_size", "active_customers",
            div0(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
            "revenue", "cumulative_cohort_revenue",
        )
        .orderBy("cohort_month", "order_month")
    )
