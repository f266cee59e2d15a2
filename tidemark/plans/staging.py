"""Staging: one function per raw table, raw rows in, standardised rows out.

``as_of`` is the run date as a date column; every "today" in a model is this
value, so a run can be repeated. Nothing here shuffles: each function is a
projection that Catalyst folds into the scan of its consumer.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    days_between,
    div0,
    month_start,
    quarter_start,
    weeks_crossed,
    years_crossed,
)


def _stamped(df: DataFrame, loaded: bool) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp()) if loaded else df


def _date(name: str) -> Column:
    return F.col(name).cast("date").alias(name)


def _time(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _lower(name: str) -> Column:
    return F.lower(name).alias(name)


def full_name() -> Column:
    return F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name")


def ad_spend(raw: DataFrame, loaded: bool = False) -> DataFrame:
    return _stamped(
        raw.select(
            "ad_spend_id", "campaign_id", _date("spend_date"), "impressions", "clicks", "spend_amount",
            _time("loaded_at"),
            month_start(F.col("spend_date").cast("date")).alias("spend_month"),
            div0(F.col("clicks"), F.col("impressions")).alias("click_through_rate"),
            div0(F.col("spend_amount"), F.col("clicks")).alias("cost_per_click"),
        ),
        loaded,
    )


def campaigns(raw: DataFrame, as_of: Column, loaded: bool = False) -> DataFrame:
    last_day = F.coalesce(F.col("end_date").cast("date"), as_of)
    return _stamped(
        raw.select(
            "campaign_id", "campaign_name", _lower("channel"), _date("start_date"), _date("end_date"), "budget",
            _lower("status"), _time("updated_at"),
            (weeks_crossed(F.col("start_date").cast("date"), last_day) + 1).alias("duration_weeks"),
        ),
        loaded,
    )


def customers(raw: DataFrame, as_of: Column, loaded: bool = False) -> DataFrame:
    return _stamped(
        raw.select(
            "customer_id", "first_name", "last_name", full_name(), _lower("email"), "phone", "city", "state",
            "country", _date("registration_date"), _date("date_of_birth"),
            F.upper("customer_segment").alias("customer_segment"), "credit_limit",
            F.col("is_active").cast("boolean").alias("is_active"),
            years_crossed(F.col("date_of_birth").cast("date"), as_of).alias("age"),
            days_between(F.col("registration_date").cast("date"), as_of).alias("days_since_registration"),
        ),
        loaded,
    )


def departments(raw: DataFrame, loaded: bool = False) -> DataFrame:
    return _stamped(raw.select("department_id", "department_name", "location", "manager_id", "budget"), loaded)


def employees(raw: DataFrame, as_of: Column, loaded: bool = False) -> DataFrame:
    salary = F.col("salary")
    return _stamped(
        raw.select(
            "employee_id", "first_name", "last_name", full_name(), _lower("email"), "phone", "department_id",
            "job_title", "salary", _date("hire_date"), "manager_id", _lower("employment_status"), "city", "state",
            years_crossed(F.col("hire_date").cast("date"), as_of).alias("tenure_years"),
            # A NULL salary fails every comparison and so counts as executive.
            F.when(salary < 80000, "junior")
            .when(salary < 120000, "mid")
            .when(salary < 160000, "senior")
            .otherwise("executive")
            .alias("salary_band"),
        ),
        loaded,
    )


def order_attribution(raw: DataFrame, loaded: bool = False) -> DataFrame:
    return _stamped(
        raw.select("order_id", "campaign_id", _lower("attribution_channel"), _time("attributed_at")), loaded
    )


def order_items(raw: DataFrame, loaded: bool = False) -> DataFrame:
    # Exact throughout, in types that need no rounding or narrowing per row.
    discount = F.expr("coalesce(discount_pct, cast(0 as decimal(5,2)))")
    gross = F.col("quantity").cast("decimal(12,0)") * F.col("unit_price")
    return _stamped(
        raw.select(
            "order_item_id", "order_id", "product_id", "quantity", "unit_price", discount.alias("discount_pct"),
            gross.alias("gross_amount"),
            (gross * (F.lit(1) - discount * F.lit(Decimal("0.01")))).alias("net_amount"),
        ),
        loaded,
    )


def orders(raw: DataFrame, loaded: bool = False) -> DataFrame:
    day = F.col("order_date").cast("date")
    delivered = F.lower("status") == "delivered"
    return _stamped(
        raw.select(
            "order_id", "customer_id", "employee_id", _date("order_date"), _lower("status"), "total_amount",
            "shipping_address_city", "shipping_address_state", _lower("payment_method"), "notes",
            month_start(day).alias("order_month"),
            quarter_start(day).alias("order_quarter"),
            F.year(day).cast("long").alias("order_year"),
            F.when(delivered, F.col("total_amount")).otherwise(F.lit(0)).cast("decimal(12,2)")
            .alias("delivered_amount"),
        ),
        loaded,
    )


def products(raw: DataFrame, loaded: bool = False) -> DataFrame:
    units = F.col("units_in_stock")
    return _stamped(
        raw.select(
            "product_id", "product_name", "category_id", "category_name", "unit_price", "units_in_stock", "supplier",
            F.col("is_active").cast("boolean").alias("is_active"),
            F.when(units == 0, "out_of_stock").when(units < 20, "low_stock").otherwise("in_stock")
            .alias("stock_status"),
        ),
        loaded,
    )


def stock_movements(raw: DataFrame, loaded: bool = False) -> DataFrame:
    return _stamped(
        raw.select(
            "movement_id", "product_id", "warehouse_id", _date("movement_date"), _lower("movement_type"),
            "quantity_change", _time("loaded_at"),
        ),
        loaded,
    )


def warehouses(raw: DataFrame, loaded: bool = False) -> DataFrame:
    return _stamped(
        raw.select(
            "warehouse_id", "warehouse_name", "city", "state", F.col("is_active").cast("boolean").alias("is_active")
        ),
        loaded,
    )
