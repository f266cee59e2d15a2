"""The serving layer: marts in the plain types reporting tools expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERVED = (
    "dim_customers", "fact_orders", "rpt_monthly_revenue", "dim_employees", "rpt_headcount_by_dept",
    "rpt_campaign_performance", "rpt_customer_acquisition_cohorts", "rpt_current_stock_levels",
    "rpt_inventory_reorder_alerts",
)

# Whole numbers that the report reads as decimals.
_AS_DOUBLE = {"tenure_years"}


def _served(field: T.StructField) -> Column:
    kind = field.dataType
    if isinstance(kind, T.DecimalType) or field.name in _AS_DOUBLE:
        return F.col(field.name).cast("double")
    if isinstance(kind, T.DateType):
        return F.col(field.name).cast("timestamp_ntz")
    if isinstance(kind, T.IntegerType):
        return F.col(field.name).cast("long")
    return F.col(field.name)


def serve(mart: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as timestamps, integers as 64 bit."""
    return mart.select(*[_served(field).alias(field.name) for field in mart.schema.fields])
