"""Every query by name, over the sample tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark.functions import div0, hash_bucket, stable_hash
from tidemark.operators import quality, snapshot
from tidemark.operators.incremental import KeyedTable, newer_than
from tidemark.operators.joins import choose_by_hash, interval_join
from tidemark.plans import core, hr, inventory, marketing, metrics, serving, staging
from tidemark.plans.checks import CHECKS
from tidemark.plans.models import MARTS, Models
from tidemark.session import new_folder, read_version, stage, stage_all, write_version
from tidemark.sources import generators
from tidemark.sources.ingest import append, conform, literal_rows, row_counts
from tidemark.sources.sample import AS_OF, SampleTables
from tidemark.sources.schemas import RAW
from tidemark.streaming.ledger import drain_into

Query = Callable[[SparkSession, str], DataFrame]

# Days on which the repeated loads and snapshots look at the source.
SPEND_FIRST_LOAD = date(2000, 12, 31)
LEDGER_FIRST_LOAD = date(1999, 12, 31)
FIRST_SNAPSHOT = date(2000, 11, 15)
LOOK_BACK = date(2001, 1, 15)

# A literal table of three warehouses.
THREE_WAREHOUSES = [
    (6001, "West Coast DC", "Reno", "NV", True),
    (6002, "Central DC", "Dallas", "TX", True),
    (6003, "East Coast DC", "Newark", "NJ", True),
]

STAGING = tuple(f"stg_{table}" for table in RAW)


def models(spark: SparkSession, folder: str) -> Models:
    raw = SampleTables(spark, folder)
    return Models(raw, raw.as_of)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as longs, for comparison with other engines."""

    def cast(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(field) for field in df.schema.fields])


def _model(name: str) -> Query:
    return lambda spark, folder: plain(getattr(models(spark, folder), name))


def _raw(name: str) -> Query:
    return lambda spark, folder: plain(getattr(SampleTables(spark, folder), name))


def _served(name: str) -> Query:
    return lambda spark, folder: serving.serve(getattr(models(spark, folder), name))


def _over(build: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(models(spark, folder)))


# Incremental loads


def incremental_ad_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads: the second brings new weeks and restates the last month of the first."""
    m = models(spark, folder)
    spend = stage(m.raw.ad_spend, "ad-spend")
    in_first_month = F.trunc("spend_date", "MM") == F.lit(SPEND_FIRST_LOAD.replace(day=1))
    restated = (
        spend.where(in_first_month)
        .withColumn("spend_amount", (F.col("spend_amount") * 2).cast(RAW["ad_spend"]["spend_amount"].dataType))
        .withColumn("loaded_at", F.lit(AS_OF).cast("timestamp_ntz"))
    )
    loads = [
        spend.where(F.col("loaded_at") <= F.lit(SPEND_FIRST_LOAD).cast("timestamp_ntz")),
        spend.where(~in_first_month).unionByName(restated),
    ]
    campaigns = m.stg_campaigns
    schema = marketing.fact_ad_spend(staging.ad_spend(spend), campaigns).schema
    table = KeyedTable.sized(new_folder(spark, "fact-ad-spend"), loads[0], schema, "ad_spend_id")
    for source in loads:
        source = staging.ad_spend(source)
        fresh = newer_than(source, table.read()) if table.exists() else source
        table.upsert(marketing.fact_ad_spend(fresh, campaigns))
    return plain(table.read())


_IN_FIRST_LOAD = f"loaded_at <= timestamp_ntz '{LEDGER_FIRST_LOAD}' and movement_type <> 'return'"


def _ledger_loads(m: Models) -> tuple[DataFrame, list[DataFrame]]:
    """The whole ledger, and what the source shows at the first and second load.

    Returns booked before the first load reach the source after it: they are
    older than the watermark then.
    """
    ledger = m.raw.stock_movements
    return ledger, [ledger.where(_IN_FIRST_LOAD), ledger]


def _load_ledger(spark: SparkSession, m: Models) -> tuple[KeyedTable, DataFrame]:
    ledger, loads = _ledger_loads(m)

    def enrich(movements: DataFrame) -> DataFrame:
        return inventory.fact_stock_movements(movements, m.stg_products, m.stg_warehouses)

    whole = enrich(staging.stock_movements(ledger))
    table = KeyedTable.sized(new_folder(spark, "fact-stock-movements"), loads[0], whole.schema, "movement_id")
    for source in loads:
        source = staging.stock_movements(source)
        fresh = newer_than(source, table.read()) if table.exists() else source
        table.upsert(enrich(fresh))
    return table, whole


def incremental_stock_movements(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_load_ledger(spark, models(spark, folder))[0].read())


def incremental_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """After the two loads, a full refresh picks up the rows that came late."""
    table, whole = _load_ledger(spark, models(spark, folder))
    table.refresh(whole)
    return plain(table.read())


def stream_incremental_movements(spark: SparkSession, folder: str) -> DataFrame:
    """The same ledger as files landing in two rounds, drained by a stream after each."""
    m = models(spark, folder)
    ledger, (first, _) = _ledger_loads(m)
    rounds = [first, ledger.where(f"not coalesce({_IN_FIRST_LOAD}, false)")]

    def enrich(movements: DataFrame) -> DataFrame:
        return inventory.fact_stock_movements(
            staging.stock_movements(movements), m.stg_products, m.stg_warehouses
        )

    landing, checkpoint = new_folder(spark, "landing"), new_folder(spark, "stream-checkpoint")
    table = KeyedTable.sized(new_folder(spark, "stream-movements"), first, enrich(ledger).schema, "movement_id")
    for rows in rounds:
        append(rows, "stock_movements", landing)
        drain_into(table, landing, RAW["stock_movements"], enrich, checkpoint)
    return plain(table.read())


def mart_rebuild_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A mart rebuilt from itself: the second build reads the version it replaces."""
    path = new_folder(spark, "rebuild")
    write_version(models(spark, folder).fact_orders, path)
    write_version(read_version(spark, path), path)
    return plain(read_version(spark, path))


# History


def _campaign_history(spark: SparkSession, folder: str) -> DataFrame:
    raw = SampleTables(spark, folder)
    key, stamp = "campaign_id", "updated_at"
    history = stage(snapshot.first_snapshot(raw.campaigns_at(FIRST_SNAPSHOT), key, stamp), "history")
    for _ in range(2):
        history = stage(snapshot.next_snapshot(history, raw.campaigns, key, stamp), "history")
    return history


def campaigns_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """History after one early and two equal late looks at the campaigns."""
    return plain(_campaign_history(spark, folder))


def snapshot_as_of(spark: SparkSession, folder: str) -> DataFrame:
    moment = F.lit(LOOK_BACK).cast("timestamp_ntz")
    return plain(snapshot.valid_at(_campaign_history(spark, folder), moment))


# Sources


def fixture_warehouses(spark: SparkSession, folder: str) -> DataFrame:
    """Three literal warehouses and the units each ships when items choose by hash."""
    warehouses = literal_rows(spark, "warehouses", THREE_WAREHOUSES)
    items = SampleTables(spark, folder).order_items.select("order_item_id", "quantity")
    shipped = (
        choose_by_hash(items, "order_item_id", warehouses, "warehouse_id")
        .groupBy("warehouse_id")
        .agg(F.count(F.lit(1)).alias("shipments"), F.sum("quantity").alias("units"))
    )
    return warehouses.join(shipped, "warehouse_id", "left")


def ingest_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Order items delivered without a quantity: it becomes 1, NULL discounts stay NULL."""
    items = SampleTables(spark, folder).order_items
    return plain(conform(items.drop("quantity"), "order_items"))


def row_count_report(spark: SparkSession, folder: str) -> DataFrame:
    raw = SampleTables(spark, folder)
    return row_counts({table: getattr(raw, table) for table in RAW})


def range_join_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """How many orders each campaign could have earned, and over which dates.

    Orders are counted per day first, so the join meets days and campaigns, never single orders.
    """
    raw = SampleTables(spark, folder)
    days = raw.orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("_orders"))
    windows = raw.campaigns.select(
        "campaign_id", "channel", "start_date", F.coalesce(F.col("end_date"), raw.as_of).alias("_last")
    )
    return (
        interval_join(days, "order_date", windows, "start_date", "_last")
        .groupBy("campaign_id", "channel")
        .agg(
            F.sum("_orders").alias("eligible_orders"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )


# Scalars


def _scalar_div0(m: Models) -> DataFrame:
    units = F.col("units_in_stock")
    return m.stg_products.select(
        "product_id",
        div0(F.col("unit_price"), units).alias("price_per_unit"),
        div0(units, F.lit(0)).alias("by_zero"),
        div0(units, F.lit(None).cast("long")).alias("by_null"),
        div0(F.col("category_id"), units).alias("null_over_units"),
        div0(units, F.nullif(units, F.lit(0))).alias("null_when_empty"),
    )


def _scalar_dates(m: Models) -> DataFrame:
    d, today = F.col("order_date"), m.as_of
    return m.stg_orders.select(
        "order_id", "order_date",
        fn.week_start(d).alias("week_start"),
        fn.month_start(d).alias("month_start"),
        fn.quarter_start(d).alias("quarter_start"),
        F.year(d).alias("year"),
        fn.days_between(d, today).alias("days"),
        fn.weeks_crossed(d, today).alias("weeks"),
        fn.months_crossed(d, today).alias("months"),
        fn.years_crossed(d, today).alias("years"),
        F.date_add(d, 5).alias("plus_five_days"),
        fn.add_weeks(d, F.lit(8)).alias("plus_eight_weeks"),
        d.between(F.lit(FIRST_SNAPSHOT), today).alias("in_window"),
    )


def _scalar_case_null(m: Models) -> DataFrame:
    born = F.col("date_of_birth")
    return m.stg_customers.select(
        "customer_id",
        born.isNull().alias("no_birth_date"),
        F.coalesce(F.col("age"), F.lit(-1)).alias("age_or_default"),
        F.nullif(F.col("customer_segment"), F.lit("SUPPLIER")).alias("buyer_segment"),
        F.when(F.col("age") >= 50, "senior").when(F.col("age") >= 30, "middle").otherwise("young_or_unknown")
        .alias("age_group"),
        (F.col("is_active") & (F.col("credit_limit") > 0)).alias("has_credit"),
    )


def _scalar_strings(m: Models) -> DataFrame:
    return m.raw.customers.select(
        "customer_id", staging.full_name(),
        F.lower("email").alias("email"),
        F.upper("customer_segment").alias("segment"),
        F.concat(F.col("first_name"), F.lit(" "), F.col("phone")).alias("name_and_phone"),
    )


def _scalar_hash_bucket(m: Models) -> DataFrame:
    key = F.col("order_item_id")
    return m.raw.order_items.select(
        "order_item_id",
        stable_hash(key).alias("hash"),
        hash_bucket(100, key).alias("percent"),
        hash_bucket(60, key, F.col("product_id"), F.lit("pick")).alias("one_in_60"),
    )


def _scalar_round(m: Models) -> DataFrame:
    return m.stg_order_items.select(
        "order_item_id",
        F.round("net_amount").alias("whole"),
        F.round("net_amount", 2).alias("cents"),
        F.round(-F.col("net_amount"), 2).alias("negative_cents"),
        (F.col("quantity") % 7).alias("rest"),
        (-F.col("quantity")).alias("negated"),
    )


# Data quality


# The generated raw tables that checked tables other than raw ones read, with their ids.
_GENERATED = {
    "fact_ad_spend": {"ad_spend"},
    "fact_stock_movements": {"stock_movements"},
    "rpt_campaign_performance": {"ad_spend", "order_attribution"},
}


def checked_tables(spark: SparkSession, folder: str, checks: list[quality.Check]) -> dict[str, DataFrame]:
    """The tables the checks name, with the columns checked.

    A table that several checks read is staged, with those columns alone; one that a
    single pass reads is not. The generated raw tables that the named ones are made of
    are staged once, the ledger without its ids where no check reads them; the others are
    not built. Stock levels that reorder alerts are made of are stored.
    """
    m = models(spark, folder)
    columns: dict[str, dict[str, None]] = {}
    passes: dict[str, set] = {}
    for c in checks:
        columns.setdefault(c.table, {}).update(dict.fromkeys(c.columns))
        passes.setdefault(c.table, set()).add("not_null" if c.kind == "not_null" else c)
        if c.parent:
            columns.setdefault(c.parent, {})[c.parent_column] = None
            passes.setdefault(c.parent, set()).add(c)
    sources = {name: {name[4:]} if name.startswith("raw.") else _GENERATED.get(name, set()) for name in columns}
    wanted = {table for name in sources for table in sources[name]}
    numbers = any("movement_id" in columns.get(name, ()) for name in ("raw.stock_movements", "fact_stock_movements"))
    for tables in (("order_items",), ("ad_spend", "order_attribution", "stock_movements")):
        source = {t: t if t != "stock_movements" or numbers else "stock_lines" for t in tables if t in wanted}
        for table, stored in stage_all({t: getattr(m.raw, name) for t, name in source.items()}).items():
            setattr(m.raw, table, stored)
            if table == "stock_movements":
                m.raw.stock_lines = stored
    if {"rpt_current_stock_levels", "rpt_inventory_reorder_alerts"} <= set(columns):
        m.store("rpt_current_stock_levels")

    def narrow(name: str) -> DataFrame:
        df = getattr(m.raw, name[4:]) if name.startswith("raw.") else getattr(m, name)
        return df.select(*columns[name])

    tables = {name: narrow(name) for name in columns}
    return tables | stage_all({name: df for name, df in tables.items() if len(passes[name]) > 1 and not name.startswith("raw.")})


def _checks(*kinds: str) -> Query:
    chosen = [c for c in CHECKS if not kinds or c.kind in kinds]
    return lambda spark, folder: quality.report(checked_tables(spark, folder, chosen), chosen)


QUERIES: dict[str, Query] = {
    **{name: _model(name) for name in STAGING},
    **{name: _model(name) for name in MARTS},
    "stock_running_balance": _over(
        lambda m: inventory.balanced_ledger(m.stg_stock_movements, m.stg_products, m.stg_warehouses)
    ),
    "stock_levels_agg_form": _over(lambda m: inventory.stock_totals(m.stock_lines)),
    "sales_velocity": _model("sales_velocity"),
    "salary_distribution": _over(lambda m: hr.salary_distribution(m.dim_employees)),
    "top_customers_by_ltv": _over(lambda m: core.top_customers(m.dim_customers)),
    "campaigns_snapshot": campaigns_snapshot,
    "snapshot_as_of": snapshot_as_of,
    "incremental_ad_spend": incremental_ad_spend,
    "incremental_stock_movements": incremental_stock_movements,
    "incremental_full_refresh": incremental_full_refresh,
    "stream_incremental_movements": stream_incremental_movements,
    "mart_rebuild_roundtrip": mart_rebuild_roundtrip,
    "gen_ad_spend": _raw("ad_spend"),
    "gen_order_attribution": _raw("order_attribution"),
    "gen_stock_movements": _raw("stock_movements"),
    "range_join_attribution": range_join_attribution,
    "fixture_warehouses": fixture_warehouses,
    "ingest_defaults": ingest_defaults,
    "row_count_report": row_count_report,
    **{f"serving_{name}": _served(name) for name in serving.SERVED},
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_relationships": _checks("relationships"),
    "dq_accepted_values": _checks("accepted_values"),
    "dq_unique_combination": _checks("unique_combination"),
    "dq_report": _checks(),
    "metric_total_revenue": _over(lambda m: metrics.total_revenue(m.order_amounts)),
    "metric_total_orders": _over(lambda m: metrics.total_orders(m.order_amounts)),
    "metric_avg_order_value": _over(lambda m: metrics.average_order_value(m.order_amounts)),
    "metric_products_needing_reorder": _over(
        lambda m: metrics.products_needing_reorder(m.rpt_inventory_reorder_alerts)
    ),
    "metric_by_segment": _over(
        lambda m: metrics.order_metrics_by(m.order_amounts, "customer_id", m.stg_customers, "customer_segment")
    ),
    "metric_by_department": _over(
        lambda m: metrics.order_metrics_by(m.order_amounts, "employee_id", m.dim_employees, "department_name")
    ),
    "report_campaign_table": _over(lambda m: metrics.campaign_table(m.rpt_campaign_performance)),
    "scalar_div0": _over(_scalar_div0),
    "scalar_dates": _over(_scalar_dates),
    "scalar_case_null": _over(_scalar_case_null),
    "scalar_strings": _over(_scalar_strings),
    "scalar_hash_bucket": _over(_scalar_hash_bucket),
    "scalar_round": _over(_scalar_round),
}
