"""One run: staging views, stored marts, incremental facts and campaign history.

``run`` may be repeated over the same folder. Marts are rebuilt whole, the two
incremental facts take rows newer than their watermark (or everything, with
``full_refresh``), and ``take_snapshot`` adds the campaign versions it has not
seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality, snapshot
from tidemark.operators.incremental import KeyedTable, newer_than
from tidemark.plans import inventory, marketing
from tidemark.plans.models import MARTS, Models
from tidemark.plans.naming import DOMAINS, SNAPSHOT_SCHEMA, target_schema
from tidemark.session import next_version, read_version, stage, versions, write_version
from tidemark.sources.schemas import RAW

_DOMAIN = {
    "dim_customers": "core", "fact_orders": "core", "rpt_monthly_revenue": "core",
    "dim_employees": "hr", "rpt_headcount_by_dept": "hr",
    "fact_ad_spend": "marketing", "rpt_campaign_performance": "marketing",
    "rpt_customer_acquisition_cohorts": "marketing",
    "fact_stock_movements": "inventory", "rpt_current_stock_levels": "inventory",
    "rpt_inventory_reorder_alerts": "inventory",
}

_KEYS = {"fact_ad_spend": "ad_spend_id", "fact_stock_movements": "movement_id"}


def mart_path(root: str, mart: str, default_schema: str = "PUBLIC") -> str:
    return f"{root}/{target_schema(default_schema, DOMAINS[_DOMAIN[mart]])}/{mart}"


def _fresh(models: Models, mart: str, target: DataFrame) -> DataFrame:
    """The rows of an incremental fact that are newer than the stored ones."""
    if mart == "fact_ad_spend":
        return marketing.fact_ad_spend(newer_than(models.stg_ad_spend, target), models.stg_campaigns)
    return inventory.fact_stock_movements(
        newer_than(models.stg_stock_movements, target), models.stg_products, models.stg_warehouses
    )


def _load(spark: SparkSession, models: Models, mart: str, path: str, full_refresh: bool) -> DataFrame:
    rows, key = getattr(models, mart), _KEYS[mart]
    if full_refresh or not KeyedTable(spark, path, rows.schema, key, 1).exists():
        staged = models.stg_ad_spend if mart == "fact_ad_spend" else models.stg_stock_movements
        table = KeyedTable.sized(path, staged, rows.schema, key)
        table.refresh(rows)
    else:
        table = KeyedTable.stored(spark, path, rows.schema, key)
        table.upsert(_fresh(models, mart, table.read()))
    return table.read()


def run(
    spark: SparkSession, models: Models, root: str, default_schema: str = "PUBLIC", full_refresh: bool = False
) -> dict[str, DataFrame]:
    """Build everything below ``root``; each mart reads the stored marts before it.

    The caller's ``models`` stay as they are. Every rebuild is a new version beside
    the old ones, so no mart is overwritten while it is read.
    """
    models = models.copy()
    for table in RAW:
        getattr(models, f"stg_{table}").createOrReplaceTempView(f"stg_{table}")
    stored = {}
    for mart in MARTS:
        path = mart_path(root, mart, default_schema)
        if mart in _KEYS:
            stored[mart] = _load(spark, models, mart, path, full_refresh)
        else:
            stored[mart] = write_version(getattr(models, mart), path)
        models.replace(mart, stored[mart])
    return stored


def check(stored: dict[str, DataFrame], checks: list[quality.Check], models: Models | None = None) -> DataFrame:
    """The report of those checks whose tables the run has written, or ``models`` has raw or as staging.

    Reads the stored tables as they are; nothing is built again or copied.
    """
    tables = dict(stored)
    if models is not None:
        tables |= {f"raw.{t}": getattr(models.raw, t) for t in RAW} | {f"stg_{t}": getattr(models, f"stg_{t}") for t in RAW}
    return quality.report(tables, [c for c in checks if c.table in tables and (not c.parent or c.parent in tables)])


def take_snapshot(spark: SparkSession, campaigns: DataFrame, root: str) -> DataFrame:
    """Add what a look at the campaigns finds to their history and return the history.

    Closed versions are only ever added to (below ``closed``, where all versions count); the
    open ones, one per campaign, are rewritten (below ``open``, where the last counts). A call
    that dies between the two writes leaves closed versions whose open form still
    counts; they are told apart by their id, and the next call closes them again.
    """
    base, key, stamp = f"{root}/{SNAPSHOT_SCHEMA}/campaigns_snapshot", "campaign_id", "updated_at"
    if not versions(spark, f"{base}/open"):
        return write_version(snapshot.first_snapshot(campaigns, key, stamp), f"{base}/open")
    current = read_version(spark, f"{base}/open")
    history = stage(snapshot.next_snapshot(current, campaigns, key, stamp), "history")
    closed = history.where(F.col("valid_to").isNotNull())
    if not closed.isEmpty():
        closed.write.parquet(next_version(spark, f"{base}/closed"))
    opened = write_version(history.where(F.col("valid_to").isNull()), f"{base}/open")
    done = versions(spark, f"{base}/closed")
    if not done:
        return opened
    past = spark.read.schema(history.schema).parquet(*[f"{base}/closed/_version={v}" for v in done])
    past = past.join(opened.select("version_id"), "version_id", "left_anti").dropDuplicates(["version_id"])
    return past.select(*opened.columns).unionByName(opened)
