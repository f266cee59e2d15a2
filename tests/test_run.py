"""Whole runs over one folder, repeated with changed sources."""

import os
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.plans.models import MARTS, Models
from tidemark.plans.checks import CHECKS
from tidemark.plans.run import _load, check, mart_path, run, take_snapshot
from tidemark.session import new_folder, read_version, stage, write_version
from tidemark.sources.ingest import RawTables
from tidemark.sources.sample import SampleTables
from tidemark.sources.schemas import RAW

EARLY = date(2000, 12, 31)


@pytest.fixture(scope="module")
def raw(spark, small):
    sample = SampleTables(spark, small)
    return SimpleNamespace(**{name: stage(getattr(sample, name), name) for name in RAW})


def until_early(raw):
    """The sources as they were: no ledger or spend rows loaded after EARLY."""
    cut = F.col("loaded_at") <= F.lit(EARLY).cast("timestamp_ntz")
    return SimpleNamespace(**{**vars(raw), "ad_spend": raw.ad_spend.where(cut),
                              "stock_movements": raw.stock_movements.where(cut)})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_second_run_catches_up(spark, raw):
    today = F.lit(date(2001, 8, 1))
    root = new_folder(spark, "test-run")
    first = run(spark, Models(until_early(raw), today), root)
    assert first["fact_ad_spend"].agg(F.max("loaded_at")).first()[0].date() <= EARLY
    before = first["fact_stock_movements"].count()

    second = run(spark, Models(raw, today), root)
    lazy = Models(raw, today)
    assert set(second) == set(MARTS)
    assert second["fact_stock_movements"].count() == raw.stock_movements.count() > before
    for mart in ("fact_ad_spend", "fact_stock_movements", "rpt_current_stock_levels", "rpt_campaign_performance"):
        assert rows(second[mart]) == rows(getattr(lazy, mart)), mart
    assert read_version(spark, mart_path(root, "fact_orders")).count() == raw.orders.count()
    assert spark.table("stg_orders").count() == raw.orders.count()


def test_full_refresh_drops_rows_that_left_the_source(spark, raw):
    today = F.lit(date(2001, 8, 1))
    models = Models(raw, today)
    root = new_folder(spark, "test-refresh")
    path = mart_path(root, "fact_ad_spend")
    assert _load(spark, models, "fact_ad_spend", path, False).count() == raw.ad_spend.count()
    early = Models(until_early(raw), today)
    assert _load(spark, early, "fact_ad_spend", path, False).count() == raw.ad_spend.count()
    assert _load(spark, early, "fact_ad_spend", path, True).count() == early.stg_ad_spend.count()


def test_snapshot_folders(spark, small):
    sample = SampleTables(spark, small)
    root = new_folder(spark, "test-snapshot")
    first = take_snapshot(spark, sample.campaigns_at(date(2000, 11, 15)), root)
    seen = first.count()
    second = take_snapshot(spark, sample.campaigns, root)
    assert second.count() > seen == first.count()
    assert second.where("valid_to is null").count() == second.select("campaign_id").distinct().count()
    assert rows(take_snapshot(spark, sample.campaigns, root)) == rows(second)


def test_run_twice_with_the_same_models(spark, raw):
    models, root = Models(raw, F.lit(date(2001, 8, 1))), new_folder(spark, "test-twice")
    once = {mart: rows(df) for mart, df in run(spark, models, root).items()}
    twice = run(spark, models, root)
    assert all(rows(twice[mart]) == once[mart] for mart in MARTS) and once["dim_employees"]


def test_raw_folder_load_times_and_checks(spark, raw):
    folder, root = new_folder(spark, "test-raw"), new_folder(spark, "test-run")
    for name in RAW:
        getattr(raw, name).write.parquet(f"{folder}/{name}")
    models = Models(RawTables(spark, folder), F.lit(date(2001, 8, 1)), loaded=True)
    stored = run(spark, models, root)
    lazy = Models(raw, F.lit(date(2001, 8, 1)))
    for mart in ("fact_orders", "rpt_monthly_revenue", "rpt_campaign_performance", "fact_stock_movements"):
        assert rows(stored[mart]) == rows(getattr(lazy, mart)), mart
    assert all("_loaded_at" in spark.table(f"stg_{table}").columns for table in RAW)
    report = check(stored, CHECKS, models).collect()
    assert len(report) == len(CHECKS) > len(check(stored, CHECKS).collect()) > 0
    assert not any(r.failures for r in report if r.test == "unique")
    with pytest.raises(AttributeError):
        models.raw.no_such_table


def test_dead_writes_do_not_block_the_next(spark, small):
    sample, root = SampleTables(spark, small), new_folder(spark, "test-dead")
    first = take_snapshot(spark, sample.campaigns_at(date(2000, 11, 15)), root)
    base = f"{root}/SNAPSHOTS/campaigns_snapshot" if "SNAPSHOTS" in first.inputFiles()[0] else first.inputFiles()[0][5:].split("/open/")[0]
    os.makedirs(f"{base}/open/_version=2")
    os.makedirs(f"{base}/closed/_version=1")
    second = take_snapshot(spark, sample.campaigns, root)
    assert rows(take_snapshot(spark, sample.campaigns, root)) == rows(second) and second.count() > first.count()
    path = f"{root}/mart"
    write_version(first, path)
    os.makedirs(f"{path}/_version=2")
    assert rows(write_version(read_version(spark, path), path)) == rows(first)


def test_customers_without_a_known_nation_stay(spark, small):
    folder = new_folder(spark, "test-nation")
    for table in ("customer", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{small}/{table}.parquet")
        if table in ("customer", "supplier"):
            key = df.columns[2]
            df = df.withColumn(key, F.when(F.col(df.columns[0]) % 3 > 0, F.col(key)))
        df.write.parquet(f"{folder}/{table}.parquet")
    models = Models(SampleTables(spark, folder), F.lit(date(2001, 8, 1)))
    whole = Models(SampleTables(spark, small), F.lit(date(2001, 8, 1)))
    assert models.stg_customers.count() == whole.stg_customers.count()
    assert models.stg_employees.count() == whole.stg_employees.count()


def test_ids_of_one_hot_order_and_part(spark, small):
    folder, sample = new_folder(spark, "test-hot"), SampleTables(spark, small)
    for table in ("customer", "supplier", "nation", "region", "part", "orders"):
        spark.read.parquet(f"{small}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    lines = sample.given("lineitem")
    hot = F.lit(7).cast("long")
    lines.withColumns({"l_orderkey": hot, "l_partkey": F.col("l_partkey") % 2}).write.parquet(f"{folder}/lineitem.parquet")
    sample = SampleTables(spark, folder)
    n = lines.count()
    items = sample.order_items.agg(F.count_distinct("order_item_id"), F.min("order_item_id"), F.max("order_item_id")).first()
    assert tuple(items) == (n, 1, n)
    ledger = sample.stock_movements.agg(F.count_distinct("movement_id"), F.count(F.lit(1)), F.max("movement_id")).first()
    assert ledger[0] == ledger[1] == ledger[2] > n
