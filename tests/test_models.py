"""Models on hand-made raw tables: boundaries, NULLs and ties."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import core, hr, inventory, marketing, metrics, serving, staging
from tidemark.plans.catalog import QUERIES
from tidemark.plans.checks import CHECKS
from tidemark.plans.models import Models
from tidemark.plans.naming import target_schema
from tidemark.session import new_folder, stage
from tidemark.sources import generators, sample
from tidemark.sources.ingest import append, conform, literal_rows, read_raw, row_counts
from tidemark.sources.sample import SampleTables
from tidemark.sources.schemas import RAW

TODAY = date(2024, 3, 1)
NOON = datetime(2024, 1, 1, 12)


def as_of():
    return F.lit(TODAY)


def table(spark, name, *records):
    """Raw rows from dicts; columns left out are NULL."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in RAW[name].fields])
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in records], schema)


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def order(order_id, customer, amount=0, status="delivered", day=TODAY, **more):
    return dict(
        order_id=order_id, customer_id=customer, order_date=day, status=status,
        total_amount=Decimal(str(amount)), **more,
    )


# Staging


def test_salary_bands_and_tenure(spark):
    salaries = [79999.99, 80000, 119999.99, 120000, 159999.99, 160000, None]
    raw = table(
        spark, "employees",
        *[
            dict(employee_id=i, salary=None if s is None else Decimal(str(s)), hire_date=date(2023, 12, 31),
                 first_name="A", last_name="B", employment_status="ACTIVE")
            for i, s in enumerate(salaries)
        ],
    )
    out = staging.employees(raw, as_of())
    assert list(by(out, "employee_id", "salary_band").values()) == [
        "junior", "mid", "mid", "senior", "senior", "executive", "executive",
    ]
    assert set(by(out, "employee_id", "tenure_years").values()) == {1}
    assert out.first()["full_name"] == "A B" and out.first()["employment_status"] == "active"


def test_stock_status(spark):
    raw = table(spark, "products", *[dict(product_id=i, units_in_stock=u) for i, u in enumerate([0, 19, 20, -1, None])])
    assert list(by(staging.products(raw), "product_id", "stock_status").values()) == [
        "out_of_stock", "low_stock", "in_stock", "low_stock", "in_stock",
    ]


def test_order_item_amounts(spark):
    raw = table(
        spark, "order_items",
        dict(order_item_id=1, quantity=3, unit_price=Decimal("19.99"), discount_pct=Decimal("12.50")),
        dict(order_item_id=2, quantity=1, unit_price=Decimal("0.01"), discount_pct=None),
    )
    out = by(staging.order_items(raw), "order_item_id", "gross_amount", "net_amount", "discount_pct")
    assert out[1] == (Decimal("59.97"), Decimal("52.47375"), Decimal("12.50"))
    assert out[2] == (Decimal("0.01"), Decimal("0.01"), Decimal("0.00"))


def test_campaign_duration_and_open_end(spark):
    raw = table(
        spark, "campaigns",
        dict(campaign_id=1, channel="Google_Ads", status="ACTIVE", start_date=date(2023, 1, 1), end_date=date(2023, 3, 31)),
        dict(campaign_id=2, channel="email", status="active", start_date=date(2024, 2, 25), end_date=None),
    )
    out = by(staging.campaigns(raw, as_of()), "campaign_id", "duration_weeks", "channel", "status")
    assert out == {1: (14, "google_ads", "active"), 2: (2, "email", "active")}


def test_load_time_is_optional(spark):
    raw = table(spark, "departments", dict(department_id=1))
    assert "_loaded_at" not in staging.departments(raw).columns
    assert staging.departments(raw, loaded=True).columns[-1] == "_loaded_at"


# Core


def customers_with_orders(spark, orders):
    raw = table(
        spark, "customers",
        *[dict(customer_id=i, first_name="C", last_name=str(i), email=f"C{i}@X", is_active=i != 3) for i in range(1, 12)],
    )
    return core.dim_customers(
        staging.customers(raw, as_of()), staging.orders(table(spark, "orders", *orders)), as_of()
    )


def test_rfm_boundaries(spark):
    def ago(days):
        return TODAY - timedelta(days=days)

    orders = [order(100, 1, 5000), order(101, 2, 4999.99)]
    orders += [order(200 + i, 3, 500) for i in range(4)]  # 2000 with 4 orders
    orders += [order(300 + i, 4, 400) for i in range(5)]  # 2000 with 5 orders
    orders += [order(400, 5, 1000), order(401, 6, 999.99, day=ago(90)), order(402, 7, 1, day=ago(91))]
    orders += [order(403, 8, 1, day=ago(180)), order(404, 9, 1, day=ago(181)), order(405, 10, 9000, "cancelled")]
    got = by(customers_with_orders(spark, orders), "customer_id", "rfm_category")
    assert got == {
        1: "champion", 2: "potential", 3: "potential", 4: "loyal", 5: "potential", 6: "new", 7: "active",
        8: "active", 9: "at_risk", 10: "new", 11: "active",
    }


def test_customer_without_orders(spark):
    row = customers_with_orders(spark, [order(1, 1, 10)]).where("customer_id = 11").first()
    assert (row.total_orders, row.delivered_orders, row.lifetime_value) == (0, 0, 0)
    assert row.avg_order_value is None and row.last_order_date is None and row.days_since_last_order is None


def test_average_counts_undelivered_as_zero(spark):
    orders = [order(1, 1, 30), order(2, 1, 99, "Pending"), order(3, 1, 99, "refunded")]
    row = customers_with_orders(spark, orders).where("customer_id = 1").first()
    assert (row.avg_order_value, row.lifetime_value, row.refunded_orders) == (10.0, Decimal("30.00"), 1)


def test_top_customers_are_active_and_ties_go_by_id(spark):
    orders = [order(1, 5, 50), order(2, 2, 50), order(3, 3, 500), order(4, 9, 60)]
    top = core.top_customers(customers_with_orders(spark, orders), 3)
    assert [r.customer_id for r in top.collect()] == [9, 2, 5]


def amounts(spark, orders, items):
    return core.order_amounts(
        staging.orders(table(spark, "orders", *orders)), staging.order_items(table(spark, "order_items", *items))
    )


def item(i, order_id, price, quantity=1, product=1):
    return dict(order_item_id=i, order_id=order_id, product_id=product, quantity=quantity, unit_price=Decimal(str(price)))


def test_revenue_is_item_based_and_null_without_items(spark):
    orders = [order(1, 1, 999), order(2, 1, 5), order(3, 1, 5, "pending")]
    fact = amounts(spark, orders, [item(1, 1, 10, 2), item(2, 1, 5), item(3, 3, 7)])
    out = by(fact, "order_id", "revenue", "line_item_count", "total_discount")
    assert out == {1: (25, 2, 0), 2: (None, None, None), 3: (0, 1, 0)}


def test_monthly_growth_skips_gaps_and_handles_zero(spark):
    days = [date(2023, 1, 5), date(2023, 1, 9), date(2023, 4, 1), date(2023, 5, 1), date(2023, 6, 1)]
    orders = [order(i, i % 2, 1, "cancelled" if i == 3 else "delivered", d) for i, d in enumerate(days)]
    fact = amounts(spark, orders, [item(i, i, p) for i, p in enumerate([10, 30, 50, 7, 20])])
    rows = core.monthly_revenue(fact).collect()
    assert [r.order_month.month for r in rows] == [1, 4, 5, 6]
    assert [r.total_revenue for r in rows] == [40, 50, 0, 20]
    assert [r.mom_growth_pct for r in rows] == [None, 25.0, -100.0, 0.0]
    assert [r.unique_customers for r in rows] == [2, 1, 1, 1]
    assert [r.cancelled_orders for r in rows] == [0, 0, 1, 0]


# HR


def people(spark):
    raw = table(
        spark, "employees",
        dict(employee_id=1, first_name="H", last_name="1", department_id=1, salary=Decimal(100000), employment_status="Active"),
        dict(employee_id=2, first_name="E", last_name="2", department_id=1, salary=Decimal(50000), manager_id=1, employment_status="active"),
        dict(employee_id=3, first_name="E", last_name="3", department_id=9, salary=Decimal(70000), manager_id=7, employment_status="active"),
        dict(employee_id=4, first_name="E", last_name="4", department_id=1, salary=Decimal(1), manager_id=1, employment_status="left"),
    )
    departments = table(spark, "departments", dict(department_id=1, department_name="Sales", location="X", manager_id=2))
    return hr.dim_employees(staging.employees(raw, as_of()), staging.departments(departments))


def test_unmatched_department_and_manager_are_null(spark):
    out = by(people(spark), "employee_id", "department_id", "manager_name", "is_department_head")
    assert out == {1: (1, None, True), 2: (1, "H 1", False), 3: (None, None, False), 4: (1, "H 1", False)}


def test_headcount_and_percentiles_of_active_staff(spark):
    heads = by(hr.headcount_by_department(people(spark)), "department_id", "headcount", "department_heads", "avg_salary")
    assert heads == {1: (2, 1, 75000.0), None: (1, 0, 70000.0)}
    dist = hr.salary_distribution(people(spark))
    assert [r.department_name for r in dist.collect()] == ["Sales", None]
    assert by(dist, "department_name", "p25_salary", "median_salary")["Sales"] == (62500.0, 75000.0)


def test_percentiles_of_eleven_salaries(spark):
    # One department of the literal rows.
    salaries = [185000, 145000, 115000, 112000, 90000, 148000, 135000, 105000, 118000, 165000, 116000]
    staff = spark.createDataFrame(
        [("Engineering", "active", Decimal(s)) for s in salaries],
        "department_name string, employment_status string, salary decimal(12,2)",
    )
    row = hr.salary_distribution(staff).first()
    assert (row.headcount, row.total_payroll) == (11, 1434000)
    assert (row.p25_salary, row.median_salary, row.p75_salary) == (113500.0, 118000.0, 146500.0)


# Marketing


def test_campaign_nulls_rank_first_and_running_sum_breaks_ties_by_id(spark):
    def c(i, channel, start):
        return dict(campaign_id=i, campaign_name=str(i), channel=channel, start_date=start, status="active", budget=Decimal(1))

    jan, feb = date(2023, 1, 1), date(2023, 2, 1)
    campaigns = staging.campaigns(
        table(spark, "campaigns", c(1, "email", feb), c(2, "email", jan), c(3, "email", jan), c(4, "affiliate", date(2022, 1, 1))),
        as_of(),
    )

    def s(i, campaign, amount):
        return dict(ad_spend_id=i, campaign_id=campaign, spend_date=jan, impressions=100, clicks=10, spend_amount=Decimal(amount))

    spend = marketing.fact_ad_spend(
        staging.ad_spend(table(spark, "ad_spend", s(1, 1, 10), s(2, 2, 20), s(3, 3, 30), s(4, 3, 0))), campaigns
    )
    attribution = staging.order_attribution(
        table(spark, "order_attribution", dict(order_id=1, campaign_id=1), dict(order_id=2, campaign_id=2), dict(order_id=9, campaign_id=2))
    )
    orders = amounts(spark, [order(1, 1), order(2, 1)], [item(1, 1, 40), item(2, 2, 20)])
    out = by(
        marketing.campaign_performance(campaigns, spend, attribution, orders), "campaign_id",
        "roas", "roas_rank_in_channel", "cumulative_spend_by_start_date", "attributed_orders", "total_spend",
        "click_through_rate",
    )
    assert out == {
        1: (4.0, 2, 60, 1, 10, 0.1),
        2: (1.0, 3, 20, 2, 20, 0.1),
        3: (None, 1, 50, 0, 30, 0.1),
        4: (None, 1, None, 0, 0, None),
    }


def test_cohorts(spark):
    data = [
        order(1, 1, 10, day=date(2023, 1, 31)), order(2, 1, 5, day=date(2023, 3, 1)), order(3, 1, 5, day=date(2023, 3, 2)),
        order(4, 2, 7, day=date(2023, 1, 1)), order(5, 2, 9, "cancelled", date(2023, 2, 1)),
        order(6, 3, 8, "pending", date(2023, 1, 1)), order(7, 3, 8, day=date(2023, 3, 5)),
    ]
    rows = marketing.acquisition_cohorts(staging.orders(table(spark, "orders", *data))).collect()
    got = [
        (r.cohort_month.month, r.order_month.month, r.months_since_acquisition, r.cohort_size, r.active_customers,
         r.retention_rate, r.revenue, r.cumulative_cohort_revenue)
        for r in rows
    ]
    assert got == [(1, 1, 0, 2, 2, 1.0, 17, 17), (1, 3, 2, 2, 1, 0.5, 10, 27), (3, 3, 0, 1, 1, 1.0, 8, 8)]


# Inventory


def movement(i, product, day, change, warehouse=1):
    return dict(movement_id=i, product_id=product, warehouse_id=warehouse, movement_date=date(2023, 1, day),
                movement_type="sale", quantity_change=change, loaded_at=NOON)


def ledger(spark, *movements, name="p"):
    return inventory.fact_stock_movements(
        staging.stock_movements(table(spark, "stock_movements", *movements)),
        staging.products(table(spark, "products", *[dict(product_id=i, product_name=f"{name}{i}") for i in (1, 2, 3)])),
        staging.warehouses(table(spark, "warehouses", dict(warehouse_id=1, warehouse_name="W", state="S"))),
    )


def test_last_balance_is_the_level_and_attributes_are_the_latest(spark):
    old = ledger(spark, movement(5, 1, 2, 10), movement(2, 1, 3, -4), movement(9, 2, 1, 3), name="old")
    new = ledger(spark, movement(3, 1, 3, 1), movement(1, 1, 1, 100), name="new")
    fact = old.unionByName(new)
    levels = by(inventory.current_stock_levels(fact), "product_id", "current_stock", "product_name", "as_of_date")
    assert levels == {1: (107, "new1", date(2023, 1, 3)), 2: (3, "old2", date(2023, 1, 1))}
    balance = by(inventory.running_balance(fact), "movement_id", "running_balance")
    assert balance == {1: 100, 5: 110, 2: 106, 3: 107, 9: 3}


def test_reorder_alerts(spark):
    stock = inventory.current_stock_levels(
        ledger(spark, movement(1, 1, 1, 14), movement(2, 2, 1, 15), movement(3, 3, 1, 0), movement(4, 1, 1, -1, warehouse=2))
    )
    items = staging.order_items(table(spark, "order_items", item(1, 1, 1, 5, 1), item(2, 2, 1, 5, 1), item(3, 1, 1, 10, 2)))
    orders = staging.orders(
        table(spark, "orders", order(1, 1, 1, "cancelled", date(2023, 1, 1)), order(2, 1, 1, day=date(2023, 1, 10)))
    )
    velocity = inventory.sales_velocity(items, orders)
    assert by(velocity, "product_id", "total_units_sold", "avg_daily_units_sold") == {1: (10, 1.0), 2: (10, 10.0)}
    got = {
        (r.product_id, r.warehouse_id): (r.reorder_point, r.days_of_stock_remaining, r.stock_status, r.urgency_rank)
        for r in inventory.reorder_alerts(stock, velocity).collect()
    }
    assert got == {
        (1, 2): (14.0, -1.0, "out_of_stock", 1),
        (2, 1): (140.0, 1.5, "reorder_now", 2),
        (1, 1): (14.0, 14.0, "reorder_now", 3),
        (3, 1): (0.0, None, "out_of_stock", 4),
    }


# Metrics and serving


def test_metrics(spark):
    fact = amounts(spark, [order(1, 1), order(2, 1), order(3, 2, 1, "pending"), order(4, None)],
                   [item(1, 1, 10), item(2, 2, 20), item(3, 3, 99), item(4, 4, 6)])
    assert metrics.total_revenue(fact).first()[0] == 36
    assert metrics.total_orders(fact).first()[0] == 4
    assert metrics.average_order_value(fact).first()[0] == 9.0
    assert metrics.average_order_value(fact.where("false")).first()[0] is None
    segments = spark.createDataFrame([(1, "GOLD"), (2, "GOLD")], "customer_id long, segment string")
    got = by(metrics.order_metrics_by(fact, "customer_id", segments, "segment"), "segment", "total_revenue", "total_orders")
    assert got == {"GOLD": (30, 3), None: (6, 1)}


def test_serving_types(spark):
    served = serving.serve(people(spark))
    types = dict(served.dtypes)
    assert (types["salary"], types["tenure_years"], types["hire_date"], types["employee_id"]) == (
        "double", "double", "timestamp_ntz", "bigint",
    )


# Sources


def test_defaults_fill_missing_columns_but_not_nulls(spark):
    given = spark.createDataFrame([(1, 2, 3, 4.5)], "order_item_id int, order_id int, product_id int, unit_price double")
    row = conform(given, "order_items").first()
    assert (row.quantity, row.discount_pct, row.unit_price) == (1, 0, Decimal("4.50"))
    assert conform(given.withColumn("quantity", F.lit(None).cast("int")), "order_items").first().quantity is None
    loaded = conform(spark.createDataFrame([(1,)], "movement_id int"), "stock_movements", NOON).first()
    assert loaded.loaded_at == NOON and loaded.movement_type is None
    assert conform(spark.createDataFrame([(1,)], "customer_id int"), "customers").first().country == "USA"


def test_append_read_and_count(spark):
    rows = literal_rows(spark, "warehouses", [(1, "A", None, None, True)])
    path = new_folder(spark, "test-append")
    append(rows, "warehouses", path)
    append(rows.drop("is_active"), "warehouses", path)
    stored = read_raw(spark, "warehouses", path)
    assert [r.is_active for r in stored.collect()] == [True, True]
    assert by(row_counts({"a": rows, "b": stored}), "tbl", "row_count") == {"a": 1, "b": 2}


# Eight campaigns and the number of weeks each must spend on.
EIGHT = [
    (5001, "google_ads", date(2023, 1, 1), date(2023, 3, 31), 15000, 14),
    (5002, "google_ads", date(2023, 1, 1), date(2024, 2, 29), 60000, 62),
    (5003, "facebook_ads", date(2023, 11, 1), date(2023, 11, 30), 20000, 5),
    (5004, "facebook_ads", date(2023, 1, 1), date(2024, 2, 29), 25000, 62),
    (5005, "instagram_ads", date(2023, 6, 1), date(2023, 8, 31), 12000, 14),
    (5006, "tiktok_ads", date(2024, 1, 1), date(2024, 2, 29), 10000, 9),
    (5007, "email", date(2023, 1, 1), date(2024, 2, 29), 6000, 62),
    (5008, "affiliate", date(2023, 1, 1), date(2024, 2, 29), 15000, 62),
]


@pytest.fixture(scope="module")
def eight(spark):
    return table(
        spark, "campaigns",
        *[dict(campaign_id=i, channel=c, start_date=s, end_date=e, budget=Decimal(b)) for i, c, s, e, b, _ in EIGHT],
    )


def test_weekly_spend(spark, eight):
    spend = generators.ad_spend(eight, as_of())
    rows = spend.orderBy("ad_spend_id").collect()
    assert by(spend.groupBy("campaign_id").count(), "campaign_id", "count") == {e[0]: e[5] for e in EIGHT}
    assert [r.ad_spend_id for r in rows] == list(range(6001, 6291))
    assert rows == sorted(rows, key=lambda r: (r.campaign_id, r.spend_date))
    assert all(r.spend_date.weekday() == 0 for r in rows)
    weekly = {e[0]: e[4] / e[5] for e in EIGHT}
    assert all(0.7 * weekly[r.campaign_id] - 0.01 <= r.spend_amount <= Decimal(1.3 * weekly[r.campaign_id] + 0.01) for r in rows)


def test_spend_has_no_week_limit(spark):
    long = table(spark, "campaigns", dict(campaign_id=1, channel="email", start_date=date(2020, 1, 1), budget=Decimal(100)))
    assert generators.ad_spend(long, as_of()).count() == 218


def test_attribution_picks_one_running_campaign(spark, eight):
    orders = table(spark, "orders", *[order(i, 1, day=date(2022, 12, 25) + timedelta(days=i % 440)) for i in range(900)])
    out = generators.order_attribution(orders, eight, as_of())
    rows = out.join(eight, "campaign_id").collect()
    assert len(rows) == out.select("order_id").distinct().count()
    assert all(r.start_date <= r.attributed_at.date() <= r.end_date for r in rows)
    assert 500 < len(rows) < 640


def test_ledger_has_every_stream(spark):
    products = table(spark, "products", *[dict(product_id=i) for i in range(37)])
    places = table(spark, "warehouses", *[dict(warehouse_id=6000 + i) for i in (1, 2, 3)])
    orders = table(spark, "orders", *[order(i, 1) for i in range(90)])
    items = table(spark, "order_items", *[item(i, i % 90, 1, product=i % 37) for i in range(102)])
    rows = generators.stock_movements(products, places, items, orders, date(2023, 1, 2)).collect()
    kinds = {k: [r for r in rows if r.movement_type == k] for k in ("restock", "sale", "adjustment", "return")}
    assert (len(kinds["restock"]), len(kinds["sale"])) == (888, 102)
    assert len({r.movement_id for r in rows}) == len(rows) == sum(map(len, kinds.values()))
    assert all(30 <= r.quantity_change < 70 for r in kinds["restock"])
    assert all(-8 <= r.quantity_change <= -1 for r in kinds["adjustment"])
    assert all(1 <= r.quantity_change <= 5 for r in kinds["return"])
    assert sorted({r.warehouse_id for r in kinds["sale"]}) == [6001, 6002, 6003]


# Declarations


def test_declared_checks():
    kinds = [c.kind for c in CHECKS]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 39, "unique": 23, "relationships": 13, "accepted_values": 10, "unique_combination": 3,
    }
    assert len({(c.table, c.columns, c.kind) for c in CHECKS}) == 88


def test_target_schema():
    assert target_schema("PUBLIC") == "PUBLIC"
    assert target_schema("PUBLIC", " MARKETING ") == "PUBLIC_MARKETING"


def test_stored_models_feed_their_consumers(spark, small):
    raw = SampleTables(spark, small)
    stored = Models(raw, raw.as_of).store("fact_orders")
    assert stored.order_amounts is stored.fact_orders
    lazy = Models(raw, raw.as_of)
    assert stored.rpt_monthly_revenue.collect() == lazy.rpt_monthly_revenue.collect()


def test_balances_continue_from_stored_closing_ones(spark):
    """A ledger loaded in three parts equals one window over all of it; NULL keys and quantities too."""
    moves = [(i, [1, 2, None][i % 3], [7, None][i % 2], date(2001, 1, 1 + i // 4), [5, -3, None, 8][i * 7 % 4]) for i in range(100)]
    schema = "movement_id long, product_id long, warehouse_id long, movement_date date, quantity_change long"
    whole = inventory.running_balance(spark.createDataFrame(moves, schema))
    got, opening = [], None
    for part in (moves[:30], moves[30:31], moves[31:]):
        load = spark.createDataFrame(part, schema)
        rows = inventory.running_balance(load) if opening is None else inventory.continued_balance(load, opening)
        got += rows.collect()
        opening = stage(inventory.closing_balances(load, opening), "closing")
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole.collect()))
    assert opening.count() == 6


def test_lines_without_ids_build_no_ids(spark, small, monkeypatch):
    def none(*a):
        raise AssertionError("ids were built")

    raw = SampleTables(spark, small)
    with monkeypatch.context() as m:
        m.setattr(generators, "stock_movements", none)
        assert Models(raw, raw.as_of).stock_lines.columns[0] == "movement_id"
        assert QUERIES["stock_levels_agg_form"](spark, small).count() > 0
        m.setattr(sample, "numbered", none)
        assert Models(SampleTables(spark, small), raw.as_of).order_lines.count() > 0


def test_checks_build_only_what_they_name(spark, small, monkeypatch):
    """Accepted values and references need no movement ids; unique combinations no ledger table at all."""

    def none(*a):
        raise AssertionError("ids were built")

    monkeypatch.setattr(generators, "stock_movements", none)
    for kind in ("accepted_values", "relationships", "unique_combination"):
        assert QUERIES[f"dq_{kind}"](spark, small).count() > 0


def test_equal_lines_are_numbered_in_one_shuffle(spark, small, monkeypatch):
    seen, real = [], sample.numbered
    monkeypatch.setattr(sample, "numbered", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    items = SampleTables(spark, small).order_items
    assert "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    ids = sorted(r.order_item_id for r in items.select("order_item_id").collect())
    assert ids == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("copies", [1, 2])
def test_balances_are_summed_before_attributes_join(spark, copies, monkeypatch):
    moves = [(i, [1, 2, None][i % 3], 7, date(2001, 1, 1 + i // 4), "sale", [5, -3, None][i % 3 - 1], datetime(2001, 1, 1)) for i in range(40)]
    moves = spark.createDataFrame(moves, "movement_id long, product_id long, warehouse_id long, movement_date date, movement_type string, quantity_change long, loaded_at timestamp_ntz")
    products = table(spark, "products", *[dict(product_id=1)] * copies, dict(product_id=2))
    places = table(spark, "warehouses", dict(warehouse_id=7))
    want = inventory.running_balance(inventory.fact_stock_movements(moves, products, places)).collect()
    staged = []
    monkeypatch.setattr(inventory, "stage", lambda df, label: staged.append(label) or df)
    got = inventory.balanced_ledger(moves, products, places)
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(staged) == copies - 1
