"""The raw tables derived from the given TPC-H-like parquet tables.

Every raw row comes from a given row or an aggregate of given rows; no given row is
dropped. A customer or supplier without a known nation has no city and state;
departments and warehouses are those of known regions. Suppliers appear a second time as customers without orders, and brands
as gift-box products without sales, so the outer joins have something to miss.
"""

from __future__ import annotations

from datetime import date
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import numbered
from tidemark.session import stage
from tidemark.sources import generators
from tidemark.sources.ingest import conform
from tidemark.sources.schemas import GIVEN

AS_OF = date(2001, 8, 1)
FIRST_RESTOCK = date(1995, 1, 2)

# Fixed values of the mapping, by order priority: number, channel, payment method, status of an open order.
PRIORITIES = {
    "1-URGENT": (1, "google_ads", "Credit_Card", "Processing"),
    "2-HIGH": (2, "Facebook_Ads", "PayPal", "Processing"),
    "3-MEDIUM": (3, "instagram_ads", "Debit_Card", "Processing"),
    "4-NOT SPECIFIED": (4, "tiktok_ads", "Bank_Transfer", "Cancelled"),
    "5-LOW": (5, "email", "Gift_Card", "Refunded"),
}


def _by_priority(position: int) -> str:
    arms = " ".join(f"when '{name}' then {values[position]!r}" for name, values in PRIORITIES.items())
    return f"case o_orderpriority {arms} end"


def _day_after(start: str, days: str) -> str:
    return f"date_add(date '{start}', cast({days} as int))"


def _hundredth(whole: str) -> str:
    return f"cast({whole} as decimal(12,0)) * 0.01"


class SampleTables:
    """The eleven raw tables, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str, today: date = AS_OF):
        self.spark, self.folder, self.today = spark, folder, today
        self.as_of = F.lit(today)
        self.given = cache(self._given)

    def _given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _places(self) -> DataFrame:
        """Nations with their region: 25 and 5 rows by the definition of those tables."""
        return self.given("nation").join(self.given("region"), F.expr("n_regionkey = r_regionkey"), "left")

    @cached_property
    def _suppliers(self) -> DataFrame:
        return self.given("supplier").join(self._places, F.expr("s_nationkey = n_nationkey"), "left")

    @cached_property
    def customers(self) -> DataFrame:
        buyers = self.given("customer").join(self._places, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
            "c_custkey as customer_id", "'Customer' as first_name", "substring(c_name, 10, 20) as last_name",
            "concat(upper(c_name), '@EXAMPLE.COM') as email", "n_name as city", "r_name as state",
            f"{_day_after('1990-01-01', 'c_custkey % 1500')} as registration_date",
            f"{_day_after('1950-01-01', 'c_custkey * 37 % 18000')} as date_of_birth",
            "lower(c_mktsegment) as customer_segment", "cast(c_acctbal as decimal(10,2)) as credit_limit",
            "c_custkey % 10 <> 0 as is_active", "cast(null as string) as phone",
        )
        suppliers = self._suppliers.selectExpr(
            "-1 - s_suppkey as customer_id", "'Supplier' as first_name", "substring(s_name, 10, 20) as last_name",
            "concat(upper(s_name), '@EXAMPLE.COM') as email", "n_name as city", "r_name as state",
            f"{_day_after('1990-01-01', 's_suppkey % 1500')} as registration_date",
            "cast(null as date) as date_of_birth",
            "'supplier' as customer_segment", "cast(s_acctbal as decimal(10,2)) as credit_limit",
            "true as is_active", "cast(null as string) as phone",
        )
        return conform(buyers.unionByName(suppliers), "customers")

    @cached_property
    def employees(self) -> DataFrame:
        return conform(
            self._suppliers.selectExpr(
                "s_suppkey as employee_id", "'Agent' as first_name", "substring(s_name, 10, 20) as last_name",
                "concat(upper(s_name), '@STAFF.EXAMPLE.COM') as email", "cast(null as string) as phone",
                "if(s_suppkey % 17 = 0, 99, r_regionkey + 1) as department_id",
                "if(s_suppkey % 10 = 0, 'Team Lead', 'Account Agent') as job_title",
                "60000 + (cast(s_acctbal as decimal(12,2)) + 1000) * 11 as salary",
                f"{_day_after('1985-01-01', 's_suppkey * 97 % 5000')} as hire_date",
                "if(s_suppkey % 10 = 0, null, s_suppkey - s_suppkey % 10) as manager_id",
                "if(s_suppkey % 13 = 0, 'Terminated', 'Active') as employment_status",
                "n_name as city", "r_name as state",
            ),
            "employees",
        )

    @cached_property
    def departments(self) -> DataFrame:
        by_region = self._suppliers.where("r_regionkey is not null").groupBy("r_regionkey", "r_name").agg(
            F.expr("max(n_name) as location"),
            F.expr("min(s_suppkey) as manager_id"),
            F.expr("max(cast(s_acctbal as decimal(10,2))) * 100 as budget"),
        )
        return conform(
            by_region.selectExpr("r_regionkey + 1 as department_id", "r_name as department_name", "*"), "departments"
        )

    @cached_property
    def warehouses(self) -> DataFrame:
        by_region = self._suppliers.where("r_regionkey is not null").groupBy("r_regionkey", "r_name").agg(
            F.expr("min(n_name) as city"), F.expr("sum(cast(s_acctbal as decimal(10,2))) > 0 as is_active")
        )
        return conform(
            by_region.selectExpr(
                "r_regionkey + 6001 as warehouse_id", "concat(r_name, ' DC') as warehouse_name", "city",
                "r_name as state", "is_active",
            ),
            "warehouses",
        )

    @cached_property
    def products(self) -> DataFrame:
        single = self.given("part").selectExpr(
            "p_partkey as product_id", "p_name as product_name", "p_size as category_id", "p_type as category_name",
            "cast(p_retailprice as decimal(10,2)) as unit_price", "cast(p_size * 7 % 50 as long) as units_in_stock",
            "p_brand as supplier", "p_size % 10 <> 0 as is_active",
        )
        brands = self.given("part").groupBy("p_brand").agg(
            F.expr("cast(min(p_retailprice) as decimal(10,2)) as unit_price"), F.expr("count(*) as parts")
        )
        boxes = brands.selectExpr(
            "-cast(substring(p_brand, 7, 10) as long) as product_id", "concat(p_brand, ' gift box') as product_name",
            "cast(null as int) as category_id", "'GIFT' as category_name", "unit_price",
            "parts % 50 as units_in_stock", "p_brand as supplier", "true as is_active",
        )
        return conform(single.unionByName(boxes), "products")

    @cached_property
    def orders(self) -> DataFrame:
        staff = self.given("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
        return conform(
            self.given("orders").withColumn("_staff", staff).selectExpr(
                "o_orderkey as order_id", "o_custkey as customer_id",
                # Half of these numbers belong to no employee.
                "o_orderkey % (2 * _staff) as employee_id",
                "cast(o_orderdate as date) as order_date",
                f"case o_orderstatus when 'F' then 'Delivered' when 'O' then {_by_priority(3)} else 'Pending' end "
                "as status",
                # Scaled so that lifetime values straddle the class limits.
                f"{_hundredth('cast(round(o_totalprice * 100) as long) div 500')} as total_amount",
                "concat('NATION_', o_custkey % 25) as shipping_address_city",
                f"{_by_priority(2)} as payment_method",
            ),
            "orders",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """Line items, numbered in the order of all the columns used.

        The given line numbers repeat within an order. Equal lines may take their numbers
        in any order, so they are put in order by their place in the file: a hot order,
        part or line spreads over as many tasks as it has rows for, in one shuffle.
        """
        used = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
        lines = self.given("lineitem").select(*used, F.monotonically_increasing_id().alias("_line"))
        order = [F.col(c) for c in [*used[2:], "_line"]]
        return self._lines(numbered(lines, "_item", F.col("l_orderkey"), F.col("l_partkey"), order).drop("_line"), "_item")

    @cached_property
    def order_lines(self) -> DataFrame:
        """The order items without their ids, which a projection of the given rows is enough for."""
        return self._lines(self.given("lineitem"), "cast(null as long)")

    def _lines(self, lines: DataFrame, item_id: str) -> DataFrame:
        cents = "cast(round(l_extendedprice * 100) as long) div cast(l_quantity as long) div 500"
        return conform(
            lines.selectExpr(
                f"{item_id} as order_item_id", "l_orderkey as order_id",
                "l_partkey as product_id", "cast(l_quantity as long) as quantity", f"{_hundredth(cents)} as unit_price",
                "if(l_linenumber = 7, null, round(l_discount * 100)) as discount_pct",
            ),
            "order_items",
        )

    def campaigns_at(self, day: date) -> DataFrame:
        """Campaigns as known on ``day``, from the orders placed until then.

        One campaign per channel and quarter with orders, one affiliate campaign
        per year, one planned campaign per channel for the next quarter. Orders
        are scanned and summed once, per channel and quarter. The number of
        campaigns is bounded by the calendar.
        """
        today = f"date '{day}'"
        quarters = (
            self.given("orders")
            .selectExpr(
                "o_orderpriority", "cast(o_orderdate as date) as day",
                "cast(round(o_totalprice * 100) as long) as cents", "trunc(o_orderdate, 'QUARTER') as start",
            )
            .where(f"day <= {today}")
            .groupBy("o_orderpriority", "start")
            .agg(F.expr("sum(cents) as cents"), F.expr("max(day) as seen"))
        )
        number, channel = _by_priority(0), _by_priority(1)
        code = "5000 + (year(start) - 1990) * 100"
        roles = f"""explode(array(
            named_struct('id', {code} + quarter(start) * 10 + {number},
                'name', concat({channel}, ' ', year(start), ' Q', quarter(start)), 'channel', {channel},
                'first', start, 'last', date_sub(add_months(start, 3), 1)),
            named_struct('id', {code} + 6, 'name', concat('affiliate ', year(start)), 'channel', 'affiliate',
                'first', trunc(start, 'YEAR'), 'last', date_sub(add_months(trunc(start, 'YEAR'), 12), 1)),
            named_struct('id', 14000 + {number}, 'name', concat({channel}, ' next'), 'channel', {channel},
                'first', add_months(trunc({today}, 'QUARTER'), 3), 'last', cast(null as date)))) as role"""
        summed = (
            quarters.selectExpr(roles, "cents", "seen")
            .groupBy("role.id", "role.name", "role.channel", "role.first", "role.last")
            .agg(F.expr("sum(cents) as cents"), F.expr("max(seen) as seen"))
        )
        return conform(
            summed.selectExpr(
                "id as campaign_id", "name as campaign_name", "channel", "first as start_date",
                # A running campaign has no end yet.
                f"if(last < {today}, last, null) as end_date",
                f"5000 + {_hundredth('cents % 5000000')} as budget",
                f"case when first > {today} then 'Planned' when last < {today} then 'Completed' "
                "when channel = 'tiktok_ads' then 'Paused' else 'Active' end as status",
                "cast(seen as timestamp_ntz) as updated_at",
            ),
            "campaigns",
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        """Staged: one scan of the orders, whose few rows many models then read."""
        return stage(self.campaigns_at(self.today), "campaigns")

    @cached_property
    def ad_spend(self) -> DataFrame:
        return conform(generators.ad_spend(self.campaigns, self.as_of), "ad_spend")

    @cached_property
    def order_attribution(self) -> DataFrame:
        return conform(
            generators.order_attribution(self.orders, self.campaigns, self.as_of), "order_attribution"
        )

    def _booked(self) -> tuple:
        """What the ledger is made of."""
        return self.products, self.warehouses, self.order_items, self.orders, FIRST_RESTOCK

    @cached_property
    def stock_movements(self) -> DataFrame:
        return conform(generators.stock_movements(*self._booked()), "stock_movements")

    @cached_property
    def stock_lines(self) -> DataFrame:
        """The ledger without its ids, for sums that need no order of movements."""
        return conform(generators.ledger(*self._booked()).withColumn("movement_id", F.lit(None).cast("long")), "stock_movements")
