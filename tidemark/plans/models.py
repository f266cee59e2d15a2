"""All models over one set of raw tables, each built on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame

from tidemark.plans import core, hr, inventory, marketing, staging
from tidemark.session import stage_all

# Stored marts in three rounds: a mart reads marts of earlier rounds only.
ROUNDS = (
    ("dim_employees", "dim_customers", "fact_ad_spend", "rpt_customer_acquisition_cohorts", "fact_stock_movements"),
    ("fact_orders", "rpt_headcount_by_dept", "rpt_current_stock_levels"),
    ("rpt_monthly_revenue", "rpt_campaign_performance", "rpt_inventory_reorder_alerts"),
)
MARTS = tuple(mart for marts in ROUNDS for mart in marts)


class Models:
    """Staging and marts as lazy DataFrames.

    ``raw`` has the raw tables as attributes, ``as_of`` is the run date; with ``loaded``
    the staging tables show when they were read, as ``_loaded_at``. A mart
    that is never stored is planned into its consumer, so Catalyst prunes and
    pushes through all of it; ``store`` writes marts once where several read them.
    """

    def __init__(self, raw, as_of: Column, loaded: bool = False):
        self.raw, self.as_of, self.loaded = raw, as_of, loaded
        self._stored: set[str] = set()

    def copy(self) -> Models:
        """The same models before any was stored; raw tables are shared."""
        return Models(self.raw, self.as_of, self.loaded)

    # Staging

    @cached_property
    def stg_ad_spend(self) -> DataFrame:
        return staging.ad_spend(self.raw.ad_spend, loaded=self.loaded)

    @cached_property
    def stg_campaigns(self) -> DataFrame:
        return staging.campaigns(self.raw.campaigns, self.as_of, loaded=self.loaded)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.raw.customers, self.as_of, loaded=self.loaded)

    @cached_property
    def stg_departments(self) -> DataFrame:
        return staging.departments(self.raw.departments, loaded=self.loaded)

    @cached_property
    def stg_employees(self) -> DataFrame:
        return staging.employees(self.raw.employees, self.as_of, loaded=self.loaded)

    @cached_property
    def stg_order_attribution(self) -> DataFrame:
        return staging.order_attribution(self.raw.order_attribution, loaded=self.loaded)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.order_items(self.raw.order_items, loaded=self.loaded)

    @cached_property
    def order_lines(self) -> DataFrame:
        """Staged order items for models that do not use their ids; cheaper where the source makes the ids."""
        return staging.order_items(self._lines("order_lines", "order_items"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.orders(self.raw.orders, loaded=self.loaded)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.products(self.raw.products, loaded=self.loaded)

    @cached_property
    def stg_stock_movements(self) -> DataFrame:
        return staging.stock_movements(self.raw.stock_movements, loaded=self.loaded)

    @cached_property
    def stock_lines(self) -> DataFrame:
        """Staged movements for models that do not use their ids; cheaper where the source makes the ids."""
        return staging.stock_movements(self._lines("stock_lines", "stock_movements"))

    def _lines(self, lines: str, table: str) -> DataFrame:
        """The source's rows without ids; where it has none, its table. Only the one that is read is built."""
        return getattr(self.raw, lines if hasattr(self.raw, lines) else table)

    @cached_property
    def stg_warehouses(self) -> DataFrame:
        return staging.warehouses(self.raw.warehouses, loaded=self.loaded)

    # Marts

    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.stg_customers, self.stg_orders, self.as_of)

    @cached_property
    def order_amounts(self) -> DataFrame:
        """The order fact's own columns; the stored fact when there is one."""
        if "fact_orders" in self._stored:
            return self.fact_orders
        return core.order_amounts(self.stg_orders, self.order_lines)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return core.fact_orders(
            core.order_amounts(self.stg_orders, self.order_lines), self.stg_customers, self.dim_employees
        )

    @cached_property
    def rpt_monthly_revenue(self) -> DataFrame:
        return core.monthly_revenue(self.order_amounts)

    @cached_property
    def dim_employees(self) -> DataFrame:
        return hr.dim_employees(self.stg_employees, self.stg_departments)

    @cached_property
    def rpt_headcount_by_dept(self) -> DataFrame:
        return hr.headcount_by_department(self.dim_employees)

    @cached_property
    def fact_ad_spend(self) -> DataFrame:
        return marketing.fact_ad_spend(self.stg_ad_spend, self.stg_campaigns)

    @cached_property
    def rpt_campaign_performance(self) -> DataFrame:
        return marketing.campaign_performance(
            self.stg_campaigns, self.fact_ad_spend, self.stg_order_attribution, self.order_amounts
        )

    @cached_property
    def rpt_customer_acquisition_cohorts(self) -> DataFrame:
        return marketing.acquisition_cohorts(self.stg_orders)

    @cached_property
    def fact_stock_movements(self) -> DataFrame:
        return inventory.fact_stock_movements(self.stg_stock_movements, self.stg_products, self.stg_warehouses)

    @cached_property
    def rpt_current_stock_levels(self) -> DataFrame:
        if "fact_stock_movements" in self._stored:
            return inventory.current_stock_levels(self.fact_stock_movements)
        return inventory.planned_stock_levels(self.stock_lines, self.stg_products, self.stg_warehouses)

    @cached_property
    def sales_velocity(self) -> DataFrame:
        return inventory.sales_velocity(self.order_lines, self.stg_orders)

    @cached_property
    def rpt_inventory_reorder_alerts(self) -> DataFrame:
        return inventory.reorder_alerts(self.rpt_current_stock_levels, self.sales_velocity)

    # Stored form

    def store(self, *names: str) -> Models:
        """Write the named models to the shared folder and read them from there.

        Store a model before its consumers are first used: those then start from
        the stored table instead of repeating its work. Models stored in one call
        do not see one another.
        """
        for name, stored in stage_all({name: getattr(self, name) for name in names}).items():
            self.replace(name, stored)
        return self

    def replace(self, name: str, stored: DataFrame) -> None:
        """Let later models read ``stored`` in place of the planned model."""
        setattr(self, name, stored)
        self._stored.add(name)
