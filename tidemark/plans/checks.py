"""The declared data-quality checks of raw tables and marts."""

from __future__ import annotations

from tidemark.operators.quality import Check

# The accepted words of each coded column.
CHANNELS = ("google_ads", "facebook_ads", "instagram_ads", "tiktok_ads", "email", "affiliate")
ORDER_STATUSES = ("pending", "processing", "delivered", "cancelled", "refunded")
CAMPAIGN_STATUSES = ("planned", "active", "paused", "completed")
MOVEMENT_TYPES = ("restock", "sale", "adjustment", "return")
RFM_CATEGORIES = ("champion", "loyal", "potential", "new", "at_risk", "active")
SALARY_BANDS = ("junior", "mid", "senior", "executive")
STOCK_ALERTS = ("out_of_stock", "reorder_now", "ok")

# Columns that must identify a row: both not_null and unique.
_IDENTIFIERS = {
    "raw.employees": ("employee_id", "email"),
    "raw.departments": ("department_id",),
    "raw.customers": ("customer_id", "email"),
    "raw.orders": ("order_id",),
    "raw.order_items": ("order_item_id",),
    "raw.products": ("product_id",),
    "raw.campaigns": ("campaign_id",),
    "raw.ad_spend": ("ad_spend_id",),
    "raw.order_attribution": ("order_id",),
    "raw.warehouses": ("warehouse_id",),
    "raw.stock_movements": ("movement_id",),
    "dim_customers": ("customer_id", "email"),
    "fact_orders": ("order_id",),
    "rpt_monthly_revenue": ("order_month",),
    "dim_employees": ("employee_id", "email"),
    "rpt_headcount_by_dept": ("department_id",),
    "fact_stock_movements": ("movement_id",),
    "fact_ad_spend": ("ad_spend_id",),
    "rpt_campaign_performance": ("campaign_id",),
}

# Foreign keys: (table, column, parent table). The parent column has the same name.
_REFERENCES = [
    ("raw.employees", "department_id", "raw.departments"),
    ("raw.orders", "customer_id", "raw.customers"),
    ("raw.order_items", "order_id", "raw.orders"),
    ("raw.order_items", "product_id", "raw.products"),
    ("raw.ad_spend", "campaign_id", "raw.campaigns"),
    ("raw.order_attribution", "order_id", "raw.orders"),
    ("raw.order_attribution", "campaign_id", "raw.campaigns"),
    ("raw.stock_movements", "product_id", "raw.products"),
    ("raw.stock_movements", "warehouse_id", "raw.warehouses"),
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_stock_movements", "product_id", "stg_products"),
    ("fact_stock_movements", "warehouse_id", "stg_warehouses"),
    ("fact_ad_spend", "campaign_id", "stg_campaigns"),
]

# Further required columns.
_REQUIRED = [
    ("fact_orders", "revenue"),
    ("rpt_current_stock_levels", "current_stock"),
    ("rpt_customer_acquisition_cohorts", "cohort_month"),
    ("rpt_customer_acquisition_cohorts", "order_month"),
]

_ACCEPTED = [
    ("raw.orders", "status", ORDER_STATUSES),
    ("raw.campaigns", "channel", CHANNELS),
    ("raw.campaigns", "status", CAMPAIGN_STATUSES),
    ("raw.stock_movements", "movement_type", MOVEMENT_TYPES),
    ("dim_customers", "rfm_category", RFM_CATEGORIES),
    ("dim_employees", "salary_band", SALARY_BANDS),
    ("fact_stock_movements", "movement_type", MOVEMENT_TYPES),
    ("rpt_inventory_reorder_alerts", "stock_status", STOCK_ALERTS),
    ("fact_ad_spend", "channel", CHANNELS),
    ("rpt_campaign_performance", "channel", CHANNELS),
]

_COMBINATIONS = [
    ("rpt_current_stock_levels", ("product_id", "warehouse_id")),
    ("rpt_inventory_reorder_alerts", ("product_id", "warehouse_id")),
    ("rpt_customer_acquisition_cohorts", ("cohort_month", "order_month")),
]


def _declare() -> list[Check]:
    identifiers = [(table, column) for table, columns in _IDENTIFIERS.items() for column in columns]
    # A foreign key is required as well; order_attribution.order_id already is, as an identifier.
    foreign = [(table, column) for table, column, _ in _REFERENCES if (table, column) not in identifiers]
    return [
        *[Check(t, "not_null", (c,)) for t, c in [*identifiers, *foreign, *_REQUIRED]],
        *[Check(t, "unique", (c,)) for t, c in identifiers],
        *[Check(t, "relationships", (c,), parent=p, parent_column=c) for t, c, p in _REFERENCES],
        *[Check(t, "accepted_values", (c,), values=v) for t, c, v in _ACCEPTED],
        *[Check(t, "unique_combination", columns) for t, columns in _COMBINATIONS],
    ]


CHECKS: list[Check] = _declare()
