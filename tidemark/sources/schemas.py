"""The eleven raw tables: column types, nullability and ingest defaults."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _TEXT, _DATE, _FLAG = T.LongType(), T.StringType(), T.DateType(), T.BooleanType()
_STAMP = T.TimestampNTZType()


def _money(precision: int) -> T.DecimalType:
    return T.DecimalType(precision, 2)


def _table(**columns) -> T.StructType:
    """Column -> type, or (type,) when the column may not be NULL."""
    fields = []
    for name, dtype in columns.items():
        required = isinstance(dtype, tuple)
        fields.append(T.StructField(name, dtype[0] if required else dtype, not required))
    return T.StructType(fields)


RAW: dict[str, T.StructType] = {
    "departments": _table(
        department_id=(_LONG,), department_name=(_TEXT,), location=_TEXT, manager_id=_LONG, budget=_money(12)
    ),
    "employees": _table(
        employee_id=(_LONG,), first_name=(_TEXT,), last_name=(_TEXT,), email=(_TEXT,), phone=_TEXT,
        department_id=(_LONG,), job_title=_TEXT, salary=_money(12), hire_date=_DATE, manager_id=_LONG,
        employment_status=_TEXT, city=_TEXT, state=_TEXT,
    ),
    "customers": _table(
        customer_id=(_LONG,), first_name=(_TEXT,), last_name=(_TEXT,), email=(_TEXT,), phone=_TEXT, city=_TEXT,
        state=_TEXT, country=_TEXT, registration_date=_DATE, date_of_birth=_DATE, customer_segment=_TEXT,
        credit_limit=_money(10), is_active=_FLAG,
    ),
    "products": _table(
        product_id=(_LONG,), product_name=(_TEXT,), category_id=_LONG, category_name=_TEXT, unit_price=_money(10),
        units_in_stock=_LONG, supplier=_TEXT, is_active=_FLAG,
    ),
    "orders": _table(
        order_id=(_LONG,), customer_id=(_LONG,), employee_id=_LONG, order_date=(_DATE,), status=(_TEXT,),
        total_amount=_money(12), shipping_address_city=_TEXT, shipping_address_state=_TEXT, payment_method=_TEXT,
        notes=_TEXT,
    ),
    "order_items": _table(
        order_item_id=(_LONG,), order_id=(_LONG,), product_id=(_LONG,), quantity=(_LONG,), unit_price=(_money(10),),
        discount_pct=_money(5),
    ),
    "campaigns": _table(
        campaign_id=(_LONG,), campaign_name=(_TEXT,), channel=(_TEXT,), start_date=(_DATE,), end_date=_DATE,
        budget=(_money(12),), status=(_TEXT,), updated_at=(_STAMP,),
    ),
    "ad_spend": _table(
        ad_spend_id=(_LONG,), campaign_id=(_LONG,), spend_date=(_DATE,), impressions=(_LONG,), clicks=(_LONG,),
        spend_amount=(_money(10),), loaded_at=(_STAMP,),
    ),
    "order_attribution": _table(
        order_id=(_LONG,), campaign_id=(_LONG,), attribution_channel=(_TEXT,), attributed_at=(_STAMP,)
    ),
    "warehouses": _table(
        warehouse_id=(_LONG,), warehouse_name=(_TEXT,), city=_TEXT, state=_TEXT, is_active=(_FLAG,)
    ),
    "stock_movements": _table(
        movement_id=(_LONG,), product_id=(_LONG,), warehouse_id=(_LONG,), movement_date=(_DATE,),
        movement_type=(_TEXT,), quantity_change=(_LONG,), loaded_at=(_STAMP,),
    ),
}

# Columns of the given tables that the sample mapping reads.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double",
}

# The default of a column that the incoming rows leave out.
# ``now`` stands for the load time.
DEFAULTS: dict[str, dict[str, object]] = {
    "employees": {"employment_status": "active"},
    "customers": {"country": "USA", "is_active": True},
    "products": {"units_in_stock": 0, "is_active": True},
    "order_items": {"quantity": 1, "discount_pct": 0},
    "ad_spend": {"loaded_at": "now"},
    "warehouses": {"is_active": True},
    "stock_movements": {"loaded_at": "now"},
}
