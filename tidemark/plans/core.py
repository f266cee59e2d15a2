"""Core marts: customers, orders, monthly revenue, best customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import days_between, div0, exact_avg, to_double


def _count_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def dim_customers(customers: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """One row per customer with lifetime totals and an RFM class."""
    lifetime = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_orders"),
        _count_status("delivered").alias("_delivered"),
        _count_status("cancelled").alias("_cancelled"),
        _count_status("refunded").alias("_refunded"),
        F.sum("delivered_amount").alias("_ltv"),
        exact_avg(F.col("delivered_amount")).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    # The class looks at the totals before missing ones become 0: a customer
    # without orders fails every test and is "active".
    ltv, last = F.col("_ltv"), F.col("last_order_date")
    rfm = (
        F.when(ltv >= 5000, "champion")
        .when((ltv >= 2000) & (F.col("_orders") >= 5), "loyal")
        .when(ltv >= 1000, "potential")
        .when(last >= F.date_sub(as_of, 90), "new")
        .when(last < F.date_sub(as_of, 180), "at_risk")
        .otherwise("active")
    )

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return customers.join(lifetime, "customer_id", "left").select(
        "customer_id", "full_name", "first_name", "last_name", "email", "phone", "city", "state", "country",
        "registration_date", "date_of_birth", "age", "days_since_registration", "customer_segment", "credit_limit",
        "is_active",
        or_zero("_orders").alias("total_orders"),
        or_zero("_delivered").alias("delivered_orders"),
        or_zero("_cancelled").alias("cancelled_orders"),
        or_zero("_refunded").alias("refunded_orders"),
        or_zero("_ltv").alias("lifetime_value"),
        "avg_order_value", "first_order_date", "last_order_date",
        days_between(last, as_of).alias("days_since_last_order"),
        rfm.alias("rfm_category"),
    )


def order_amounts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with the totals of their line items: the numbers of the order fact.

    Items are summed per order before the join, so no order is repeated. Reports
    that need no customer or employee attributes start here and skip two joins.
    ``revenue`` is NULL for a delivered order without items.
    """
    totals = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("gross_amount").alias("gross_amount"),
        F.sum("net_amount").alias("net_amount"),
    )
    return orders.join(totals, "order_id", "left").withColumns(
        {
            # Equal to the sum of the differences: the sums are exact, and NULL together.
            "total_discount": F.col("gross_amount") - F.col("net_amount"),
            "revenue": F.when(F.col("status") == "delivered", F.col("net_amount")).otherwise(F.lit(0)),
        }
    )


def fact_orders(amounts: DataFrame, customers: DataFrame, employees: DataFrame) -> DataFrame:
    """One row per order with customer and sales-representative attributes."""
    buyer = customers.select(
        "customer_id", "customer_segment", F.col("city").alias("customer_city"), F.col("state").alias("customer_state")
    )
    seller = employees.select(
        "employee_id", F.col("full_name").alias("sales_rep_name"),
        F.col("department_name").alias("sales_rep_department"),
    )
    return (
        amounts.join(buyer, "customer_id", "left")
        .join(seller, "employee_id", "left")
        .select(
            "order_id", "customer_id", "employee_id", "order_date", "order_month", "order_quarter", "order_year",
            "status", "payment_method", "shipping_address_city", "shipping_address_state", "customer_segment",
            "customer_city", "customer_state", "sales_rep_name", "sales_rep_department", "line_item_count",
            "gross_amount", "total_discount", "net_amount", "revenue",
        )
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per calendar month and its growth on the previous present month.

    Customers are counted by grouping per month and customer first: one shuffle
    of partial sums instead of every order repeated per distinct count. Orders
    need no distinct count, the fact has one row per order. The window without
    partition columns sees one row per calendar month.
    """
    per_customer = fact.groupBy("order_year", "order_month", "customer_id").agg(
        F.count("order_id").alias("_orders"),
        F.sum("revenue").alias("_revenue"),
        F.count("revenue").alias("_valued"),
        _count_status("cancelled").alias("_cancelled"),
        _count_status("refunded").alias("_refunded"),
    )
    months = per_customer.groupBy("order_year", "order_month").agg(
        F.sum("_orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("_revenue").alias("total_revenue"),
        (to_double(F.sum("_revenue")) / F.nullif(F.sum("_valued"), F.lit(0))).alias("avg_order_revenue"),
        F.sum("_cancelled").alias("cancelled_orders"),
        F.sum("_refunded").alias("refunded_orders"),
    )
    previous = F.lag("total_revenue").over(Window.orderBy(F.col("order_month").asc_nulls_last()))
    change = F.col("total_revenue") - F.col("prev_month_revenue")
    return (
        months.withColumn("prev_month_revenue", previous)
        .withColumn("mom_growth_pct", div0(change, F.col("prev_month_revenue")) * 100)
        .orderBy(F.col("order_month").asc_nulls_last())
    )


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    """Active customers with the highest lifetime value; ties by customer id."""
    return (
        customers.where(F.col("is_active"))
        .select(
            "customer_id", "full_name", "customer_segment", "city", "state", "total_orders", "lifetime_value",
            "avg_order_value", "rfm_category", "days_since_last_order",
        )
        .orderBy(F.col("lifetime_value").desc_nulls_first(), "customer_id")
        .limit(n)
    )
