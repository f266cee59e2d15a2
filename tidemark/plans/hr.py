"""HR marts: employees, headcount, salary distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_avg
from tidemark.operators.ordered import exact_percentiles


def dim_employees(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees with department and manager; heads are those without a manager.

    ``department_id`` is the department's, so it is NULL when there is none.
    """
    e, d = employees.alias("e"), departments.alias("d")
    m = employees.select(
        F.col("employee_id").alias("_manager"), F.col("full_name").alias("manager_name"),
        F.col("job_title").alias("manager_title"),
    )
    return (
        e.join(d, F.col("e.department_id") == F.col("d.department_id"), "left")
        .join(m, F.col("e.manager_id") == F.col("_manager"), "left")
        .select(
            "e.employee_id", "e.full_name", "e.first_name", "e.last_name", "e.email", "e.phone", "e.job_title",
            "e.salary", "e.salary_band", "e.hire_date", "e.tenure_years", "e.employment_status", "e.city", "e.state",
            "d.department_id", "d.department_name", F.col("d.location").alias("department_location"),
            "manager_name", "manager_title", F.col("e.manager_id").isNull().alias("is_department_head"),
        )
    )


def _active(employees: DataFrame) -> DataFrame:
    return employees.where(F.col("employment_status") == "active")


def headcount_by_department(employees: DataFrame) -> DataFrame:
    def band(name: str) -> Column:
        return F.count_if(F.col("salary_band") == name).alias(f"{name}_count")

    return (
        _active(employees)
        .groupBy("department_id", "department_name", "department_location")
        .agg(
            F.count(F.lit(1)).alias("headcount"),
            F.count_if("is_department_head").alias("department_heads"),
            F.sum("salary").alias("total_payroll"),
            exact_avg(F.col("salary")).alias("avg_salary"),
            F.min("salary").alias("min_salary"),
            F.max("salary").alias("max_salary"),
            exact_avg(F.col("tenure_years")).alias("avg_tenure_years"),
            F.min("hire_date").alias("earliest_hire_date"),
            F.max("hire_date").alias("most_recent_hire_date"),
            band("junior"), band("mid"), band("senior"), band("executive"),
        )
    )


def salary_distribution(employees: DataFrame) -> DataFrame:
    """Salary percentiles per department name, rounded to four decimals.

    Exact percentiles from cumulative counts, so a department that holds most of
    the staff is not gathered in one task.
    """
    staff = _active(employees).select("department_name", "salary", F.col("salary").cast("double").alias("_salary"))
    summary = staff.groupBy("department_name").agg(
        F.count(F.lit(1)).alias("headcount"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        exact_avg(F.col("salary")).alias("avg_salary"),
        F.sum("salary").alias("total_payroll"),
    )
    points = {"p25_salary": 0.25, "median_salary": 0.5, "p75_salary": 0.75}
    percentiles = exact_percentiles(staff, ["department_name"], "_salary", points).withColumnRenamed(
        "department_name", "_department"
    )
    return (
        summary.join(percentiles, F.col("department_name").eqNullSafe(F.col("_department")), "left")
        .select(
            "department_name", "headcount", "min_salary", *[F.round(p, 4).alias(p) for p in points], "max_salary",
            "avg_salary", "total_payroll",
        )
        .orderBy(F.col("avg_salary").desc_nulls_first())
    )
