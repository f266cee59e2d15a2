"""Data-quality checks: each yields the failing rows, a report counts them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""

    @property
    def column(self) -> str:
        return ", ".join(self.columns)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unique_combination(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Tuples that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Distinct values outside the list, with their count; NULL is accepted."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child values without a parent, with their count of child rows.

    Child rows collapse to one per value before the join, so a value shared by a
    third of the child table is looked up once.
    """
    return (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")
    )


def _labelled(check: Check, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("test"),
        F.col("failures").cast("long").alias("failures"),
    )


def _null_counts(table: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """All NULL checks of a table in one pass."""
    counts = df.agg(*[F.count_if(F.col(c.column).isNull()).alias(c.column) for c in checks])
    return counts.unpivot(
        [], [c.column for c in checks], "column_name", "failures"
    ).select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failures"
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    """All parts, joined in halves: each is analysed a few times, not once per later part."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _union(parts[:half]).unionByName(_union(parts[half:]))


def report(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: (table_name, column_name, test, failures).

    ``failures`` counts failing rows for not_null and relationships, and failing
    values (or tuples) for the others.
    """
    parts = []
    for table in dict.fromkeys(c.table for c in checks if c.kind == "not_null"):
        of_table = [c for c in checks if c.table == table and c.kind == "not_null"]
        parts.append(_null_counts(table, tables[table], of_table))
    for check in checks:
        df = tables[check.table]
        rows = F.count(F.lit(1)).alias("failures")
        if check.kind == "unique":
            parts.append(_labelled(check, unique(df, check.column).agg(rows)))
        elif check.kind == "unique_combination":
            parts.append(_labelled(check, unique_combination(df, check.columns).agg(rows)))
        elif check.kind == "accepted_values":
            parts.append(_labelled(check, accepted_values(df, check.column, check.values).agg(rows)))
        elif check.kind == "relationships":
            orphans = relationships(df, check.column, tables[check.parent], check.parent_column)
            parts.append(_labelled(check, orphans.agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures"))))
    return _union(parts)
