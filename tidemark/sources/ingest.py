"""Reading, completing and appending raw tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import DEFAULTS, RAW


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(RAW[table]).parquet(path)


class RawTables:
    """The raw tables of a folder, one parquet table each, with their declared schemas, as attributes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, table: str) -> DataFrame:
        if table not in RAW:
            raise AttributeError(table)
        return read_raw(self.spark, table, f"{self.root}/{table}")


def literal_rows(spark: SparkSession, table: str, rows: list[tuple]) -> DataFrame:
    """A raw table from rows written in code."""
    return spark.createDataFrame(rows, RAW[table])


def conform(df: DataFrame, table: str, load_time: datetime | None = None) -> DataFrame:
    """Give incoming rows the exact columns and types of a raw table.

    A column the rows leave out takes its default, or NULL when it has none.
    A column that is present keeps its NULLs: defaults never replace them.
    """
    now = f"timestamp_ntz '{load_time}'" if load_time is not None else "localtimestamp()"
    texts = {True: "true", False: "false", "now": now, None: "null"}
    present, defaults = set(df.columns), DEFAULTS.get(table, {})

    def value(name: str) -> str:
        if name in present:
            return f"`{name}`"
        default = defaults.get(name)
        return texts[default] if default in texts else f"'{default}'"

    return df.selectExpr(
        *[f"cast({value(f.name)} as {f.dataType.simpleString()}) as `{f.name}`" for f in RAW[table].fields]
    )


def append(df: DataFrame, table: str, path: str, load_time: datetime | None = None) -> None:
    conform(df, table, load_time).write.mode("append").parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (tbl, row_count)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
