"""Slowly changing dimension history: one row per version, with its validity.

History columns: the source columns, then ``version_id`` (MD5 of key and source
timestamp), ``source_updated_at``, ``valid_from`` and ``valid_to`` (NULL while the
version is current).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _version(df: DataFrame, key: str, stamp: str) -> DataFrame:
    return df.select(
        *df.columns,
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(stamp).cast("string"))).alias("version_id"),
        F.col(stamp).alias("source_updated_at"),
        F.col(stamp).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def first_snapshot(incoming: DataFrame, key: str, stamp: str) -> DataFrame:
    return _version(incoming, key, stamp)


def next_snapshot(history: DataFrame, incoming: DataFrame, key: str, stamp: str) -> DataFrame:
    """History after one more look at the source.

    A later source timestamp closes the current version at that time and opens a
    new one. Unchanged keys keep their version, vanished keys stay open.
    """
    current = history.where(F.col("valid_to").isNull())
    seen = incoming.select(key, F.col(stamp).alias("_seen"))
    closed_or_kept = (
        current.join(seen, key, "left")
        .withColumn("valid_to", F.when(F.col("_seen") > F.col("source_updated_at"), F.col("_seen")))
        .select(*history.columns)
    )
    known = current.select(key, F.col("source_updated_at").alias("_known"))
    opened = (
        incoming.join(known, key, "left")
        .where(F.col("_known").isNull() | (F.col(stamp) > F.col("_known")))
        .select(*incoming.columns)
    )
    past = history.where(F.col("valid_to").isNotNull())
    return past.unionByName(closed_or_kept).unionByName(_version(opened, key, stamp))


def valid_at(history: DataFrame, moment: Column) -> DataFrame:
    """The version of each key that was current at ``moment``."""
    return history.where(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )
