"""Running sums, ranks and percentiles that no single hot group can stall.

A plain window sorts a whole partition in one task, and a window without
partition columns sorts the whole table there. These operators cut the order
into blocks first: totals per block are aggregated (with map-side combine),
only those totals are summed up in order, and each row then needs a window over
its own block alone. Every row is kept and every result is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import COMPACT, stage


def with_value_block(df: DataFrame, value: str) -> DataFrame:
    """Stage the rows with ``_block``, a number that does not decrease with ``value``; NULLs come last.

    Blocks are the partitions of a range shuffle, which Spark cuts at sampled
    quantiles. However close values lie, each block is about one task's share.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(
        df.repartitionByRange(parts, F.col(value).asc_nulls_last()).withColumn("_block", F.spark_partition_id()), "value-blocks"
    )


def _add_ignoring_null(a: Column, b: Column) -> Column:
    zero = F.lit(0)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, zero) + F.coalesce(b, zero))


def running_sum(
    df: DataFrame, value: str, out: str, keys: list[str], block: Column, order: list[Column]
) -> DataFrame:
    """``sum(value)`` from the first row of ``keys`` to the current row.

    ``block`` must not decrease along ``order`` and puts NULLs last. The sum of
    only NULLs is NULL, as in a window.
    """
    # The keys as one struct, which is never NULL: a plain equality then joins NULL keys too, and
    # the shuffle that serves the join serves the window.
    rows = df.withColumn("_at", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], block.alias("block")))
    earlier = (
        Window.partitionBy(*[f"_at.k{i}" for i in range(len(keys))])
        .orderBy(F.col("_at.block").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        rows.groupBy("_at")
        .agg(F.sum(value).alias("_total"))
        .select("_at", F.sum("_total").over(earlier).alias("_before"))
    )
    inside = Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.join(before, "_at", "left")
        .withColumn(out, _add_ignoring_null(F.col("_before"), F.sum(value).over(inside)))
        .select(*df.columns, out)
    )


def numbered(
    df: DataFrame, out: str, coarse: Column, block: Column, order: list[Column], copies: str | None = None, every: bool = False
) -> DataFrame:
    """Number the rows from 1 without gaps, in the order of ``coarse``, ``block`` and ``order``.

    One range shuffle brings the rows into order, and each task numbers its own; what is put in
    one order beyond that is a total per task, never per key. The order must tell unequal rows apart.
    ``copies`` names a column that says how many numbers a row takes; ``out`` is the last of
    them, or with ``every`` the row comes out once for each. The rows are staged.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [coarse.asc_nulls_last(), block.asc_nulls_last(), *order]
    rows = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    if copies is not None:
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long"))))
    # The number of the task above 33 bits, and the row's place in it below.
    rows = stage(rows.withColumn("_place", F.monotonically_increasing_id()), "numbered", **COMPACT)
    task, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    upto = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = before.select("_task", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_offset"))
    # At most one total per shuffle partition, so it is safe to give them to every task.
    listed = before.agg(F.map_from_entries(F.collect_list(F.struct("_task", "_offset"))).alias("m"))
    if copies is not None and not every:
        rows = rows.where(F.col("_copy") == F.col(copies))
    return rows.withColumn(out, listed.scalar()[task] + place + 1).select(*df.columns, out)


def rank_ascending(df: DataFrame, value: str, out: str) -> DataFrame:
    """Global ``rank()`` over a double column, NULLs last.

    Ties collapse to one row per distinct value before anything is ordered, so
    a value shared by a third of the rows costs one row.
    """
    counts = with_value_block(df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), value)
    ranked = running_sum(counts, "_n", "_upto", [], F.col("_block"), [F.col(value).asc_nulls_last()])
    ranked = ranked.select(F.struct(F.col(value).alias("v")).alias("_value"), (F.col("_upto") - F.col("_n") + 1).alias(out))
    return df.withColumn("_value", F.struct(F.col(value).alias("v"))).join(ranked, "_value", "left").select(*df.columns, out)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles of a double column per group.

    Equal to ``percentile(value, p)``, but no task holds a group's values: the
    two neighbouring values are found from cumulative counts. The counts per
    distinct value are staged, as three steps read them.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = with_value_block(counts, value)
    upto = running_sum(counts, "_n", "_upto", keys, F.col("_block"), [F.col(value).asc()])
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    totals = totals.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], "_total")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)])
    positioned = upto.join(totals, match)

    picks, results = [], []
    for name, p in probabilities.items():
        position = (F.col("_total") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.min(F.when(F.col("_upto") > index, F.col(value))).alias(f"_{name}_{side}"))
        share = (F.max("_total") - 1) * F.lit(float(p))
        picks.append((share - F.floor(share)).alias(f"_{name}_share"))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((lo + (hi - lo) * F.col(f"_{name}_share")).alias(name))
    return positioned.groupBy(*keys).agg(*picks).select(*keys, *results)
