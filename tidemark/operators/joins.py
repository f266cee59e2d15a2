"""Joins Spark has no operator for: date-in-interval, and lowest-hash choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import month_start, stable_digits
from tidemark.session import spread, stage

# So many candidates travel to every task as one array; longer lists meet the rows page by page.
MOST_CANDIDATES = 100_000
# Up to so many are written into the expression, which Spark then compiles; a lambda over an array it does not.
FEW_CANDIDATES = 16


def interval_join(points: DataFrame, at: str, intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Pairs of a dated row and an interval that contains its date, ends included.

    Intervals are repeated once per calendar month they touch, which turns the
    range condition into an equality on the month plus a filter. Each pair comes
    out once, because a date lies in one month. Spark broadcasts the intervals
    when they prove small at run time, and shuffles (splitting a hot month)
    when they do not.
    """
    by_month = intervals.where(F.col(start) <= F.col(end)).withColumn(
        "_month", F.explode(F.expr(f"sequence(trunc({start}, 'MM'), trunc({end}, 'MM'), interval 1 month)"))
    )
    return (
        points.withColumn("_month", month_start(F.col(at)))
        .join(by_month, "_month")
        .where(F.col(at).between(F.col(start), F.col(end)))
        .drop("_month")
    )


def _whole(candidates: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The distinct candidates, and how many they are."""
    ids = candidates.select(F.col(name).cast("long").alias(name)).distinct()
    return ids, ids.count()


def _listed(ids: DataFrame, name: str) -> Column:
    """The candidates in order, as one array that Spark reads when the query runs."""
    return ids.agg(F.array_sort(F.collect_list(name)).alias("ids")).scalar()


def _paged(rows: DataFrame, ids: DataFrame, name: str, n: int) -> DataFrame:
    """Each row once per page of candidates, with the page as the array ``_ids``.

    A page is met by an equality on its number, and every page number several times,
    once per lane: so neither a page nor the rows are dealt to a single task.
    """
    pages = -(-n // MOST_CANDIDATES) if n else 0
    lanes = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    page = F.pmod(F.xxhash64(name), F.lit(max(1, pages)).cast("long"))
    listed = ids.groupBy(page.alias("_page")).agg(F.collect_list(name).alias("_ids"))
    listed = listed.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    spaced = rows.withColumn("_lane", F.pmod(F.monotonically_increasing_id(), F.lit(lanes)).cast("int"))
    spaced = spaced.withColumn("_page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))
    return spaced.join(listed, ["_lane", "_page"]).drop("_lane", "_page")


def with_every(rows: DataFrame, candidates: DataFrame, name: str) -> DataFrame:
    """Each row once per candidate, of any number.

    Up to ``MOST_CANDIDATES`` they are generated inside the row, without a join or shuffle;
    beyond, page by page.
    """
    ids, n = _whole(candidates, name)
    if n <= MOST_CANDIDATES:
        return rows.withColumn(name, F.explode(_listed(ids, name)))
    return _paged(rows, stage(ids, "candidates"), name, n).withColumn(name, F.explode("_ids")).select(*rows.columns, name)


def choose_by_hash(rows: DataFrame, key: str, candidates: DataFrame, name: str) -> DataFrame:
    """Add the candidate ``name`` whose hash with the row's ``key`` is lowest; ties go to the smaller candidate.

    Up to ``MOST_CANDIDATES`` the choice is a projection of each row: rows are neither moved
    nor merged, and equal rows stay as many as they were. Beyond, each page gives a row its
    best candidate, and the least of them is the row's, under a number that keeps equal rows apart.
    """

    def best() -> Column:
        return F.array_min(F.transform("_ids", lambda c: F.struct(stable_digits(F.col(key), c).alias("hash"), c.alias(name))))

    ids, n = _whole(candidates, name)
    if 1 < n <= FEW_CANDIDATES:
        known = [row[name] for row in ids.collect()]
        if None not in known:
            each = [F.struct(stable_digits(F.col(key), F.lit(c)).alias("hash"), F.lit(c).cast("long").alias(name)) for c in known]
            return rows.withColumn(name, F.least(*each).getField(name))
    if n <= MOST_CANDIDATES:
        return rows.withColumn("_ids", _listed(ids, name)).withColumn(name, best().getField(name)).drop("_ids")
    numbered = stage(spread(rows).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = _paged(numbered.select("_row", key), stage(ids, "candidates"), name, n)
    found = found.select("_row", best().alias("_best")).groupBy("_row").agg(F.min("_best").alias("_best"))
    return numbered.join(found, "_row").select(*rows.columns, F.col(f"_best.{name}").alias(name))
