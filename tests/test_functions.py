from datetime import date

from pyspark.sql import functions as F

from tidemark import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def day(text):
    return F.lit(date.fromisoformat(text))


def test_div0(spark):
    df = spark.createDataFrame([(1, 0), (4, 2), (1, None), (None, 0), (None, 2)], "a long, b long")
    assert [r.x for r in df.select(fn.div0(F.col("a"), F.col("b")).alias("x")).collect()] == [0, 2, None, 0, None]


def test_exact_avg_counts_zeros_but_not_nulls(spark):
    df = spark.createDataFrame([(0,), (3,), (None,)], "x long")
    assert df.agg(fn.exact_avg(F.col("x"))).first()[0] == 1.5
    assert df.where("x is null").agg(fn.exact_avg(F.col("x"))).first()[0] is None


def test_week_boundaries(spark):
    assert one(spark, fn.weeks_crossed(day("2023-01-01"), day("2023-01-02"))) == 1
    assert one(spark, fn.weeks_crossed(day("2023-01-01"), day("2023-03-31")) + 1) == 14
    assert one(spark, fn.weeks_crossed(day("2023-01-02"), day("2023-01-08"))) == 0
    assert one(spark, fn.week_start(day("2023-01-01"))) == date(2022, 12, 26)


def test_month_and_year_boundaries(spark):
    assert one(spark, fn.months_crossed(day("2023-01-31"), day("2023-02-01"))) == 1
    assert one(spark, fn.months_crossed(day("2022-11-30"), day("2023-02-01"))) == 3
    assert one(spark, fn.years_crossed(day("1985-12-31"), day("1986-01-01"))) == 1
    assert one(spark, fn.days_between(day("2023-01-01"), day("2023-03-01"))) == 59
    assert one(spark, fn.quarter_start(day("2023-05-31"))) == date(2023, 4, 1)
    assert one(spark, fn.add_weeks(day("2023-01-02"), F.lit(8))) == date(2023, 2, 27)


def test_hash_is_the_start_of_an_md5(spark):
    import hashlib

    expected = int(hashlib.md5(b"17|day").hexdigest()[:8], 16)
    assert one(spark, fn.stable_hash(F.lit(17), F.lit("day"))) == expected
    assert one(spark, fn.hash_bucket(60, F.lit(17), F.lit("day"))) == expected % 60
