import glob
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import incremental, joins, quality, snapshot
from tidemark.operators.incremental import ConcurrentWrite, KeyedTable, latest_per_key, newer_than
from tidemark.operators.ordered import exact_percentiles, numbered, rank_ascending, running_sum
from tidemark.session import new_folder


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# Ordered operators against Spark's own windows, with one hot group


@pytest.fixture(scope="module")
def ledger(spark):
    pick = random.Random(7)
    data = []
    for i in range(2000):
        product = 1 if i % 3 == 0 else pick.randint(2, 40)
        amount = None if pick.random() < 0.1 else pick.randint(-9, 9)
        day = None if pick.random() < 0.02 else date(2020, 1, 1) + timedelta(days=pick.randint(0, 30))
        data.append((i, product, None if product == 5 else product % 3, day, amount))
    return spark.createDataFrame(data, "id long, product long, place long, day date, amount long")


def test_running_sum_equals_window(ledger):
    window = (
        Window.partitionBy("product", "place")
        .orderBy(F.col("day").asc_nulls_last(), "id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    want = ledger.withColumn("balance", F.sum("amount").over(window))
    got = running_sum(ledger, "amount", "balance", ["product", "place"], F.col("day"), [F.col("id")])
    assert rows(got, "id") == rows(want, "id")


def test_running_sum_without_keys(ledger):
    window = Window.orderBy(F.col("day").asc_nulls_last(), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = ledger.withColumn("balance", F.sum("amount").over(window))
    got = running_sum(ledger, "amount", "balance", [], F.col("day"), [F.col("id")])
    assert rows(got, "id") == rows(want, "id")


def test_running_sum_of_leading_nulls_is_null(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 4), (4, None)], "id long, v long")
    got = running_sum(df, "v", "s", [], F.floor(F.col("id") / 2), [F.col("id")])
    assert [r.s for r in got.orderBy("id").collect()] == [None, None, 4, 4]


def test_rank_equals_window(ledger):
    df = ledger.select("id", (F.col("amount") / 7).alias("v"))
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").asc_nulls_last())).cast("long"))
    assert rows(rank_ascending(df, "v", "r"), "id") == rows(want, "id")


def test_percentiles_equal_spark(ledger):
    df = ledger.withColumn("v", F.col("amount") * 1.25 + F.col("id") % 5)
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = exact_percentiles(df, ["place"], "v", points)
    want = df.groupBy("place").agg(*[F.percentile("v", p).alias(n) for n, p in points.items()])
    for g, w in zip(rows(got, "place"), rows(want, "place")):
        assert g == pytest.approx(w)


def test_percentile_interpolates_and_ignores_null(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 4.0), ("x", None)], "k string, v double")
    assert rows(exact_percentiles(df, ["k"], "v", {"p": 0.25}), "k") == [("x", 1.5)]


# Joins


def test_interval_join_equals_nested_loop(spark):
    pick = random.Random(3)
    start = date(2021, 1, 1)
    points = spark.createDataFrame(
        [(i, start + timedelta(days=pick.randint(0, 500))) for i in range(300)], "id long, day date"
    )
    spans = []
    for i in range(40):
        first = start + timedelta(days=pick.randint(0, 500))
        spans.append((i, first, first + timedelta(days=pick.choice([-3, 0, 1, 31, 200]))))
    intervals = spark.createDataFrame(spans, "span long, first date, last date")
    want = sorted(
        (p.id, s) for p in points.collect() for s, first, last in spans if first <= p.day <= last
    )
    got = joins.interval_join(points, "day", intervals, "first", "last").select("id", "span")
    assert rows(got, "id", "span") == want


@pytest.mark.parametrize("n", [1, 17, 1500])
def test_choose_by_hash_keeps_equal_rows(spark, n):
    import hashlib

    def h(*parts):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)

    items = spark.range(20).withColumn("note", F.lit("n"))
    places = spark.range(100, 100 + n).withColumnRenamed("id", "place")
    got = joins.choose_by_hash(items.unionByName(items), "id", places.unionByName(places), "place").select("id", "place")
    want = [(i, min((h(i, p), p) for p in range(100, 100 + n))[1]) for i in range(20)]
    assert rows(got, "id") == sorted(want * 2)
    grid = joins.with_every(items.select("id"), places, "place")
    assert rows(grid, "id", "place") == [(i, p) for i in range(20) for p in range(100, 100 + n)]


def test_more_candidates_than_one_page(spark, monkeypatch):
    items = spark.range(40).withColumn("note", F.lit("n"))
    items = items.unionByName(items)
    places = spark.range(100, 131).withColumnRenamed("id", "place")
    one = rows(joins.choose_by_hash(items, "id", places, "place").select("id", "place"), "id")
    grid = rows(joins.with_every(items.select("id"), places, "place"), "id", "place")
    monkeypatch.setattr(joins, "MOST_CANDIDATES", 4)
    got = joins.choose_by_hash(items, "id", places.unionByName(places), "place")
    assert got.columns == ["id", "note", "place"] and rows(got.select("id", "place"), "id") == one
    assert rows(joins.with_every(items.select("id"), places, "place"), "id", "place") == grid
    assert joins.with_every(items, places.where("false"), "place").count() == 0


def test_150_000_candidates(spark):
    import hashlib

    places = spark.range(150_000).withColumnRenamed("id", "place")
    got = joins.choose_by_hash(spark.createDataFrame([(7,), (7,)], "id long"), "id", places, "place").collect()
    want = min((hashlib.md5(f"7|{p}".encode()).hexdigest()[:8], p) for p in range(150_000))[1]
    assert [r.place for r in got] == [want, want]
    assert joins.with_every(spark.range(2), places, "place").distinct().count() == 300_000


def test_numbers_have_no_gaps(spark):
    pick = random.Random(4)
    data = [(7 if i % 3 else pick.randint(1, 9), pick.randint(1, 30), i, pick.randint(1, 3)) for i in range(800)]
    df = spark.createDataFrame(data, "a long, b long, c long, n long").repartition(5)
    place = [F.struct("a", F.floor(F.col("b") / 10)), [F.col("a"), F.col("b"), F.col("c")]]
    got = numbered(df, "last", F.floor(F.col("a") / 4), *place, copies="n")
    total, want = 0, []
    for a, b, c, n in sorted(data):
        total += n
        want.append((a, b, c, n, total))
    assert rows(got, "a", "b", "c") == want
    assert sorted(r.k for r in numbered(df, "k", F.floor(F.col("a") / 4), *place).collect()) == list(range(1, 801))


def test_ranks_in_a_narrow_band(spark):
    pick = random.Random(5)
    df = spark.createDataFrame([(i, 1000 + pick.randint(0, 300) / 1e6) for i in range(900)], "id long, v double")
    want = df.withColumn("r", F.rank().over(Window.orderBy("v")).cast("long"))
    assert rows(rank_ascending(df, "v", "r"), "id") == rows(want, "id")


# Incremental loads


SCHEMA = "id long, v string, loaded_at timestamp_ntz"


def stamp(day):
    return datetime(2024, 1, day)


def loaded(spark, table, batch):
    source = spark.createDataFrame(batch, SCHEMA)
    table.upsert(newer_than(source, table.read()) if table.exists() else source)
    return rows(table.read().select("id", "v"), "id")


def new_table(spark, key_range=10):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(spark, new_folder(spark, "test-table"), schema, "id", key_range)


def test_upsert_replaces_adds_and_skips_old_stamps(spark):
    table = new_table(spark)
    assert not table.exists()
    assert loaded(spark, table, [(1, "a", stamp(1)), (25, "b", stamp(2))]) == [(1, "a"), (25, "b")]
    # 1 is updated, 30 is new, 7 has the watermark itself and 8 an older stamp.
    batch = [(1, "A", stamp(3)), (30, "c", stamp(3)), (7, "late", stamp(2)), (8, "older", stamp(1))]
    assert loaded(spark, table, batch) == [(1, "A"), (25, "b"), (30, "c")]
    assert loaded(spark, table, batch) == [(1, "A"), (25, "b"), (30, "c")]


def test_empty_target_loads_everything(spark):
    table = new_table(spark)
    table.refresh(spark.createDataFrame([], SCHEMA))
    assert loaded(spark, table, [(1, "a", stamp(1))]) == [(1, "a")]


def test_upsert_keeps_the_latest_of_repeated_keys(spark):
    table = new_table(spark)
    loaded(spark, table, [(1, "a", stamp(1))])
    assert loaded(spark, table, [(2, "x", stamp(2)), (2, "y", stamp(4)), (2, "z", stamp(3))]) == [(1, "a"), (2, "y")]


def test_upsert_leaves_other_partitions_alone(spark):
    table = new_table(spark)
    table.refresh(spark.createDataFrame([(i, "a", stamp(1)) for i in range(-20, 40)], SCHEMA))
    before = {f for f in table.read().where("id >= 20").inputFiles()}
    part = {f for f in before if "_part=3" in f}
    loaded(spark, table, [(5, "b", stamp(2)), (-15, "c", stamp(2))])
    after = set(table.read().inputFiles())
    assert part <= after and not any("_version=1/" in f and "_part=0" in f for f in after)
    assert table.read().count() == 60


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_equal_one_refresh(spark, batches):
    data = [(i, f"v{i}", stamp(1 + i * 20 // 40)) for i in range(40)]
    table = new_table(spark)
    for n in range(1, batches + 1):
        last = stamp(1 + 20 * n // batches)
        loaded(spark, table, [r for r in data if r[2] <= last])
    assert rows(table.read(), "id") == data


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", stamp(1)), (1, "b", stamp(2)), (2, "only", None), (3, "x", None), (3, "y", stamp(1))], SCHEMA)
    want = [(1, "b", stamp(2)), (2, "only", None), (3, "y", stamp(1))]
    assert rows(latest_per_key(df, "id", "loaded_at"), "id") == want


def test_sized_table_covers_the_keys(spark):
    df = spark.createDataFrame([(i * 10, "a", stamp(1)) for i in range(100)], SCHEMA)
    assert KeyedTable.sized("p", df, df.schema, "id", 30).key_range == 248
    assert KeyedTable.sized("p", df.where("id < 0"), df.schema, "id", 30).key_range == 30


def test_small_first_load_does_not_cut_the_table_small(spark):
    def batch(ids):
        return spark.createDataFrame([(i, "a", stamp(1)) for i in ids], SCHEMA)

    path, schema = new_folder(spark, "test-table"), batch([1]).schema
    table = KeyedTable.sized(path, batch(range(10)), schema, "id", 1000)
    table.upsert(batch(range(10)))
    table.upsert(batch(range(10, 4990)))
    table = KeyedTable.stored(spark, path, schema, "id")
    assert table.key_range == 1000 and len(table._folders()) == 5 and table.read().count() == 4990


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_newest_version_wins_however_batches_are_cut(spark, batches):
    versions = [(1, "february", stamp(20)), (2, "a", stamp(1)), (1, "january", stamp(2)), (2, None, stamp(3)), (3, "x", None), (3, "y", stamp(1)), (1, "first", stamp(1)), (4, "z", None)]
    table = new_table(spark)
    for k in range(batches):
        table.upsert(spark.createDataFrame(versions[len(versions) * k // batches : len(versions) * (k + 1) // batches], SCHEMA))
    assert rows(table.read(), "id") == [(1, "february", stamp(20)), (2, None, stamp(3)), (3, "y", stamp(1)), (4, "z", None)]


def test_dead_writes_are_not_seen(spark):
    table = new_table(spark)
    table.upsert(spark.createDataFrame([(1, "a", stamp(1))], SCHEMA))
    spark.createDataFrame([(1, "dead", stamp(9))], SCHEMA).selectExpr("*", "10L as _range", "0L as _part").write.partitionBy(
        "_range", "_part"
    ).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/_version=2")
    assert rows(table.read(), "id") == [(1, "a", stamp(1))]
    table.upsert(spark.createDataFrame([(2, "b", stamp(2))], SCHEMA))
    assert rows(table.read().select("id", "v"), "id") == [(1, "a"), (2, "b")]


def test_many_upserts_expire_to_one_load(spark):
    data = [(i % 37, f"v{i}", stamp(1 + i // 8)) for i in range(200)]
    table, whole = new_table(spark), new_table(spark)
    for k in range(0, 200, 10):
        table.upsert(spark.createDataFrame(data[k : k + 10], SCHEMA))
    whole.upsert(spark.createDataFrame(data, SCHEMA))
    want = rows(whole.read(), "id")
    assert rows(table.read(), "id") == want and len(table.manifests()) == 20
    earlier = rows(table.read(19), "id")
    assert table.expire(keep=2) > 0 and table.manifests() == [19, 20]
    assert rows(table.read(), "id") == want and rows(table.read(19), "id") == earlier != want
    table.expire()
    kept = glob.glob(f"{table.path}/_version=*/_writer=*/_range=*/_part=*")
    assert len(kept) == len(table._folders()) and rows(table.read(), "id") == want and table.expire() == 0
    table.upsert(spark.createDataFrame([(99, "new", stamp(30))], SCHEMA))
    assert table.manifests() == [20, 21] and table.read().count() == len(want) + 1


def test_of_two_writers_one_commits(spark):
    table = new_table(spark)
    assert table.expire() == 0
    table.upsert(spark.createDataFrame([(1, "a", stamp(1))], SCHEMA))
    begun = table._manifest()
    table.upsert(spark.createDataFrame([(2, "b", stamp(2))], SCHEMA))
    late = table._keyed(spark.createDataFrame([(3, "c", stamp(3))], SCHEMA))
    with pytest.raises(ConcurrentWrite):
        table._write(late, begun, whole=False)
    assert [r[0] for r in rows(table.read(), "id")] == [1, 2] and table.manifests() == [1, 2]
    assert not glob.glob(f"{table.path}/_manifest/draft*")
    # The folder of the writer that lost goes with the old ones.
    table.expire()
    assert len(glob.glob(f"{table.path}/_version=2/_writer=*")) == 1
    table.upsert(spark.createDataFrame([(3, "c", stamp(3))], SCHEMA))
    assert table.read().count() == 3


def test_rows_of_unlike_keys_stay_where_they_are(spark, monkeypatch):
    """Only keys that repeat, or more ranges than a task keeps open, let whole rows be shuffled."""
    table, settled = new_table(spark), []
    real = incremental.latest_per_key
    monkeypatch.setattr(incremental, "latest_per_key", lambda *a: settled.append(1) or real(*a))
    table.upsert(spark.createDataFrame([(i, "a", stamp(1)) for i in range(25)], SCHEMA))
    table.upsert(spark.createDataFrame([(i, "b", stamp(2)) for i in range(25, 45)], SCHEMA))
    assert not settled and table.read().count() == 45
    table.refresh(table.read())
    assert not settled and table.read().count() == 45
    table.upsert(spark.createDataFrame([(7, "new", stamp(3))], SCHEMA))
    assert settled and rows(table.read().where("id = 7").select("id", "v"), "id") == [(7, "new")]
    monkeypatch.setattr(incremental, "MOST_OPEN", 2)
    before = len(settled)
    table.refresh(table.read())
    assert len(settled) > before and table.read().count() == 45
    assert len(glob.glob(f"{table.path}/_version=5/_writer=*")) == 1


def test_few_candidates_are_compiled_and_choose_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i,) for i in range(300)] + [(None,)], "id long")
    places = spark.createDataFrame([(6000 + i,) for i in range(5)], "place long")
    few = joins.choose_by_hash(items, "id", places, "place")
    assert "lambda" not in few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(joins, "FEW_CANDIDATES", 0)
    assert sorted(few.collect(), key=str) == sorted(joins.choose_by_hash(items, "id", places, "place").collect(), key=str)


# History


def campaign(spark, *data):
    return spark.createDataFrame(list(data), "id long, status string, updated_at timestamp_ntz")


def versions(history):
    return rows(history.select("id", "status", "valid_from", "valid_to"), "id", "valid_from")


def test_snapshot_versions(spark):
    first = snapshot.first_snapshot(
        campaign(spark, (1, "planned", stamp(1)), (2, "active", stamp(1)), (3, "active", stamp(1))), "id", "updated_at"
    )
    # 1 changed, 2 has a new status under the old timestamp, 3 vanished, 4 is new.
    incoming = campaign(spark, (1, "active", stamp(5)), (2, "paused", stamp(1)), (4, "planned", stamp(4)))
    second = snapshot.next_snapshot(first, incoming, "id", "updated_at")
    want = [
        (1, "planned", stamp(1), stamp(5)),
        (1, "active", stamp(5), None),
        (2, "active", stamp(1), None),
        (3, "active", stamp(1), None),
        (4, "planned", stamp(4), None),
    ]
    assert versions(second) == want
    assert versions(snapshot.next_snapshot(second, incoming, "id", "updated_at")) == want
    assert second.select("version_id").distinct().count() == 5


def test_valid_at_includes_the_start_and_excludes_the_end(spark):
    first = snapshot.first_snapshot(campaign(spark, (1, "planned", stamp(1))), "id", "updated_at")
    history = snapshot.next_snapshot(first, campaign(spark, (1, "active", stamp(5))), "id", "updated_at")

    def at(day):
        return [r.status for r in snapshot.valid_at(history, F.lit(stamp(day))).collect()]

    assert (at(1), at(4), at(5)) == (["planned"], ["planned"], ["active"])


# Quality


def test_checks_find_planted_defects(spark):
    child = spark.createDataFrame(
        [(1, 10, "ok"), (1, 99, "bad"), (None, 99, "bad"), (2, None, None), (None, 10, "odd")],
        "id long, parent long, word string",
    )
    parent = spark.createDataFrame([(10,)], "parent long")
    checks = [
        quality.Check("t", "not_null", ("id",)),
        quality.Check("t", "not_null", ("word",)),
        quality.Check("t", "unique", ("id",)),
        quality.Check("t", "unique_combination", ("id", "word")),
        quality.Check("t", "accepted_values", ("word",), values=("ok",)),
        quality.Check("t", "relationships", ("parent",), parent="p", parent_column="parent"),
    ]
    found = {(r.test, r.column_name): r.failures for r in quality.report({"t": child, "p": parent}, checks).collect()}
    assert found == {
        ("not_null", "id"): 2,
        ("not_null", "word"): 1,
        ("unique", "id"): 1,
        ("unique_combination", "id, word"): 0,
        ("accepted_values", "word"): 2,
        ("relationships", "parent"): 2,
    }
    assert rows(quality.unique(child, "id"), "id") == [(1, 2)]
    assert rows(quality.relationships(child, "parent", parent, "parent"), "parent") == [(99, 2)]


def test_null_tuples_count_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1)], "a long, b long")
    assert quality.unique_combination(df, ("a", "b")).count() == 1
