"""What each filter of a chain removes, in every order of the chain, kept up to date as files arrive.

A stream reads the documents in micro-batches. Four filters judge a text alone; the fifth, exact
copies, depends on the least id that a text has been seen with, which is the state of a stateful
operator, kept by the texts' SHA-256 in buckets of it. A smaller id that comes later takes the place of the one
before: the earlier holder's mask is retracted from the counters of its part and added again as a
copy. Counters per part and mask hold all that the report needs, for any order of the filters.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import new_folder

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
_NO_ID = 2 * COPY  # beside the mask of a row without an id, which travels with an id of 0: pandas has no whole numbers with gaps
_COMBINED = 50_000  # rows that a task combines at once
_BUCKETS = 16  # groups of texts per shuffle partition, each with one state: a state of its own for every text costs milliseconds a text


def mask(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    counted = F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("unlike"))
    # One element, so that the words are counted once and read by two conditions.
    bits = F.transform(
        F.array(counted),
        lambda c: F.when(c["n"] < 200, 1).otherwise(0) + F.when(100 * c["unlike"].cast("long") < 50 * c["n"].cast("long"), 2).otherwise(0),
    )[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    shouting = F.when(100 * capitals > 2 * F.length(text).cast("long"), 4).otherwise(0)
    return bits + shouting + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def _least_first(buckets: int):
    """Of the rows of one text in a chunk only those of the least id go to the text's state; the others are copies for certain.

    Rows without an id are nobody's copy. Settled rows of both kinds are dealt over all buckets in turn.
    """

    def emit(rows: list[pa.RecordBatch], turn: int) -> pa.RecordBatch:
        df = pa.Table.from_batches(rows).to_pandas(types_mapper=pd.ArrowDtype)
        df = df.groupby(["bucket", "key", "id", "part", "mask"], sort=False, as_index=False)["n"].sum()
        known = df["mask"] < _NO_ID
        copies = known & (df["id"] > df["id"].where(known).groupby(df["key"]).transform("min")).fillna(False)
        df["settled"] = (copies | ~known).astype(bool)
        df.loc[copies, "mask"] += COPY
        df.loc[df["settled"], "bucket"] = (np.arange(int(df["settled"].sum())) + turn) % buckets
        return pa.RecordBatch.from_pandas(df, preserve_index=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, turn = [], 0, id(batches) >> 4
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= _COMBINED:
                yield emit(held, turn)
                held, n, turn = [], 0, turn + n
        if n:
            yield emit(held, turn)

    return run


def _hold(_, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Changes (id, part, mask, n) that rows bring to the texts of a bucket.

    State: for each text its least id so far, and how many rows of that id stand in each part.
    """
    texts, changed = pickle.loads(state.get[0]) if state.exists else {}, False
    for df in frames:
        out = []
        for settled, text, id_, part, own, n in zip(*(df[c].tolist() for c in ("settled", "key", "id", "part", "mask", "n"))):
            least, held = (None, {}) if settled else texts.get(text, (None, {}))
            if settled or (least is not None and id_ > least):
                out.append((id_, part, own if settled else own + COPY, n))
                continue
            if least != id_:
                for p, c in held.items():
                    out += [(least, p, own, -c), (least, p, own + COPY, c)]
                held = {}
            held[part] = held.get(part, 0) + n
            texts[text], changed = (id_, held), True
            out.append((id_, part, own, n))
        yield pd.DataFrame(out, columns=["id", "part", "mask", "n"])
    if changed:
        state.update((pickle.dumps(texts),))


def changes(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Of a stream of documents, the stream of changes (id, part, mask, n): rows to count, or with negative n to count no more.

    The mask of a row without an id holds 32 more.
    """
    session = docs.sparkSession
    id_type = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    no_id = F.when(F.col("id").isNull(), _NO_ID).otherwise(0)
    rows = rows.select(
        F.unhex(F.sha2(F.col("t"), 256)).alias("key"), F.coalesce("id", F.lit(0).cast(id_type)).alias("id"), "part",
        (mask(F.col("t")) + no_id).alias("mask"), F.lit(1).cast("long").alias("n"),
    )
    buckets = _BUCKETS * int(session.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "*")
    combined = T.StructType([*rows.schema.fields, T.StructField("settled", T.BooleanType())])
    out = f"id {id_type.simpleString()}, part string, mask int, n long"
    return rows.mapInArrow(_least_first(buckets), combined).groupBy("bucket").applyInPandasWithState(
        _hold, out, "texts binary", "update", "NoTimeout"
    )


def flags(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(id, good, toxic) of labelled ids; of a repeated id any 1 counts."""
    marks = [F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*marks).where("good + toxic > 0")


class Audit:
    """Counters (part, mask, good, toxic, n) of all files a folder has shown, below ``root``.

    ``drain`` works off the files that came since the last call. A micro-batch writes its changes and
    the counters they add up to in folders of its number, so that a batch repeated after a failure
    replaces its own; the report reads the sum of all batches.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "doc_id", text: str = "text", part: str = "source"):
        self.spark, self.root, self.schema = spark, root, schema
        self.key, self.text, self.part = key, text, part

    def drain(self, path: str, labels: DataFrame, files_per_batch: int = 10_000) -> None:
        marks = flags(labels, self.key)
        cells = ["part", "mask", "good", "toxic"]

        def count(batch: DataFrame, number: int) -> None:
            done = f"{self.root}/changes/batch={number}"
            batch.write.mode("overwrite").parquet(done)
            rows = self.spark.read.schema(batch.schema).parquet(done)
            # Only the change that is left of an id meets the labels.
            rows = rows.groupBy("id", "part", "mask").agg(F.sum("n").alias("n")).where("n <> 0")
            known = rows.where(F.col("mask") < _NO_ID).join(marks, "id", "left").na.fill(0, ["good", "toxic"])
            lost = rows.where(F.col("mask") >= _NO_ID).withColumns({"mask": F.col("mask") - _NO_ID, "good": F.lit(0), "toxic": F.lit(0)})
            counted = known.select(*cells, "n").unionByName(lost.select(*cells, "n")).groupBy(*cells).agg(F.sum("n").alias("n"))
            counted.write.mode("overwrite").parquet(f"{self.root}/counters/batch={number}")

        needed = T.StructType([f for f in self.schema.fields if f.name in (self.key, self.text, self.part)])
        stream = self.spark.readStream.schema(needed).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        (
            changes(stream, self.key, self.text, self.part)
            .writeStream.outputMode("update").foreachBatch(count)
            .option("checkpointLocation", f"{self.root}/stream").trigger(availableNow=True).start().awaitTermination()
        )

    def counters(self) -> DataFrame:
        cells = "part string, mask int, good int, toxic int, n long"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/counters")
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], cells)
        rows = self.spark.read.schema(cells).parquet(f"{self.root}/counters/batch=*")
        return rows.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def _orders() -> Column:
    """All orders and steps as rows: the filter's bit, and the bits of the filters before it."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        for step, name in enumerate(order, 1):
            before = sum(1 << FILTERS.index(c) for c in order[: step - 1])
            steps.append(f"named_struct('filter_order', '{order}', 'step', {step}, 'bit', {1 << FILTERS.index(name)}, 'before', {before})")
    return F.expr(f"inline(array({', '.join(steps)}))")


def report(counters: DataFrame) -> DataFrame:
    """One row per part, order and step, from at most 128 counters per part.

    A document counts for its filter's ``shapley`` once in each order in which that filter removes
    it, so a document that fails k filters counts 120 / k times for each of them.
    """
    rows = counters.select("*", _orders())
    fails, earlier = F.expr("mask & bit <> 0"), F.expr("mask & before <> 0")
    gone, k = fails & ~earlier, F.bit_count("mask")

    def total(condition: Column, times: Column | int = 1) -> Column:
        return F.sum(F.when(condition, F.col("n") * times).otherwise(0)).cast("long")

    return rows.groupBy("part", "filter_order", F.col("step").cast("int").alias("step")).agg(
        total(~fails & ~earlier).alias("kept"),
        total(gone).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(fails & (k == 1)).alias("unique_fails"),
        total(gone & (F.col("good") == 1)).alias("good_lost"),
        total(gone & (F.col("toxic") == 1)).alias("toxic_lost"),
        F.sum(F.when(fails, F.expr("n * (120 div bit_count(mask))")).otherwise(0)).cast("long").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, rounds: int = 4, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The report over all parquet files of ``path`` (a folder or one file), read in about ``rounds`` micro-batches.

    Null texts and parts count as empty ones. A row without an id is nobody's copy and has no labels;
    rows that share the least id of a text are no copies of each other. Repeated rows all count.
    An empty table gives no rows, as it has no parts. Columns beside the three named are not read.
    """
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    kept = Audit(spark, new_folder(spark, "filter-audit"), table.schema, key, text, part)
    # A pattern that fits this path alone: a stream takes one file only by pattern.
    head, last = path.rstrip("/").rsplit("/", 1)
    kept.drain(f"{head}/{last[:-1]}[{last[-1]}]", labels, max(1, -(-files // rounds)))
    return report(kept.counters())


_BIT = {name: 1 << i for i, name in enumerate(FILTERS)}


def _oracle() -> str:
    orders = ", ".join(f"('{''.join(o)}')" for o in permutations(FILTERS))
    bits = reduce(lambda rest, name: f"case f when '{name}' then {_BIT[name]} else {rest} end", FILTERS, "0")
    return f"""
with judged as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
        [w for w in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if w <> ''] as words
    from documents),
masks as (
    select doc_id, part,
        (len(words) < 200)::int * 1 + (100 * len(list_distinct(words)) < 50 * len(words))::int * 2
        + (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int * 4
        + regexp_matches(t, '[#$%&*|]')::int * 8
        + (doc_id is not null and doc_id > min(doc_id) over (partition by t))::int * 16 as mask
    from judged),
marks as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
cells as (
    select part, coalesce(mask, 0) as mask, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
    from masks left join marks using (doc_id) group by all),
steps as (
    select filter_order, step::int as step, substr(filter_order, step::int, 1) as f, substr(filter_order, 1, step::int - 1) as earlier
    from (values {orders}) as o(filter_order), range(1, 6) as s(step)),
bits as (
    select filter_order, step, {bits} as bit,
        list_sum([case when contains(earlier, f) then {bits} else 0 end for f in [{', '.join(f"'{c}'" for c in FILTERS)}]])::int as before
    from steps)
select part, filter_order, step,
    sum(case when mask & (bit | before) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
    sum(case when mask & bit <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when good and mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as good_lost,
    sum(case when toxic and mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as toxic_lost,
    sum(case when mask & bit <> 0 then n * (120 // bit_count(mask)) else 0 end)::bigint as shapley
from cells, bits group by part, filter_order, step
"""


ORACLE = _oracle()
