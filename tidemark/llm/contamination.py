"""Benchmark passages in documents: size-partitioned MinHash search, then exact shingle containment.

DataFrame functions only. A document's shingle hashes fall into bins, the more the larger its size
class, and the least hash of each bin forms its signature. A passage's shingle meets a document where
both have it as the least of the same bin. Scaling the bins with the size keeps the chance of a miss
the same for short and very long documents; it follows from ``miss`` and the shortest passage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.clashes import set_aside

WIDTH = 5
# Signatures of passages are broadcast up to this many rows of some 40 bytes; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(words: Column) -> Column:
    """``WIDTH`` words in a row, joined by blanks; fewer words make one shingle, none make none."""
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - (WIDTH - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, WIDTH), " "))


def _hashes(df: DataFrame) -> DataFrame:
    """Adds ``_h``, the distinct shingle hashes of ``text`` in order, for rows that have any."""
    df = df.withColumn("_w", words(F.col("text"))).where(F.size("_w") > 0)
    hashed = F.transform(shingles(F.col("_w")), lambda s: F.xxhash64(s))
    return df.withColumn("_h", F.array_sort(F.array_distinct(hashed))).drop("_w")


def extra_bits(least_shingles: int, threshold: float, miss: float) -> int:
    """How far bins must outnumber shingles, as a power of two.

    A passage that is contained shares s shingles; all of them are hidden by smaller
    hashes of their bins with a chance of about (load / 2) ** s on either side.
    """
    shared = max(1, math.ceil(threshold * least_shingles))
    return max(0, math.ceil(-math.log2(miss ** (1 / shared))))


def _signatures(hashed: DataFrame, extra: int) -> DataFrame:
    """One row per bin of each document: (id, bits, h)."""
    size_class = F.ceil(F.log2(F.size("_h").cast("double"))).cast("int")
    rows = hashed.withColumn("_bits", F.least(size_class + extra, F.lit(62)))

    def first_of_bin(h: Column, i: Column) -> Column:
        before = F.get("_h", i - 1)
        shift = 64 - F.col("_bits")
        return (i == 0) | (F.call_function("shiftright", h, shift) != F.call_function("shiftright", before, shift))

    least = F.when(F.col("_bits") == 0, F.slice("_h", 1, 1)).otherwise(F.filter("_h", first_of_bin))
    return rows.select("id", "_bits", F.explode(least).alias("h"))


def _passage_signatures(hashed: DataFrame) -> DataFrame:
    """(item, h, least_bits): from so many bits on, the hash is the least of its bin in the passage."""
    pairs = F.transform("_h", lambda h, i: F.struct(h.alias("h"), F.get("_h", i - 1).alias("before")))
    rows = hashed.select("item", F.inline(pairs))
    same = F.length(F.bin(F.col("h").bitwiseXOR(F.col("before"))))
    return rows.select("item", "h", F.coalesce(65 - same, F.lit(0)).alias("least_bits"))


def contained(
    docs: DataFrame, passages: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", threshold: float = 0.8, miss: float = 1e-9,
) -> DataFrame:
    """Pairs (key, item, shared, n_shingles, containment) of at least ``threshold``.

    Containment is the share of the passage's distinct shingles that the document
    has. Texts null or without words match nothing. Of rows that repeat a key, null
    included, the greatest containment counts; passages that repeat an item alike.
    Equal passages under several items each get their pairs. Other columns are ignored.
    """
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    items = _hashes(passages.select(F.col(item).alias("item"), F.col(item_text).alias("text")))
    n, least = items.agg(F.coalesce(F.sum(F.size("_h")), F.lit(0)), F.min(F.size("_h"))).first()
    signed = _signatures(_hashes(texts), extra_bits(least or 1, threshold, miss))
    wanted = _passage_signatures(items)
    wanted = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted
    meet = signed.join(wanted, "h").where(F.col("_bits") >= F.col("least_bits"))
    candidates = meet.select(F.col("id").alias("c_id"), F.col("item").alias("c_item")).distinct()

    whole = items.select(
        F.col("item"), F.array_distinct(shingles(words(F.col("text")))).alias("_wanted")
    )
    asked = candidates.join(whole, F.col("c_item").eqNullSafe(F.col("item"))).drop("c_item")
    asked = asked.groupBy("c_id").agg(F.collect_list(F.struct("item", "_wanted")).alias("_asked"))
    found = texts.join(asked, F.col("id").eqNullSafe(F.col("c_id"))).withColumn("_w", words(F.col("text")))
    found = found.withColumn("_s", F.array_distinct(shingles(F.col("_w"))))
    shared = F.transform(
        "_asked",
        lambda a: F.struct(
            a["item"].alias("item"), F.size(F.array_intersect(a["_wanted"], F.col("_s"))).cast("long").alias("shared"),
            F.size(a["_wanted"]).cast("long").alias("n_shingles"),
        ),
    )
    pairs = found.select("id", F.inline(shared)).withColumn("containment", F.col("shared") / F.col("n_shingles"))
    best = pairs.where(F.col("containment") >= threshold).groupBy("id", "item").agg(
        F.max(F.struct("containment", "shared", "n_shingles")).alias("_best")
    )
    return best.select(
        F.col("id").alias(key), F.col("item").alias(item), "_best.shared", "_best.n_shingles", "_best.containment"
    )


def decontaminate(docs: DataFrame, passages: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents that contain no passage; rows of a key with a match go together."""
    hits = contained(docs, passages, key, text, **how).select(F.col(key).alias("_hit")).distinct()
    return set_aside(docs, lambda rows: rows.join(hits, F.col(key).eqNullSafe(F.col("_hit")), "left_anti"), key)


ORACLE = r"""
with texts as (
    select 0 as kind, doc_id as id, text from documents union all select 1, item_id, text from benchmark
), worded as (
    select kind, id, [x for x in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if x <> ''] as w from texts
), grams as (
    select distinct kind, id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)]) as s
    from worded where len(w) > 0
), sizes as (
    select id, count(*) as n from grams where kind = 1 group by id
)
select d.id as doc_id, i.id as item_id, count(*) as shared, any_value(n) as n_shingles, count(*) / any_value(n)::double as containment
from grams d join grams i on d.s = i.s and d.kind = 0 and i.kind = 1 join sizes on sizes.id = i.id
group by d.id, i.id having count(*) / any_value(n)::double >= 0.8
"""
