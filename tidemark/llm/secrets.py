"""Secret scan: patterns, and weak parts reported only where complementary parts stand close by.

A credential has parts: an access identifier, a secret, an endpoint. Strong kinds are reported
wherever they match. Weak kinds (a user name, a bare 40-character key, an endpoint) are common in
harmless text, so they are reported only when an interval join finds their complement within
``scope`` characters of the same text. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.clashes import set_aside
from tidemark.session import stage

# Fixed values: (kind, pattern, group whose length counts, least length). Listed order breaks ties of start.
STRONG = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    ("user", r"""(?i:(?:user|username|login|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 1, 3),
    ("key40", r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", 0, 40),
    ("endpoint", r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", 0, 7),
)
KINDS = {kind: place for place, (kind, *_) in enumerate(STRONG + WEAK)}
# The role of each kind, and which roles must stand near a weak kind.
ROLES = {"access": "access", "user": "access", "assign": "secret", "hex": "secret", "key40": "secret", "endpoint": "endpoint"}
NEEDS = {"user": ("secret",), "key40": ("access",), "endpoint": ("access", "secret")}
SPAN = "array<struct<start:int,place:int,end:int>>"


def spans_of(text: Column, place: int, pattern: str, group: int, least: int) -> Column:
    """Matches as structs (start, place, end) in code points, end exclusive; null where there are none.

    The pieces between the matches and the matches themselves, measured one after
    the other, give the positions. The text is split only where the pattern occurs.
    """
    regex = F.lit(pattern)
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all(text, regex, F.lit(0)), lambda x: F.length(x)).alias("hit"),
        F.transform(F.regexp_extract_all(text, regex, F.lit(group)), lambda x: F.length(x)).alias("size"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["hit"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            F.when(x["size"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    return F.when(F.regexp_like(text, regex), F.aggregate(parts, zero, step, lambda acc: acc["out"]))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span in order, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """Weak spans that have their complements within ``scope``: (text key, spans).

    Blocks of ``scope`` characters turn the interval condition into an equality: a
    weak part stands in every block that it touches, a complement in every block that
    it reaches with ``scope`` characters on either side. Semi joins keep at most one
    row per weak part and block, however many complements stand around it.
    """
    def over(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / scope), F.floor(end / scope)))

    parts = found.select("_key", F.explode(F.concat("_strong", "_weak")).alias("s")).select("_key", "s.*")
    parts = parts.distinct()  # equal texts have equal parts
    role = F.create_map(*[F.lit(x) for kind, r in ROLES.items() for x in (KINDS[kind], r)])
    parts = parts.withColumn("_role", role[F.col("place")])
    out = []
    for kind, needs in NEEDS.items():
        weak = parts.where(F.col("place") == KINDS[kind])
        for place, need in enumerate(needs):
            if place:
                weak = weak.drop("_block").distinct()  # the complements may stand in different blocks
            near = parts.where(F.col("_role") == need).select(
                F.col("_key").alias("k"), F.col("start").alias("a"), F.col("end").alias("b"),
                over(F.col("start") - scope, F.col("end") + scope).alias("n"),
            )
            within = (F.col("a") <= F.col("end") + scope) & (F.col("b") + scope >= F.col("start"))
            at = (F.col("_key") == F.col("k")) & (F.col("_block") == F.col("n"))
            weak = weak.withColumn("_block", over(F.col("start"), F.col("end"))).join(near, at & within, "left_semi")
        out.append(weak.select("_key", F.struct("start", "place", "end").alias("s")))
    return reduce(DataFrame.unionByName, out).groupBy("_key").agg(F.collect_set("s").alias("_more"))


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with the matches of its whole text: ``_strong``, ``_weak``, and ``_key`` to link them by."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def all_of(kinds: tuple) -> Column:
        some = [F.coalesce(spans_of(whole, KINDS[k], *rest), F.array().cast(SPAN)) for k, *rest in kinds]
        return F.concat(*some)

    found = docs.withColumns({"_strong": all_of(STRONG), "_weak": all_of(WEAK)})
    # A weak part alone needs no search: such rows get keys of their own, that nothing matches and no task gathers.
    several = (F.size("_weak") > 0) & (F.size("_strong") + F.size("_weak") > 1)
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    return found.withColumn("_key", F.when(several, F.md5(whole)).otherwise(alone))


def with_links(found: DataFrame, scope: int = 200) -> DataFrame:
    """Rows of ``matches`` with ``_base`` and ``_spans``: arrays of (start, place, end), strong ones and all.

    ``text`` null or empty has no spans. Rows are neither merged nor dropped, whatever
    their other columns hold; equal texts share one search for complements. A very
    long text is scanned as a whole. Column names starting with ``_`` are the scan's own.
    """
    some = stage(found.where(~F.startswith("_key", F.lit("-"))).select("_key", "_strong", "_weak"), "secret-parts")
    more = F.coalesce("_more", F.array().cast(SPAN))
    return (
        found.join(_linked(some, scope), "_key", "left")
        .withColumn("_base", F.col("_strong"))
        .withColumn("_spans", F.array_sort(F.concat("_strong", more)))
        .drop("_key", "_more", "_strong", "_weak")
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = 200) -> DataFrame:
    """Counts and positions per row: (key, n_assign, n_access, n_hex, base_sha256, spans)."""
    found = matches(docs.select(F.col(key).alias("_id"), F.col(text).alias("text")))
    found = with_links(stage(found.drop("text"), "secret-matches"), scope)

    def count_of(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["place"] == KINDS[kind])).cast("long").alias(f"n_{kind}")

    counts = [count_of(kind) for kind, *_ in STRONG]
    return found.select(
        F.col("_id").alias(key), *counts, F.sha2(F.encode(written(F.col("_base")), "utf-8"), 256).alias("base_sha256"),
        written(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", scope: int = 200) -> DataFrame:
    """The rows with every span of their text replaced by ``mark``; touching and overlapping spans become one.

    Columns of any name pass through unchanged.
    """
    return set_aside(docs, lambda rows: _redacted(rows, text, mark, scope), text)


def _redacted(docs: DataFrame, text: str, mark: str, scope: int) -> DataFrame:
    found = with_links(matches(docs, text), scope)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] > acc["at"]
        first = (acc["at"] == 0) & (s["start"] == 0)
        gap = F.col(text).substr(acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).when(first, F.lit(mark)).otherwise(acc["out"]).alias("out"),
        )

    tail = lambda acc: F.concat(acc["out"], F.col(text).substr(acc["at"] + 1, F.length(text)))
    cleaned = F.when(F.size("_spans") == 0, F.col(text)).otherwise(F.aggregate("_spans", zero, step, tail))
    return found.withColumn(text, cleaned).select(*docs.columns)
