"""Pages as WARC archives with revisit records, read back into a globally ordered capture index.

Spark writes the archives as text whose line end is the blank line that closes a WARC record, so
writing is distributed, transactional and works on any file system Spark knows. Reading parses every
archive in one pass and sorts its entries into a local run; the runs are dealt out by ranges of
(URL key, date, id) and merged there by a loser tree.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_folder

CLOSE = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
ENTRY = (
    "url_key string, warc_date string, id string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to string, file string, offset long, record_bytes long"
)


def _records(pages: DataFrame, least: int) -> DataFrame:
    """(value): one WARC record per row, without the blank line that closes it."""
    body = F.encode("html", "utf-8")
    rows = pages.withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumns({"n": F.octet_length("html"), "digest": F.sha2(body, 256)})
    # Only payloads that occur again need a decision; a hot payload is one row here.
    again = rows.where(F.col("n") >= least).groupBy(F.col("digest").alias("again")).agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("times")
    )
    again = again.where("times > 1").select("again", "first")
    rows = rows.join(again, F.col("digest") == F.col("again"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(CLOSE)
    )

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    def optional(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), line(name, value)).otherwise("")

    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "")
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    head = F.concat(
        F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        optional("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">"))),
        line("WARC-Date", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")), optional("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("X-Payload-Length", F.col("n").cast("string")),
        F.when(
            revisit,
            F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", size.cast("string")), F.lit(CLOSE),
    )
    return rows.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def write(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", at: Column | None = None,
    least: int = 100, records_per_file: int = 20_000,
) -> None:
    """Write one WARC record per row below ``path``, as gzip archives.

    Of rows with equal payloads of at least ``least`` bytes that with the smallest key is
    the response and the others revisit it; rows that repeat that key too are responses.
    Null keys come last and write no record id, null URLs no target, null payloads are empty.
    Control characters and blanks are left out of URLs. ``at`` is the capture time, a
    second of 1 January 2020 by the key if absent. Other columns are ignored.
    """
    second = F.coalesce(F.pmod(F.col(key).cast("long"), F.lit(86_400)), F.lit(0))
    day = F.timestamp_seconds(F.lit(1_577_836_800) + second)
    rows = pages.select(
        F.col(key).alias("id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"),
        F.coalesce(day if at is None else at, day).alias("at"),
    )
    writer = _records(rows, least).write.option("lineSep", CLOSE).option("maxRecordsPerFile", records_per_file)
    writer.option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Host labels from the last to the first, ``)``, path and query; empty without ``://``."""
    _, mark, rest = url.partition("://")
    if not mark:
        return ""
    rest = rest.partition("#")[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def parse(chunks: Iterable[bytes]) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an unpacked archive given piece by piece."""
    source, buffer, offset = iter(chunks), bytearray(), 0
    close = CLOSE.encode()

    def fill() -> bool:
        piece = next(source, None)
        buffer.extend(piece or b"")
        return piece is not None

    while True:
        seen = 0
        while (end := buffer.find(close, seen)) < 0:
            seen = max(0, len(buffer) - 3)
            if not fill():
                if buffer:
                    raise ValueError(f"record without an end at {offset}")
                return
        lines = buffer[:end].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        total = end + 8 + int(headers["Content-Length"])
        while len(buffer) < total:
            if not fill():
                raise ValueError(f"record cut short at {offset}")
        yield offset, total, headers, bytes(buffer[end + 4 : total - 4])
        del buffer[:total]
        offset += total


def unpacked(content: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file's content in pieces: of all its members, as most archives have one for each record."""
    rest = content
    while rest:
        state = zlib.decompressobj(31)
        while not state.eof:
            if not rest:
                raise ValueError("archive cut short")
            yield state.decompress(rest, size)
            rest = state.unconsumed_tail
            if not rest and not state.eof:
                yield state.flush()
        rest = state.unused_data.lstrip(b"\0")


def _run(file: str, content: bytes) -> list[tuple]:
    """The archive's entries, a run sorted by (URL key, date, id)."""
    out = []
    for offset, total, headers, block in parse(unpacked(content)):
        payload = block.partition(CLOSE.encode())[2]
        digest = headers["WARC-Payload-Digest"].partition(":")[2]
        response = headers["WARC-Type"] == "response"
        if response and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(headers["X-Payload-Length"])):
            raise ValueError(f"{file}: payload at {offset} does not match its digest")
        bare = lambda name: headers[name][10:-1] if name in headers else None
        key = url_key(headers.get("WARC-Target-URI", ""))
        out.append(
            (key, headers["WARC-Date"], bare("WARC-Record-ID"), int(headers["X-Payload-Length"]), digest, headers["WARC-Type"],
             bare("WARC-Refers-To"), file, offset, total)
        )
    return sorted(out, key=order)


def order(entry: tuple) -> tuple:
    """URL key, date, id; a missing id first."""
    return entry[0], entry[1], entry[2] or ""


class LoserTree:
    """Merges k sorted runs; each entry costs one path of log2(k) comparisons."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k  # losers[0] is the winner; a place not yet played is -1
        for run in range(len(runs)):
            self._play(run)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; ended runs come last, ties go to the smaller run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None if (x is None) != (y is None) else a < b
        return (order(x), a) < (order(y), b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = run
                return
            if self._before(self.losers[node], run):
                run, self.losers[node] = self.losers[node], run
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.losers[0] >= 0 and (entry := self.heads[run := self.losers[0]]) is not None:
            yield entry
            self.heads[run] = next(self.runs[run], None)
            self._play(run)


def _batches(entries: Iterable[tuple], names: list[str], kinds: list[pa.DataType], size: int = 5_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for entry in entries:
        held.append(entry)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The capture index of all archives below ``path``, in order of (URL key, date, id) over all partitions.

    Every payload is unpacked and held against its digest. One archive's entries and one
    range's entries fit a task; archives are unpacked piece by piece.
    """
    names = [f.split()[0] for f in ENTRY.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in ENTRY.split(", ")]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                yield from _batches(_run(file.as_py(), content.as_py()), names, kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*[c.to_pylist() for c in batch.columns]):
                slices.setdefault(entry[7], []).append(entry)
        # Slices come as the run was sorted; sorting again costs one look unless a fetch was repeated.
        sorted_slices = [sorted(slices[file], key=order) for file in sorted(slices)]
        yield from _batches(LoserTree(sorted_slices), names, kinds)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    local = files.mapInArrow(runs, ENTRY)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return local.repartitionByRange(parts, "url_key", "warc_date", F.coalesce("id", F.lit(""))).mapInArrow(merge, ENTRY)


def round_trip(pages: DataFrame, path: str | None = None, key: str = "page_id", **how) -> DataFrame:
    """Write the pages as archives and read the ordered index back: (key, payload_bytes, payload_digest, ...)."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    write(pages, path, key, **how)
    kind = pages.schema[key].dataType
    return read_index(spark, path).select(
        F.col("id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "url_key", "warc_date",
    )


ORACLE = r"""
with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as digest,
        case when contains(url, '://') then regexp_replace(split_part(substr(url, strpos(url, '://') + 3), '#', 1), '[\x00-\x20\x7f]', '', 'g') end as rest
    from pages
), firsts as (
    select digest, min(page_id) as first from p where n >= 100 group by digest
)
select page_id, n as payload_bytes, p.digest as payload_digest,
    case when first <> page_id then 'revisit' else 'response' end as record_type,
    case when first <> page_id then first end as refers_to,
    coalesce(array_to_string(list_reverse(string_split(lower(regexp_extract(rest, '^[^/?]*')), '.')), ',') || ')'
        || regexp_replace(rest, '^[^/?]*', ''), '') as url_key,
    strftime(make_timestamp(1577836800000000) + to_seconds(page_id % 86400), '%Y-%m-%dT%H:%M:%SZ') as warc_date
from p left join firsts on p.digest = firsts.digest and n >= 100
"""
