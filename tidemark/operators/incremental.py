"""Watermark-driven loading and keyed upsert into partitioned parquet tables."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import COMPACT, spread, stage

# Fixed value: the watermark of an empty target.
EPOCH = "1900-01-01 00:00:00"
# A task that writes up to so many ranges keeps a file of each open; rows of more ranges are gathered by a shuffle.
MOST_OPEN = 100


def newer_than(source: DataFrame, target: DataFrame, stamp: str = "loaded_at") -> DataFrame:
    """Source rows strictly later than the latest row of the target.

    The watermark is a scalar subquery, so it reads one column of the target and
    reaches the source scan as a filter. Rows that arrive later with an equal or
    older stamp are left out until a full refresh.
    """
    watermark = target.agg(F.coalesce(F.max(stamp), F.lit(EPOCH).cast("timestamp_ntz")).alias("w"))
    return source.where(F.col(stamp) > watermark.scalar())


def latest_per_key(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """One row per key, the one with the greatest stamp.

    A NULL stamp is the smallest; of equal stamps the greater row counts. The choice
    depends on the rows alone, so batches may be cut in any way.
    """
    rest = [c for c in df.columns if c not in (key, stamp)]
    newest = df.groupBy(key).agg(F.max(F.struct(stamp, *rest)).alias("_row"))
    return newest.select(key, "_row.*").select(*df.columns)


class ConcurrentWrite(RuntimeError):
    """Another writer has committed first; the table is as that writer left it."""


@dataclass(frozen=True)
class KeyedTable:
    """A parquet table with one row per ``key``, kept in ranges of the key.

    An upsert finds every old version of an updated row in the ranges of the updates
    and rewrites only those; with keys in the order of loading, that is the tail. The
    first load, later batches and streams follow one rule: the greatest stamp wins.

    Each write is a folder ``_version=n/_writer=id`` with the ranges it holds, and a file
    ``_manifest/n`` that names the folder of every range of the whole table. A reader takes
    the last manifest and lists no versions. The manifest is moved into place and never
    replaced, so of two writers that began at the same version one commits, and the other
    raises ``ConcurrentWrite`` and may start again. A write that dies is never seen.
    A range has one folder at any time, so reads stay as fast after many upserts; ``expire``
    deletes folders that no kept manifest names.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    key_range: int

    @staticmethod
    def sized(
        path: str, keys: DataFrame, schema: T.StructType, key: str, rows_per_partition: int = 20_000_000
    ) -> KeyedTable:
        """A table whose ranges hold about ``rows_per_partition`` of keys like these.

        A range is never narrower than that many keys, so a table that begins small
        and grows has no more ranges than its keys need.
        """
        span = keys.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("n")).first()
        partitions = max(1, -(-span["n"] // rows_per_partition))
        key_range = -(-((span["hi"] or 0) - (span["lo"] or 0) + 1) // partitions)
        return KeyedTable(keys.sparkSession, path, schema, key, max(rows_per_partition, key_range))

    @staticmethod
    def stored(spark: SparkSession, path: str, schema: T.StructType, key: str) -> KeyedTable:
        """A table written before, with the ranges it was written with."""
        table = KeyedTable(spark, path, schema, key, 1)
        return replace(table, key_range=table._manifest()["width"] or 1)

    def _keyed(self, df: DataFrame) -> DataFrame:
        width = f"{self.key_range}L"
        return df.selectExpr("*", f"{width} as _range", f"{self.key} div {width} as _part")

    def _path(self, name: str):
        """A Hadoop path below the table."""
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifests(self) -> list[int]:
        """The numbers of the committed versions that have not expired."""
        fs, folder = self._fs(), self._path("_manifest")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, version: int | None = None) -> dict:
        """A manifest, by default the last one: its number, the width of ranges, and the folder of each range."""
        known = self.manifests()
        if not known:
            return {"version": 0, "width": 0, "folders": {}}
        stream = self._fs().open(self._path(f"_manifest/{version or known[-1]}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return found | {"folders": {int(part): folder for part, folder in found["folders"].items()}}

    def _commit(self, version: int, folders: dict[int, str]) -> None:
        """Make a version the last one, unless another writer has taken its number."""
        jvm, fs = self.spark._jvm, self._fs()
        draft = self._path(f"_manifest/draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({"version": version, "width": self.key_range, "folders": folders}).encode()))
        finally:
            out.close()
        draft = fs.makeQualified(draft)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, fs.makeQualified(self._path(f"_manifest/{version}")), no_options)
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            raise ConcurrentWrite(f"version {version} of {self.path} was written by someone else") from e

    def _folders(self) -> dict[int, str]:
        """For each range the folder that holds it now."""
        return {part: f"{self.path}/{folder}" for part, folder in self._manifest()["folders"].items()}

    def _read(self, folders: list[str]) -> DataFrame:
        fields = [*self.schema.fields, T.StructField("_range", T.LongType()), T.StructField("_part", T.LongType())]
        schema = T.StructType(fields)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(*schema.names)

    def exists(self) -> bool:
        return bool(self.manifests())

    def read(self, version: int | None = None) -> DataFrame:
        """The table now, or as an earlier version that has not expired left it."""
        folders = self._manifest(version)["folders"].values()
        return self._read([f"{self.path}/{folder}" for folder in folders]).drop("_range", "_part")

    def _put(self, df: DataFrame, version: int) -> tuple[str, dict[int, str]]:
        """Write rows below a folder of their own, and name the folder of each range; nobody reads them before a commit."""
        folder, conf = f"_version={version}/_writer={uuid.uuid4().hex[:12]}", df.sparkSession.conf
        setting = "spark.sql.maxConcurrentOutputFileWriters"
        before = conf.get(setting)
        conf.set(setting, str(MOST_OPEN))  # else each task sorts its rows by range
        try:
            df.write.options(**COMPACT).partitionBy("_range", "_part").parquet(f"{self.path}/{folder}")
        finally:
            conf.set(setting, before)
        found = self._fs().globStatus(self._path(f"{folder}/_range=*/_part=*")) or []
        parts = [f.getPath() for f in found]
        return folder, {int(p.getName()[6:]): f"{folder}/{p.getParent().getName()}/{p.getName()}" for p in parts}

    def _write(self, df: DataFrame, begun: dict, whole: bool) -> None:
        """Write a version after ``begun``, the manifest that its rows were derived from."""
        version = begun["version"] + 1
        _, written = self._put(df, version)
        self._commit(version, written if whole else begun["folders"] | written)

    def _repeats(self, df: DataFrame) -> bool:
        """Whether some key has several rows. Only the keys are shuffled, and before they are counted, as few combine."""
        keys = spread(df.select(self.key), self.key).groupBy(self.key).agg(F.count(F.lit(1)).alias("_n"))
        return keys.where(F.col("_n") > 1).count() > 0

    def _settled(self, df: DataFrame, stamp: str) -> DataFrame:
        """One row per key. Rebalance gathers a range's rows into few files and splits a large range over tasks."""
        return self._keyed(latest_per_key(df, self.key, stamp)).hint("rebalance", "_part")

    def _replace(self, rows: DataFrame, begun: dict, stamp: str) -> None:
        """Write the whole table where its rows are; they are shuffled only if keys repeat or ranges are many."""
        version = begun["version"] + 1
        folder, written = self._put(self._keyed(rows), version)
        found = self._read([f"{self.path}/{f}" for f in written.values()])
        if len(written) > MOST_OPEN or self._repeats(found):
            first = folder
            _, written = self._put(self._settled(found.drop("_range", "_part"), stamp), version)
            self._fs().delete(self._path(first), True)
        self._commit(version, written)

    def expire(self, keep: int = 1) -> int:
        """Delete what only versions before the last ``keep`` need, and return how many range folders went.

        Readers of a version that goes must have ended. Folders of writers that died go too; one
        that is being written has a number above all manifests and stays.
        """
        known, fs = self.manifests(), self._fs()
        if not known:
            return 0
        needed = {f for v in known[-max(1, keep) :] for f in self._manifest(v)["folders"].values()}
        for v in known[: -max(1, keep)]:
            fs.delete(self._path(f"_manifest/{v}"), False)
        gone = 0
        for writer in fs.globStatus(self._path("_version=*/_writer=*")) or []:
            writer = writer.getPath()
            if int(writer.getParent().getName()[len("_version=") :]) > known[-1]:
                continue
            name = f"{writer.getParent().getName()}/{writer.getName()}"
            parts = [f.getPath() for f in fs.globStatus(self._path(f"{name}/_range=*/_part=*")) or []]
            old = [p for p in parts if f"{name}/{p.getParent().getName()}/{p.getName()}" not in needed]
            gone += len(old)
            for p in [writer] if len(old) == len(parts) else old:
                fs.delete(p, True)
        return gone

    def refresh(self, rows: DataFrame, stamp: str = "loaded_at") -> None:
        """Replace the whole table."""
        self._replace(rows, self._manifest(), stamp)

    def upsert(self, updates: DataFrame, stamp: str = "loaded_at") -> None:
        """Insert new keys and replace the rows of known ones by newer versions.

        Only the ranges of the updates are read and written. The driver learns their
        numbers, of which there are no more than folders that the manifest names anyway.
        Rows move between tasks only if keys repeat, in the updates or in the ranges they touch.
        """
        begun = self._manifest()
        if not begun["version"]:
            self._replace(updates, begun, stamp)
            return
        updates = stage(self._keyed(updates), "updates", **COMPACT)
        touched = {row["_part"] for row in updates.select("_part").distinct().toLocalIterator()}
        if not touched:
            return
        old = self._read([f"{self.path}/{folder}" for part, folder in begun["folders"].items() if part in touched])
        rows = old.unionByName(updates).drop("_range", "_part")
        settle = len(touched) > MOST_OPEN or self._repeats(rows)
        self._write(self._settled(rows, stamp) if settle else self._keyed(rows), begun, whole=False)
