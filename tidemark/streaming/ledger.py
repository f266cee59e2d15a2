"""The incremental fact as a stream: new files in, keyed upsert out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.operators.incremental import KeyedTable


def drain_into(
    table: KeyedTable,
    landing: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> None:
    """Upsert every parquet file that landed since the last call, then stop.

    A long backlog is worked off in batches of ``files_per_batch`` files.

    The checkpoint takes the place of the watermark: it remembers the files read,
    so rows that arrive late are loaded too. A batch repeated after a failure
    replaces its own rows.
    """

    def load(batch: DataFrame, _: int) -> None:
        table.upsert(transform(batch))

    (
        table.spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
