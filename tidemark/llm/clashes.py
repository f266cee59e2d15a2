"""Steps that add columns of their own to tables whose columns may have any name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def set_aside(docs: DataFrame, step: Callable[[DataFrame], DataFrame], *used: str) -> DataFrame:
    """``step`` on ``docs``, whose columns that start with ``_`` bear other names meanwhile: those of the step cannot clash."""
    mine = [c for c in docs.columns if c.startswith("_") and c not in used]
    if not mine:
        return step(docs)
    longer = "x" * (1 + max(map(len, docs.columns)))  # than any name there is
    names = [f"{longer}{i}" for i in range(len(mine))]
    return step(docs.withColumnsRenamed(dict(zip(mine, names)))).withColumnsRenamed(dict(zip(names, mine)))
