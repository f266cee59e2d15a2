"""Where a model is stored: the target schema and its full name."""

from __future__ import annotations

# The schema of each group of models.
DOMAINS = {"staging": "STAGING", "core": "CORE", "hr": "HR", "marketing": "MARKETING", "inventory": "INVENTORY"}
SNAPSHOT_SCHEMA = "SNAPSHOTS"


def target_schema(default: str, custom: str | None = None) -> str:
    """The default schema, or the default and the trimmed custom name joined."""
    return default if custom is None else f"{default}_{custom.strip()}"
