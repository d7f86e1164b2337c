"""Full-view snapshots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from strandline.functions.names import snapshot_name_patterns
from strandline.plans.store import Store
from strandline.sinks.writers import copy_by_type

COLUMNS = ("entity_type", "entity_id", "version", "content", "project_id", "file_id", "descriptor", "row_id")


def valid_snapshot_name(name: str, atlases: Sequence[str]) -> bool:
    return any(re.search(pattern, name) for pattern in snapshot_name_patterns(atlases))


def create_snapshot(store: Store, target: str, name: str, atlases: Sequence[str] | None = None) -> DataFrame:
    """Write all live rows to ``{target}/{name}``; with ``atlases`` the name must be a valid snapshot name."""
    if atlases is not None and not valid_snapshot_name(name, atlases):
        raise ValueError(f"snapshot name {name} is invalid")
    path = f"{target}/{name}"
    copy_by_type(store.live(), path, COLUMNS)
    return store.spark.read.parquet(path)
