"""Content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def row_key(*cols: Column) -> Column:
    """A key that stays the same when a task is retried, unlike a random id."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)
