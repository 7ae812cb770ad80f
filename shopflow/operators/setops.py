"""Set and check operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_keys(source: DataFrame, sink: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """``SELECT key FROM source MINUS SELECT key FROM sink`` (distinct).

    Spark plans EXCEPT DISTINCT as a left-anti join after a distinct, so both
    sides shuffle only the key columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return source.select(*keys).subtract(sink.select(*keys))


def duplicate_keys(df: DataFrame, key: Sequence[str] | str, count_name: str = "count") -> DataFrame:
    """Keys that occur more than once, with their row count (``HAVING count > 1``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Point lookup; on parquet the predicate reaches the scan (row-group skipping)."""
    return df.filter(F.col(column) == F.lit(value))
