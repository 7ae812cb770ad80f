"""Projection helpers: collision-safe renames and generated column lists."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: columns that every bronze table may carry and that get a table prefix (fixed values)
SHARED_COLUMNS = ("id", "arrive_dt", "ts")


def prefixed_columns(
    alias: str,
    columns: Iterable[str],
    prefix: str,
    exclude: Iterable[str] = (),
    renamed: Sequence[str] = SHARED_COLUMNS,
) -> list[Column]:
    """Select list for one side of a star join.

    Every column of ``alias`` except ``exclude``; the ``renamed`` ones get the
    name ``{prefix}_{column}`` so that several tables can be joined without two
    output columns sharing a name.
    """
    skip = set(exclude)
    return [
        F.col(f"{alias}.{c}").alias(f"{prefix}_{c}" if c in renamed else c)
        for c in columns
        if c not in skip
    ]


def collisions(*name_lists: Iterable[str]) -> list[str]:
    """Names that occur in more than one of the given column lists.

    Checks every pair of lists (the reference intersected one list with itself
    and skipped the orders table), and also repeats inside a single list.
    """
    counts: Counter[str] = Counter()
    for names in name_lists:
        counts.update(names)
    return sorted(n for n, k in counts.items() if k > 1)


def payload_columns(columns: Iterable[str], exclude: Iterable[str] = ("ts", "arrive_dt")) -> list[str]:
    """Every column but the time stamps: the identity of a message payload."""
    skip = set(exclude)
    return [c for c in columns if c not in skip]


def table_columns(spark, table: str) -> dict[str, str]:
    """Catalog introspection: column name -> type name, in table order."""
    return {c.name: c.dataType for c in spark.catalog.listColumns(table)}
