"""Ranking operators: top-n per group, transposed into columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_columns(
    df: DataFrame,
    group: str,
    item: str,
    order: Sequence[Column],
    names: Sequence[str],
) -> DataFrame:
    """For each ``group``, the items ranked 1..n by ``order``, as columns ``names``.

    ``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order)`` then
    ``PIVOT (min(item) FOR rank IN (1, 2, ...))``.  ``order`` must be total
    (add the item as the last key) so equal scores rank the same way every run.
    A group with fewer items gets NULL in the later columns.

    ``df`` is expected to be aggregated to one row per (group, item): each window
    partition then holds one group's distinct items, which is bounded by the
    catalogue, not by the data volume.  The ``rank <= n`` filter lets Spark
    apply a window group limit before the shuffle.
    """
    n = len(names)
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.select(group, item, F.row_number().over(w).alias("_rank")).filter(F.col("_rank") <= n)
    wide = ranked.groupBy(group).pivot("_rank", list(range(1, n + 1))).agg(F.min(item))
    return wide.select(group, *[F.col(str(i + 1)).alias(name) for i, name in enumerate(names)])
