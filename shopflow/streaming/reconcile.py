"""Stream against sink: which keys have come on a stream and are not yet in its sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from shopflow.sources import versions
from shopflow.streaming.sinks import read_current, start_batches


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys; as in MINUS a NULL equals a NULL."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def watch_missing(rows: DataFrame, sink: Callable[[SparkSession], DataFrame], key: Sequence[str] | str, path: str,
                  checkpoint: str, trigger: str | None = None, query_name: str | None = None) -> StreamingQuery:
    """Keep, at ``path``, the distinct keys seen on the stream that the sink does not hold.

    Every batch joins its keys and those still open with the sink's version of that moment (left anti), so
    keys that land later leave the list.  ``sink`` gives the sink's current rows, e.g. ``read_current`` of a
    complete-mode folder.  A batch that is repeated gives the same list.  Read it with
    ``sinks.read_current``; ``refresh_missing`` takes landed keys out while the stream is idle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    versions.clean_folder(rows.sparkSession, path)

    def check(batch: DataFrame, batch_id: int) -> None:
        _check(batch.select(*keys), sink, keys, path)

    return start_batches(rows.select(*keys), "append", checkpoint, trigger, query_name, check)


def refresh_missing(spark: SparkSession, sink: Callable[[SparkSession], DataFrame], key: Sequence[str] | str,
                    path: str) -> DataFrame:
    """Take the keys that have landed since the last batch out of the list; call it with no batch at work."""
    keys = [key] if isinstance(key, str) else list(key)
    _check(read_current(spark, path).limit(0), sink, keys, path)
    return read_current(spark, path)


def _check(new: DataFrame, sink: Callable[[SparkSession], DataFrame], keys: list[str], path: str) -> None:
    spark = new.sparkSession
    seen = new.distinct()
    if versions.pointer(spark, path):
        seen = seen.unionByName(read_current(spark, path)).distinct()
    stored = sink(spark).select(*keys)
    open_ = seen.join(stored, _same(seen, stored, keys), "left_anti")
    versions.replace_folder(open_, path)
