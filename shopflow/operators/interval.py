"""Interval operators that never emit all pairs of a group.

Matching each order with every click of the same (customer, product) and then
keeping the clicks inside [previous order, this order] emits n x m rows for a
group with n orders and m clicks.  Here the same numbers come from running totals:

    sum over clicks in [lo, hi]  =  S(<= hi) - S(< lo)

A window never spans a whole key.  Time is cut into buckets; each (key, bucket)
starts with one carry row that holds what the key's earlier buckets add up to, so
a window over one bucket already yields totals over all time.  The carry rows
come from one pre-aggregated row per (key, active bucket).  Neither operator
needs a join, so NULL keys form a group of their own, as in SQL's PARTITION BY.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.times import epoch_seconds

#: seconds per bucket
HOUR = 3_600


def _bucket(time_col: str, seconds: int) -> Column:
    return F.floor(epoch_seconds(time_col) / F.lit(seconds)).cast("long")


def previous_time(
    df: DataFrame, partition: Sequence[str], time_col: str, tiebreak: Sequence[str], out: str = "prev_ts",
    bucket_seconds: int = HOUR,
) -> DataFrame:
    """``LAG(time) OVER (PARTITION BY partition ORDER BY time, *tiebreak)`` as a column ``out``.

    Rows must be distinct on (partition, time, tiebreak).  Rows with a NULL time
    get NULL, and so does the first row after them, as with NULLS FIRST ordering.
    The carry row of a bucket is the last time of the partition's previous
    active bucket.
    """
    partition = list(partition)
    rows = df.withColumn("_bucket", _bucket(time_col, bucket_seconds))
    # NULL times are a bucket too, the first one: its carry is NULL, as is the next bucket's
    # (max_by, as for a plain max the optimiser would drop a DISTINCT below this branch only,
    # and the two branches could no longer share one scan)
    last = rows.groupBy(*partition, "_bucket").agg(F.max_by(time_col, time_col).alias("_max"))
    by_bucket = Window.partitionBy(*partition).orderBy("_bucket")
    carry = last.select(*partition, "_bucket", F.lag("_max").over(by_bucket).alias(time_col),
                        F.lit(0).alias("_row"))
    ordered = Window.partitionBy(*partition, "_bucket").orderBy("_row", time_col, *tiebreak)
    lagged = rows.withColumn("_row", F.lit(1)).unionByName(carry, allowMissingColumns=True).withColumn(
        out, F.lag(time_col).over(ordered))
    return lagged.filter(F.col("_row") == 1).select(
        *df.columns, F.when(F.col(time_col).isNotNull(), F.col(out)).alias(out))


def interval_totals(
    intervals: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    lo: str,
    hi: str,
    time_col: str,
    measures: Sequence[str],
    group: Sequence[str],
    key_total: str = "_all",
    bucket_seconds: int = HOUR,
) -> DataFrame:
    """Per ``group`` of interval rows, the sums of the BIGINT ``measures`` over the events of
    the same ``keys`` with ``lo <= time <= hi``, added up over its intervals.

    An interval with a NULL bound holds no event.  ``key_total`` is the sum of the first
    measure over the events of the keys at any time (NULL times too), added up
    likewise.  Events are first reduced to one row per (keys, second).  Both branches read
    the same aggregates, so Spark runs events and intervals once.
    """
    keys, extra = list(keys), [g for g in group if g not in keys]
    timed = F.col(time_col).isNotNull()
    per_second = events.groupBy(*keys, time_col).agg(
        *[F.sum(m).alias(m) for m in measures])
    per_second = per_second.select(
        *keys, time_col, F.lit(1).alias("_row"), F.col(measures[0]).alias("_count"),
        *[F.when(timed, F.col(m)).otherwise(F.lit(0)).alias(m) for m in measures])
    bounded = F.col(lo).isNotNull() & F.col(hi).isNotNull()

    def probe(bound: str, row: int, sign: int) -> Column:
        # a 'lo' probe sorts before the events of its second, a 'hi' probe after them
        return F.struct(F.when(bounded, F.col(bound)).alias(time_col), F.lit(row).alias("_row"),
                        F.when(bounded, F.lit(sign)).otherwise(F.lit(0)).alias("_sign"))

    probes = intervals.select(*keys, *extra, F.inline(F.array(probe(lo, 0, -1), probe(hi, 2, 1))))
    rows = per_second.unionByName(probes, allowMissingColumns=True).withColumn(
        "_bucket", _bucket(time_col, bucket_seconds))

    totals = rows.groupBy(*keys, "_bucket").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures], F.sum("_count").alias("_count"))
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = totals.select(
        *keys, "_bucket", F.lit(-1).alias("_row"), *[F.sum(m).over(earlier).alias(m) for m in measures],
        F.sum("_count").over(whole).alias(key_total))
    running = Window.partitionBy(*keys, "_bucket").orderBy(time_col, "_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    scanned = rows.unionByName(carry, allowMissingColumns=True).select(
        *keys, *extra, "_row", "_sign",
        *[F.sum(m).over(running).alias(m) for m in measures], F.max(key_total).over(running).alias(key_total))
    found = scanned.filter(F.col("_sign").isNotNull())
    return found.groupBy(*group).agg(
        *[F.sum(F.col("_sign") * F.coalesce(F.col(m), F.lit(0))).cast("long").alias(m) for m in measures],
        F.sum(F.when(F.col("_row") == 0, F.coalesce(F.col(key_total), F.lit(0))).otherwise(F.lit(0)))
        .cast("long").alias(key_total))
