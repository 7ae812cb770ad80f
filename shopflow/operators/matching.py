"""Matches along time that cost what they put out: interval rows, the next event, the row before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.operators.interval import HOUR, _bucket
from shopflow.session import checkpoint_dir

#: ranks that one step of the expansion holds in a row
BLOCK = 4096


def interval_rows(intervals: DataFrame, events: DataFrame, keys: Sequence[str], lo: str, hi: str, time_col: str,
                  bucket_seconds: int = HOUR) -> DataFrame:
    """Every (interval, event) pair with equal ``keys`` and ``lo <= time <= hi``: the interval's columns and the event's others.

    The distinct times of a key are ranked (by running totals over time buckets, as in ``interval_totals``), and
    so are the interval's bounds, so an interval knows the ranks it holds.  It is expanded to them and
    joined on (keys, rank), then on (keys, time): both are equality joins on keys that occur a few times, so the
    work grows with the rows that come out, also where one key holds most of the input.  NULL keys,
    times and bounds match nothing.  Column names of both sides differ but for the keys.
    """
    keys = list(keys)
    known = [F.col(k).isNotNull() for k in keys]
    held = events
    for c in [*known, F.col(time_col).isNotNull()]:
        held = held.filter(c)
    asked = intervals.filter(F.col(lo) <= F.col(hi))
    for c in known:
        asked = asked.filter(c)
    asked = asked.groupBy(*intervals.columns).agg(F.count(F.lit(1)).alias("_times"))
    asked = asked.select(*keys, F.struct(*[c for c in asked.columns if c not in keys]).alias("_interval"))

    def probe(bound: str, row: int) -> Column:
        return F.struct(F.col(f"_interval.{bound}").alias(time_col), F.lit(row).alias("_row"))

    # a 'lo' probe sorts before the times equal to it, a 'hi' probe after them
    probes = asked.select(*keys, "_interval", F.inline(F.array(probe(lo, 0), probe(hi, 2))))
    times = held.select(*keys, time_col).distinct().withColumn("_row", F.lit(1))
    rows = times.unionByName(probes, allowMissingColumns=True).withColumn("_bucket", _bucket(time_col, bucket_seconds))
    is_time = F.when(F.col("_row") == 1, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum(is_time).alias("_count"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "_bucket", F.lit(-1).alias("_row"),
                          F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_count"))
    running = Window.partitionBy(*keys, "_bucket").orderBy(F.col(time_col).asc_nulls_first(), "_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("_count", is_time).unionByName(carry, allowMissingColumns=True).select(
        *keys, time_col, "_row", "_interval", F.sum("_count").over(running).alias("_rank"))

    bounds = ranked.filter("_row = 0 OR _row = 2").groupBy(*keys, "_interval").agg(
        F.max(F.when(F.col("_row") == 0, F.col("_rank"))).alias("_before"),
        F.max(F.when(F.col("_row") == 2, F.col("_rank"))).alias("_last")).filter("_last > _before")
    step = F.lit(BLOCK)
    wide = bounds.withColumn("_block", F.explode(F.sequence(
        F.floor(F.col("_before") / step), F.floor((F.col("_last") - 1) / step))))
    each = wide.withColumn("_rank", F.explode(F.sequence(
        F.greatest(F.col("_before") + 1, F.col("_block") * step + 1), F.least("_last", (F.col("_block") + 1) * step))))
    at = ranked.filter("_row = 1").select(*keys, "_rank", time_col)
    matched = each.select(*keys, "_rank", "_interval").join(at, [*keys, "_rank"]).drop("_rank").join(
        held, [*keys, time_col])
    rest = [c for c in intervals.columns if c not in keys]
    out = matched.select(*keys, *[F.col(f"_interval.{c}").alias(c) for c in rest],
                         *[c for c in events.columns if c not in keys],
                         F.explode(F.sequence(F.lit(1).cast("long"), F.col("_interval._times"))).alias("_copy"))
    return out.drop("_copy")


def next_event(probes: DataFrame, events: DataFrame, keys: Sequence[str], time_col: str, found: Sequence[str],
               out: str, bucket_seconds: int = HOUR) -> DataFrame:
    """``probes`` with a struct ``out``: the first event of the same keys at or after the probe's time (a forward as-of join).

    ``out`` holds the event's ``time_col`` and its ``found`` columns; among events at one time it is the
    smallest of them.  It is NULL where there is none, and for probes without a time.  NULL keys equal each other
    (filter them out to have SQL's rule).  No join: a bucket ends with a carry row that holds the first event of the
    key's later buckets, so one key's rows lie in as many tasks as it has buckets.
    """
    keys, held = list(keys), [c for c in probes.columns if c not in keys]
    event = F.struct(F.col(time_col), *[F.col(c) for c in found])
    rows = events.filter(F.col(time_col).isNotNull()).select(
        *keys, F.col(time_col).alias("_t"), event.alias("_event")).withColumn("_row", F.lit(1))
    asked = probes.select(*keys, F.col(time_col).alias("_t"), F.struct(*held).alias("_probe"), F.lit(0).alias("_row"))
    rows = rows.unionByName(asked, allowMissingColumns=True).withColumn("_bucket", _bucket("_t", bucket_seconds))
    firsts = rows.groupBy(*keys, "_bucket").agg(F.min("_event").alias("_event"))
    later = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    carry = firsts.select(*keys, "_bucket", F.lit(2).alias("_row"), F.min("_event").over(later).alias("_event"))
    # times ascend, the carry row (no time) comes last; a probe comes before the events of its time
    onward = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_t").asc_nulls_last(), "_row").rowsBetween(
        Window.currentRow, Window.unboundedFollowing)
    seen = rows.unionByName(carry, allowMissingColumns=True).select(
        *keys, "_t", "_probe", F.min("_event").over(onward).alias(out))
    return seen.filter(F.col("_probe").isNotNull()).select(
        *[F.col(c) if c in keys else F.col("_probe")[c].alias(c) for c in probes.columns],
        F.when(F.col("_t").isNotNull(), F.col(out)).alias(out))


def global_previous(df: DataFrame, order: Sequence[str], value: str, out: str, partitions: int | None = None) -> DataFrame:
    """``LAG(value) OVER (ORDER BY order)`` without sending all rows to one task.

    Rows are dealt to ranges of the order and lagged inside each; a second pass hands every range the last value
    of the range before it, which is one row a range.  NULLs come first; rows should differ on
    ``order``.  The dealt rows are checkpointed, so both passes see the same ranges.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in order]
    dealt = df.repartitionByRange(n, *by).withColumn("_part", F.spark_partition_id()).checkpoint()
    last = dealt.groupBy("_part").agg(F.max(F.struct(*order, F.col(value).alias("_value")))["_value"].alias("_value"))
    parts = sorted(r["_part"] for r in last.select("_part").collect())  # at most n numbers
    follows = spark.createDataFrame(list(zip(parts, parts[1:])), "_part int, _next int")
    carry = last.join(follows, "_part").select(F.col("_next").alias("_part"), F.col("_value").alias("_carry"))
    inside = Window.partitionBy("_part").orderBy(*by)
    lagged = dealt.select("*", F.lag(value).over(inside).alias("_lag"), F.row_number().over(inside).alias("_place"))
    return lagged.join(carry, "_part", "left").select(
        *df.columns, F.when(F.col("_place") == 1, F.col("_carry")).otherwise(F.col("_lag")).alias(out))


def totals_before(probes: DataFrame, events: DataFrame, keys: Sequence[str], time_col: str, values: Sequence[str],
                  bucket_seconds: int = HOUR) -> DataFrame:
    """``probes`` with each of ``values`` summed over the events of the same keys strictly before the probe's time.

    Sums are integers; NULLs add nothing, and where no event is earlier the sum is 0.  A probe without a time gets
    NULL.  NULL keys equal each other (filter them out to have SQL's rule).  No join: a bucket starts with a carry row
    that holds the sums of the key's earlier buckets, so one key's rows lie in as many tasks as it has buckets.
    """
    keys, held = list(keys), [c for c in probes.columns if c not in keys]
    rows = events.filter(F.col(time_col).isNotNull()).select(
        *keys, F.col(time_col).alias("_t"), *[F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(f"_sum_{v}") for v in values],
        F.lit(1).alias("_row"))
    asked = probes.select(*keys, F.col(time_col).alias("_t"), F.struct(*held).alias("_probe"), F.lit(0).alias("_row"))
    rows = rows.unionByName(asked, allowMissingColumns=True).withColumn("_bucket", _bucket("_t", bucket_seconds))
    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(f"_sum_{v}").alias(f"_sum_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "_bucket", F.lit(-1).alias("_row"),
                          *[F.sum(f"_sum_{v}").over(earlier).alias(f"_sum_{v}") for v in values])
    # the carry row (no time) comes first; a probe comes before the events of its time
    running = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_t").asc_nulls_first(), "_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = rows.unionByName(carry, allowMissingColumns=True).select(
        *keys, "_t", "_probe", *[F.coalesce(F.sum(f"_sum_{v}").over(running), F.lit(0)).alias(f"_sum_{v}") for v in values])
    return seen.filter(F.col("_probe").isNotNull()).select(
        *[F.col(c) if c in keys else F.col("_probe")[c].alias(c) for c in probes.columns],
        *[F.when(F.col("_t").isNotNull(), F.col(f"_sum_{v}")).alias(v) for v in values])
