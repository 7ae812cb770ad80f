"""Every order once, for ever, without streaming state.

The sink itself remembers which ids have come: each batch is a slice below the day of its arrival, sorted by id,
with a Parquet Bloom filter on the id and its smallest and largest id noted beside it.  A new batch asks the
slices whose range meets its own, so a repeat goes however late it is, a new order stays however late it is,
and no watermark or time to live decides about either.  The slices of a past day are folded into one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.operators.dedup import first_by_key
from shopflow.sources import versions
from shopflow.streaming.sinks import run_of, start_batches

#: up to so many ids are asked with an IN list, which Parquet answers from Bloom filters; beyond with a join
IN_LIST = 1000


def slices(spark: SparkSession, path: str) -> list[str]:
    """The slices that hold the rows: a past day's whole, and the batches of days not folded yet."""
    out = []
    for day in (d for d in versions.folders(spark, path) if d.startswith("day=")):
        words = versions.pointer(spark, f"{path}/{day}")
        out += [f"{day}/{n}" for n in (words[:1] or versions.folders(spark, f"{path}/{day}"))]
    return out


def read_once(spark: SparkSession, path: str) -> DataFrame:
    """All rows written so far, each key once."""
    return spark.read.parquet(*(f"{path}/{s}/rows" for s in slices(spark, path)))


def _write(rows: DataFrame, key: str, at: str) -> None:
    """A slice: rows sorted by key with Bloom filters, and one row with the range of its keys."""
    rows.sortWithinPartitions(key).write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true").option(
        "parquet.bloom.filter.adaptive.enabled", "true").parquet(f"{at}/rows")
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"{at}/rows").select(F.col(key).alias("k"))
    written.agg(F.min("k").alias("lo"), F.max("k").alias("hi"), (F.count("*") - F.count("k")).alias("nulls")).write.mode(
        "overwrite").parquet(f"{at}/range")


def stored_keys(spark: SparkSession, path: str, among: list[str], key: str, ids: DataFrame) -> DataFrame:
    """Those of ``ids`` (distinct) that the slices ``among`` hold.

    Slices whose range misses that of the ids are not opened.  Few ids are asked with an IN list, more with
    a join behind a range, so row groups of other ids are skipped as well.
    """
    lo, hi, n, known = ids.agg(F.min(key), F.max(key), F.count("*"), F.count(key)).first()
    meets = F.lit(False) if known == 0 else (F.col("lo") <= F.lit(hi)) & (F.col("hi") >= F.lit(lo))
    if n > known:
        meets = F.coalesce(meets, F.lit(False)) | (F.col("nulls") > 0)
    ranges = spark.read.parquet(*(f"{path}/{s}/range" for s in among)).withColumn("file", F.input_file_name())
    met = [r["file"].rpartition("/range/")[0].rsplit("/", 2)[-2:] for r in ranges.filter(meets).select("file").collect()]
    if not met:
        return ids.limit(0)
    rows = spark.read.parquet(*(f"{path}/{'/'.join(s)}/rows" for s in met)).select(key)
    if n <= IN_LIST:
        hit = rows.filter(F.col(key).isin([r[0] for r in ids.filter(F.col(key).isNotNull()).collect()]))
    else:
        hit = rows.filter(F.col(key).between(lo, hi)).join(ids, key, "left_semi")
    if n > known:
        hit = hit.unionAll(rows.filter(F.col(key).isNull()))
    return hit.distinct()


def fold_day(spark: SparkSession, path: str, day: str, key: str) -> None:
    """Make one slice of a day's slices; what they hold, and what a repeated batch finds in them, stays."""
    parts = versions.folders(spark, f"{path}/{day}")
    whole = versions._new_name()
    rows = spark.read.parquet(*(f"{path}/{day}/{p}/rows" for p in parts))
    _write(rows.repartitionByRange(key), key, f"{path}/{day}/{whole}")
    versions.swap_pointer(spark, f"{path}/{day}", [whole])


def write_once(rows: DataFrame, key: str, path: str, checkpoint: str, order: list[str],
               trigger: str | None = "availableNow", query_name: str | None = None,
               today: Callable[[], str] | None = None) -> StreamingQuery:
    """Append each ``key`` of the stream once to ``path``; a repeated batch overwrites its own slice.

    Of the rows of one key in a batch the first by ``order`` (then by all columns) stays, and an earlier batch beats
    a later one.  A NULL key is a key like any other.  ``today`` names the day of arrival (UTC if not given).
    One writer at a time.
    """
    run = run_of(checkpoint)
    today = today or (lambda: _dt.datetime.now(_dt.timezone.utc).date().isoformat())

    def add(batch: DataFrame, batch_id: int) -> None:
        spark, own, now = batch.sparkSession, f"{run}-{batch_id:012d}", f"day={today()}"
        for day in versions.folders(spark, path):
            if day.startswith("day=") and day < now and not versions.pointer(spark, f"{path}/{day}"):
                fold_day(spark, path, day, key)
        found = slices(spark, path)
        before = [s for s in found if s.endswith(f"/{own}")]  # from an attempt that was not committed
        others = [s for s in found if s not in before]
        new = first_by_key(batch, [key], order)
        if others:
            new = new.persist()  # a key must get the same answer in the check and in the slice
            hit = stored_keys(spark, path, others, key, new.select(key)).withColumnRenamed(key, "_stored")
            kept = new.join(hit, new[key].eqNullSafe(hit["_stored"]), "left_anti")
        else:
            kept = new
        _write(kept, key, f"{path}/{before[0] if before else f'{now}/{own}'}")
        new.unpersist()

    return start_batches(rows, "append", checkpoint, trigger, query_name, add)
