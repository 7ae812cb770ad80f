"""Streaming sinks and triggers.

``complete`` mode rewrites the whole result every micro-batch (the reference's
choice; cost grows with history): each batch is a new version, then a pointer is swapped in one
step (``shopflow.sources.versions``), so a reader always sees one whole version, also while a batch
is repeated after a crash or a run starts on another checkpoint.  For a folder ``read_current``
follows the pointer, a catalog name is read as a table.

``update`` mode writes only the payloads that a batch changed, as one slice per
batch; ``read_updates`` keeps each payload's latest times, and ``fold_updates`` merges the
slices so far into one.  A repeated batch overwrites its own slice.

``append`` mode writes rows once, through the file sink's commit log.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions.columns import payload_columns
from shopflow.operators.dedup import latest_by_payload
from shopflow.sources import versions


def trigger_kwargs(trigger: str | None) -> dict:
    """``"availableNow"`` (process what is there, then stop; replaces the
    deprecated ``once``), ``"once"``, ``None`` (default micro-batches, run until
    stopped) or a processing-time interval such as ``"30 seconds"``."""
    if trigger is None:
        return {}
    if trigger in ("availableNow", "once"):
        return {"availableNow": True}
    number, _, unit = trigger.strip().partition(" ")
    if not number.isdigit() or unit.rstrip("s") not in ("millisecond", "second", "minute", "hour", "day"):
        raise ValueError(f"unknown trigger {trigger!r}")
    return {"processingTime": trigger}


def _one_sink(path: str | None, table: str | None) -> None:
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path and table")


def start_batches(df: DataFrame, mode: str, checkpoint: str, trigger: str | None, query_name: str | None,
                  per_batch) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(per_batch)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**trigger_kwargs(trigger)).start()


def run_of(checkpoint: str) -> str:
    """A name for the runs on one checkpoint: batch numbers count anew on another."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a complete-mode folder."""
    return spark.read.format(fmt).load(versions.current_folder(spark, path))


def write_complete(df: DataFrame, path: str | None, checkpoint: str, trigger: str | None = "availableNow",
                   fmt: str = "parquet", query_name: str | None = None,
                   table: str | None = None) -> StreamingQuery:
    """Complete-mode result, a new version after each micro-batch, at ``path``
    or under the catalog name ``table``, which the bronze DDL may have made before."""
    _one_sink(path, table)
    if path:
        versions.clean_folder(df.sparkSession, path)

    def rewrite(batch: DataFrame, batch_id: int) -> None:
        if table:
            versions.replace_table(batch, table, fmt)
        else:
            versions.replace_folder(batch, path, fmt)

    return start_batches(df, "complete", checkpoint, trigger, query_name, rewrite)


def write_update(df: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow",
                 fmt: str = "parquet", query_name: str | None = None, fold_every: int = 64) -> StreamingQuery:
    """Update-mode result: each micro-batch writes the payloads it changed to
    ``path/slices/<run>-<batch>``; read them with ``read_updates``.  After every ``fold_every``
    batches the slices so far become one."""
    run = run_of(checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/slices/{run}-{batch_id:012d}")
        if batch_id % fold_every == fold_every - 1:
            fold_updates(batch.sparkSession, path, fmt)

    return start_batches(df, "update", checkpoint, trigger, query_name, add)


def _parts(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(folders to read, slices among them): the folded base, then the slices that it lacks."""
    words = versions.pointer(spark, path)
    folded = dict(w.rsplit("-", 1) for w in (words[1].split(",") if words else []) if w != "-")
    new = []
    for name in versions.folders(spark, f"{path}/slices"):
        run, batch = name.rsplit("-", 1)
        if int(batch) > int(folded.get(run, -1)):
            new.append(name)
    return ([f"{path}/{words[0]}"] if words else []) + [f"{path}/slices/{n}" for n in new], new


def read_updates(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Every payload once, with its latest times, from the slices of ``write_update``."""
    rows = spark.read.format(fmt).load(_parts(spark, path)[0])
    latest = [c for c in ("ts", "arrive_dt") if c in rows.columns]
    return latest_by_payload(rows, payload_columns(rows.columns), latest)


def fold_updates(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Merge the slices so far into one folder; returns how many slices ``read_updates`` need not list any more.

    The merged slices are removed by the fold after the next one, so readers can finish.
    """
    new = _parts(spark, path)[1]
    if not new:
        return 0
    words = versions.pointer(spark, path)
    last = dict(w.rsplit("-", 1) for w in (words[1].split(",") if words else []) if w != "-")
    before = dict(w.rsplit("-", 1) for w in (words[3].split(",") if len(words) > 3 else []) if w != "-")
    upto = dict(last)
    for name in new:
        run, batch = name.rsplit("-", 1)
        upto[run] = max(upto.get(run, batch), batch)
    versions.replace_folder(read_updates(spark, path, fmt), path, fmt,
                            note=",".join(f"{r}-{b}" for r, b in sorted(upto.items())))
    for name in versions.folders(spark, f"{path}/slices"):
        run, batch = name.rsplit("-", 1)
        if int(batch) <= int(before.get(run, -1)):
            versions.delete(spark, f"{path}/slices/{name}")
    return len(new)


def write_append(df: DataFrame, path: str | None, checkpoint: str, trigger: str | None = "availableNow",
                 fmt: str = "parquet", query_name: str | None = None,
                 table: str | None = None) -> StreamingQuery:
    """Append-mode file sink (exactly-once through the sink's commit log), to
    ``path`` or to the catalog table ``table``."""
    _one_sink(path, table)
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**trigger_kwargs(trigger))
    return w.toTable(table) if table else w.option("path", path).start()


def write_memory(df: DataFrame, name: str, rows: int = 10_000) -> StreamingQuery:
    """Live preview of a complete-mode view as the in-memory table ``name``:
    at most ``rows`` rows of it reach the driver."""
    return df.limit(rows).writeStream.outputMode("complete").format("memory").queryName(name).start()
