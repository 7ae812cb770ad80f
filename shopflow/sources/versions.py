"""Whole results that are replaced in one step while they are being read.

Every write goes to a new version with a name of its own, never seen before, so neither a
repeated attempt nor a run on another checkpoint touches what a reader may hold.  Then a
pointer is swapped in one step and the version that it left two swaps ago is removed: a
reader that has just looked the pointer up can finish.

For a catalog name the pointer is a view of the version's table; its properties name the
current and the previous version.  For a folder it is the file with the highest number below ``_pointers``
in it, with the names of both.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTERS = "_pointers"
_PROPERTY = "shopflow.version"


def _new_name() -> str:
    return f"v_{uuid.uuid4().hex}"


# ------------------------------------------------------------------ catalog

def _quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Current and previous version of a catalog name, as far as it has them."""
    if not spark.catalog.tableExists(name):
        return []
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}
    return [v for v in found.get(_PROPERTY, "").split(",") if v]


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _point(spark: SparkSession, name: str, version: str, keep: list[str]) -> None:
    kept = ",".join([version, *keep[:1]])
    if spark.catalog.tableExists(name) and not is_view(spark, name):
        # a plain table of that name becomes the previous version; its rows stay readable until the next swap
        old = f"{name}__{_new_name()}"
        spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(old)}")
        keep, kept = [old], f"{version},{old}"
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ('{_PROPERTY}' = '{kept}') "
              f"AS SELECT * FROM {_quoted(version)}")
    for left in keep[1:]:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(left)}")


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                  spark: SparkSession | None = None) -> None:
    """``CREATE OR REPLACE TABLE name AS <df>``, readable throughout, also through permanent views."""
    spark = spark or df.sparkSession
    before, version = _versions(spark, name), f"{name}__{_new_name()}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(version)
    _point(spark, name, version, before)


def create_empty(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> None:
    """``CREATE OR REPLACE TABLE name (schema)``: an empty first (or next) version."""
    before, version = _versions(spark, name), f"{name}__{_new_name()}"
    spark.catalog.createTable(version, schema=schema, source=fmt)
    _point(spark, name, version, before)


def drop(spark: SparkSession, name: str) -> None:
    """Remove a name with its versions, whether view or plain table."""
    for version in _versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")
    spark.sql(f"DROP {'VIEW' if is_view(spark, name) else 'TABLE'} IF EXISTS {_quoted(name)}")


# ------------------------------------------------------------------ folders

def _path(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    at, store = _path(spark, f"{path}/{POINTERS}")
    if not store.exists(at):
        return []
    return sorted(int(n) for n in (s.getPath().getName() for s in store.listStatus(at)) if n.isdigit())


def pointer(spark: SparkSession, path: str) -> list[str]:
    """The words of the newest pointer; none before the first swap."""
    while True:
        numbers = _numbers(spark, path)
        if not numbers:
            return []
        at, store = _path(spark, f"{path}/{POINTERS}/{numbers[-1]:012d}")
        if not store.exists(at):
            continue  # three swaps since the listing: look again
        source = store.open(at)
        try:
            return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8").split()
        finally:
            source.close()


def swap_pointer(spark: SparkSession, path: str, words: list[str]) -> None:
    """Add a pointer with the next number by one rename; older ones stay for readers that have listed them."""
    numbers = _numbers(spark, path)
    following = numbers[-1] + 1 if numbers else 0
    new, store = _path(spark, f"{path}/{POINTERS}/new-{uuid.uuid4().hex}")
    out = store.create(new, True)
    out.write(bytearray(" ".join(words).encode()))
    out.close()
    if not store.rename(new, _path(spark, f"{path}/{POINTERS}/{following:012d}")[0]):
        raise RuntimeError(f"{path} has another writer")
    for old in numbers[:-2]:
        delete(spark, f"{path}/{POINTERS}/{old:012d}")


def delete(spark: SparkSession, at: str) -> None:
    path, store = _path(spark, at)
    store.delete(path, True)


def folders(spark: SparkSession, at: str) -> list[str]:
    """Names of the folders directly below ``at``."""
    path, store = _path(spark, at)
    if not store.exists(path):
        return []
    names = (s.getPath().getName() for s in store.listStatus(path) if s.isDirectory())
    return sorted(n for n in names if not n.startswith("_"))


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", note: str = "-") -> None:
    """A new version of the folder ``path``; ``note`` (one word) is kept with it in the pointer."""
    spark = df.sparkSession
    before, version = pointer(spark, path), _new_name()
    df.write.format(fmt).save(f"{path}/{version}")
    swap_pointer(spark, path, [version, note, *before[:2]])
    if len(before) >= 3:
        delete(spark, f"{path}/{before[2]}")


def clean_folder(spark: SparkSession, path: str) -> None:
    """Remove versions that no swap reached (their writer was lost); call it with no writer at work."""
    kept = pointer(spark, path)
    for name in folders(spark, path):
        if name.startswith("v_") and name not in kept:
            delete(spark, f"{path}/{name}")


def current_folder(spark: SparkSession, path: str) -> str:
    """Folder of the version that ``path`` points at."""
    words = pointer(spark, path)
    if not words:
        raise FileNotFoundError(f"{path} has no current version")
    return f"{path}/{words[0]}"


def note_of(spark: SparkSession, path: str) -> str | None:
    """The note of the current version, None before the first one."""
    words = pointer(spark, path)
    return words[1] if words else None
