"""Tables clustered by a key, for lookups that read one file.

Rows are dealt to files by ranges of the key and sorted inside them, each file carries a Parquet Bloom
filter of its keys, and a manifest beside them lists every file's smallest and largest key.  A lookup
reads the manifest, then only the files whose range holds the value; in them row groups are skipped
by statistics and by the Bloom filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopflow.sources import versions

_MANIFEST = "file string, lo {t}, hi {t}, nulls long, rows long"


def write_clustered(df: DataFrame, path: str, key: str, files: int, bloom: bool = True) -> None:
    """Write a new version of ``path`` in about ``files`` files (table bytes / 128 MB, say).

    Rows with equal keys, NULL too, stay in one range; a key with a large share of the rows makes a large file.
    """
    spark = df.sparkSession
    version = f"{path}/{versions._new_name()}"
    writer = df.repartitionByRange(files, key).sortWithinPartitions(key).write
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(f"{version}/rows")
    _write_manifest(spark.read.schema(df.schema).parquet(f"{version}/rows"), f"{version}/manifest", key)
    before = versions.pointer(spark, path)
    versions.swap_pointer(spark, path, [version.rpartition("/")[2], "-", *before[:2]])
    if len(before) >= 3:
        versions.delete(spark, f"{path}/{before[2]}")


def _write_manifest(rows: DataFrame, at: str, key: str) -> None:
    rows.select(F.col(key).alias("k"), F.input_file_name().alias("file")).groupBy("file").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi"),
        F.sum(F.col("k").isNull().cast("long")).alias("nulls"), F.count("*").alias("rows")).coalesce(1).write.parquet(at)


def files_of(spark: SparkSession, path: str, holds: Column) -> list[str]:
    """Files of the current version whose manifest row satisfies ``holds`` (over lo, hi, nulls)."""
    manifest = spark.read.parquet(f"{versions.current_folder(spark, path)}/manifest")
    return [r["file"] for r in manifest.filter(holds).select("file").collect()]


def lookup_clustered(spark: SparkSession, path: str, key: str, value, schema: StructType | None = None) -> DataFrame:
    """Rows with ``key = value``; a NULL value equals nothing, as in SQL."""
    current = versions.current_folder(spark, path)
    schema = schema or spark.read.parquet(f"{current}/rows").schema
    files = [] if value is None else files_of(spark, path, (F.col("lo") <= F.lit(value)) & (F.col("hi") >= F.lit(value)))
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).filter(F.col(key) == F.lit(value))
