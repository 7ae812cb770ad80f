"""Catalog helpers: bronze DDL, CTAS snapshots, views, column introspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from shopflow.schemas import BRONZE
from shopflow.sources import versions


def create_bronze_tables(spark: SparkSession, database: str | None = None, fmt: str = "parquet",
                         replace: bool = True) -> list[str]:
    """Create the five empty bronze tables (``CREATE OR REPLACE TABLE``).

    Each is an empty version behind its name, so a complete-mode stream can take it over and a
    second set-up can follow a stream.  The default format is parquet; pass ``fmt="delta"`` where the
    Delta jar is installed.  Returns the qualified names.
    """
    names = []
    for table, schema in BRONZE.items():
        name = f"{database}.{table}" if database else table
        if replace or not spark.catalog.tableExists(name):
            versions.create_empty(spark, name, schema, fmt)
        names.append(name)
    return names


def snapshot(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS <df>``; returns the table.

    The new rows are written beside the old ones and swapped in at once: permanent views over ``name``
    and readers at work never find it missing.  A written table also cuts the lineage of a long chain of
    transformations.
    """
    if partition_by:  # few files per partition value; a large value is split
        df = df.hint("rebalance", *partition_by)
    versions.replace_table(df, name, fmt, partition_by)
    return df.sparkSession.table(name)


def view(df: DataFrame, name: str) -> DataFrame:
    """Temporary view (``CREATE OR REPLACE TEMP VIEW``), re-planned on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def persistent_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name AS sql`` over catalog tables (not temp views)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def wire_schema_of(spark: SparkSession, table: str) -> StructType:
    """Parse schema taken from the sink table itself (the reference reads the
    sink's schema and parses the JSON with it): every column but
    ``arrive_dt``, with ``ts`` read as epoch milliseconds (BIGINT)."""
    fields = []
    for f in spark.table(table).schema.fields:
        if f.name == "arrive_dt":
            continue
        fields.append(StructField("ts", LongType(), True) if f.name == "ts" else f)
    return StructType(fields)
