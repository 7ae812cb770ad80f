"""Small helpers shared by the operators: column names, shared tables, prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopflow.session import scratch_path

#: ASCII white space of the text contracts, as a Java character class
SPACES = r"[\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors see; it goes with the run."""
    return scratch_path(spark, f"llm-{name}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def spread(*cols: Column | str, buckets: int, seed: int = 0) -> Column:
    """A hash bucket of the columns, independent of the hash that deals the shuffle."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(buckets)).cast("int")


def running_start(df: DataFrame, order: str, value: str, out: str, block: int = 1024) -> DataFrame:
    """Sum of ``value`` over the rows with a smaller integer ``order`` (unique, >= 0).

    Two levels: within blocks of ``block`` rows, and over the block totals, so no
    task sorts more than ``block`` rows or rows / ``block`` totals.
    """
    blocked = df.withColumn("__block", F.floor(col(order) / block).cast("long"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy("__block").agg(F.sum(col(value)).alias("__total")).select(
        "__block", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__block").orderBy(col(order)).rowsBetween(Window.unboundedPreceding, -1)
    return (blocked.withColumn("__inside", F.coalesce(F.sum(col(value)).over(inside), F.lit(0)))
            .join(totals, "__block")
            .withColumn(out, F.col("__before") + F.col("__inside"))
            .drop("__block", "__before", "__inside"))
