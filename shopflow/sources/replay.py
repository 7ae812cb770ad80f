"""File replay of Kafka-shaped messages (tests, backfills, local runs).

Messages are parquet rows ``key binary, value binary, topic string,
timestamp timestamp``; every new file in the folder is a new slice of the
topic.  The file source tracks processed files in the query checkpoint, so a
restart resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.schemas import KAFKA_ROW


def write_messages(messages: DataFrame, folder: str) -> None:
    """Append one slice of messages to the replay folder."""
    messages.select(*KAFKA_ROW.fieldNames()).write.mode("append").parquet(folder)


def read_messages(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the replay folder."""
    reader = spark.readStream.schema(KAFKA_ROW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)
