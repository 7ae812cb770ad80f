"""Join helpers.

No join side is ever broadcast unconditionally: Spark broadcasts a side only
when its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, AQE
decides again from the measured shuffle output, and otherwise a sort-merge join
runs whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_multiplicity(df: DataFrame, key: str, alias: str = "mult") -> DataFrame:
    """Rows per key of a dimension: joining this instead of the dimension keeps
    fact counts exact when keys repeat, while shuffling one narrow row per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
