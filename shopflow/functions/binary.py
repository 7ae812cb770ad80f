"""Message-key decoding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _long_keys(keys: pd.Series) -> pd.Series:
    return pd.Series([None if k is None else str(int.from_bytes(bytes(k), "big")) for k in keys], dtype=object)


def unsigned_decimal(col: str | Column) -> Column:
    """Bytes of any length read as one unsigned big-endian integer, written in decimal.

    Empty bytes give ``'0'``, NULL stays NULL.  Keys up to 8 bytes are decoded
    in the JVM (``conv`` of the hex digits); only longer ones carry their bytes
    to Python, in Arrow batches.
    """
    c = F.col(col) if isinstance(col, str) else col
    size = F.octet_length(c)
    return (
        F.when(size == 0, F.lit("0"))
        .when(size <= 8, F.conv(F.hex(c), 16, 10))
        .otherwise(_long_keys(F.when(size > 8, c)))
    )
