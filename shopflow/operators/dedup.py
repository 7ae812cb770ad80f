"""De-duplication operators (bronze layer)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_payload(df: DataFrame, payload: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per distinct payload, keeping the maximum of each ``latest`` column.

    Works on a batch table and on a stream (stateful aggregation).  Two equal
    payloads seen at different times collapse into the later one; a NULL payload
    column is a group value like any other.  Partial aggregation runs before
    the shuffle, so a hot payload costs one row per input partition.
    """
    out = df.groupBy(*payload).agg(*[F.max(c).alias(c) for c in latest])
    return out.select(*[c for c in df.columns if c in set(payload) | set(latest)])


def first_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``key``.

    Batch: the row that is smallest on ``order`` (then on every other column),
    as an aggregate of ``min(struct(...))`` -- deterministic, so a recomputed
    partition after an executor loss gives the same winner, and skew-safe
    (partial aggregation).  Stream: ``dropDuplicates`` keeps the first row to
    arrive and remembers the key in the state store.
    """
    if df.isStreaming:
        return df.dropDuplicates(list(key))
    rest = [c for c in df.columns if c not in set(key) | set(order)]
    winner = F.min(F.struct(*[F.col(c) for c in (*order, *rest)])).alias("_w")
    out = df.groupBy(*key).agg(winner)
    return out.select(*[F.col(c) if c in key else F.col(f"_w.{c}").alias(c) for c in df.columns])


def latest_by_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Keep, per ``key``, the row that is largest on ``order`` (then on every
    other column) -- e.g. the latest version of a shoe whose price changed,
    which payload-level de-duplication keeps as a second row.  Batch only;
    one ``max(struct(...))`` aggregate, skew-safe and deterministic."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    winner = F.max(F.struct(*[F.col(c) for c in (*order, *rest)])).alias("_w")
    out = df.groupBy(*keys).agg(winner)
    return out.select(*[F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in df.columns])
