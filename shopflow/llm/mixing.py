"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share over its own share.  Each document draws a
number from a hash of its key, which the source's Poisson distribution function turns
into a repetition count with that mean; the copies are shuffled globally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, free_name, materialise


def thresholds(rate: float) -> list[float]:
    """P(count <= k) for k from 0 on, until no double below 1 lies beyond."""
    if not rate > 0:
        return [1.0]
    k = np.arange(int(rate + 12 * np.sqrt(rate) + 40))
    logs = k * np.log(rate) - rate - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    below = np.minimum(np.cumsum(np.exp(logs)), 1.0)
    return below[:int(np.searchsorted(below, 1 - 2.0 ** -50)) + 1].tolist()


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1): the first 48 bits of an MD5; a null key is the key ''."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def rates(docs: DataFrame, source_col: str = "source", exponent: float = 0.7,
          weights: dict[str | None, float] | None = None) -> DataFrame:
    """source, n, rate (target rows / rows) of every source, null included.

    Targets are ``weights`` (a source not named has none), or the sources' rows to the power ``exponent``; they are
    scaled so that the expected rows in all equal the rows there are.
    """
    counts = materialise(docs.groupBy(col(source_col).cast("string").alias("source")).agg(
        F.count("*").alias("n")), "sources")
    if weights is None:
        target = F.pow(F.col("n").cast("double"), F.lit(exponent))
    else:
        target = F.lit(0.0)
        for name, w in weights.items():
            target = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(target)
    aimed = counts.withColumn("target", target)
    rows, targets = aimed.agg(F.sum("n"), F.sum("target")).first()  # two numbers
    share = F.lit(rows / targets) if targets else F.lit(0.0)
    return aimed.select("source", "n", (F.col("target") / F.col("n") * share).alias("rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 1,
        exponent: float = 0.7, weights: dict[str | None, float] | None = None,
        broadcast_bytes: int = 32 << 20, replica: str = "replica") -> DataFrame:
    """Every column of ``docs`` and, last, ``replica`` (0 on; with underscores added where
    ``docs`` has such a column): a row per copy, in random order.

    A document of count 0 has no copy.  Rows with one id draw the same count; null
    ids draw that of the key ''; null is a source of its own.  An empty table gives no rows.  The
    sources' distribution functions (8 bytes a step, more steps at higher rates) are broadcast while
    names and functions measure at most ``broadcast_bytes``; beyond, they are joined by shuffle.
    """
    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["source"]].assign(below=[thresholds(r) for r in pdf["rate"]])

    replica = free_name(docs, replica)
    per_source = materialise(rates(docs, source_col, exponent, weights).mapInPandas(
        tables, "source string, below array<double>"), "rates")
    key, below, u, order = (free_name(docs, c) for c in ("__source", "__below", "__u", "__order"))
    per_source = per_source.select(F.col("source").alias(key), F.col("below").alias(below))
    size = F.size(below) * 8 + F.coalesce(F.octet_length(key), F.lit(0)) + 64
    if (per_source.agg(F.sum(size.cast("long"))).first()[0] or 0) <= broadcast_bytes:
        per_source = F.broadcast(per_source)
    counted = docs.join(per_source, col(source_col).cast("string").eqNullSafe(F.col(key)), "left").withColumn(
        u, draw(col(id_col), seed))
    # the count is the number of thresholds that the draw has reached
    copies = F.size(F.filter(F.col(below), lambda t: t <= F.col(u)))
    spread_out = counted.withColumn(replica, F.explode(
        F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))))
    shuffled = spread_out.withColumn(order, F.xxhash64(F.lit(seed), col(id_col), F.col(replica)))
    return shuffled.repartition(F.col(order)).sortWithinPartitions(order).select(
        *(col(c) for c in docs.columns), F.col(replica))
