"""SimHash near-dedup with covering locality-sensitive hashing.

Every bit of the 64-bit fingerprint gets a nonzero (radius + 1)-bit vector; each
nonzero vector v makes one table, whose mask has the bits with an odd product
with v.  The vectors of any ``radius`` bits leave some v orthogonal to all of
them, so two fingerprints that differ only there agree under that mask: no pair
within the radius is missed.

Buckets of a table hold distinct fingerprints.  A bucket over ``bucket_limit`` is
cut again by the values of radius + 1 parts of its unmasked bits (one part must be free of
differences), until all are small enough; each small bucket gives the edges of a
spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, free_name, materialise
from shopflow.llm.graph import components

BITS = 64


def masks(radius: int) -> list[int]:
    """The covering masks: 2 ** (radius + 1) - 1 of them."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(BITS) if ((1 + i % vectors) & v).bit_count() & 1)
            for v in range(1, vectors + 1)]


def finer(mask: int, radius: int) -> list[int]:
    """``mask`` and one of radius + 1 parts of the bits it lacks."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[k::radius + 1]) for k in range(radius + 1)]


def fingerprint(text: str | None, shingle: int = 3, block: int = 1 << 16) -> int:
    """Bits set in over half the XXH64 (seed 42) hashes of the word shingles; no word: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(BITS, np.int64)
    for at in range(0, n, block):
        own = words[at:at + block + shingle - 1]
        grams = map(b" ".join, zip(*(own[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((xxh64_intdigest(g, 42) for g in grams), "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):
            total += np.add.reduce(bits[k:k + 255], axis=0, dtype=np.uint8)
    return sum(1 << i for i in np.flatnonzero(2 * total > n).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the pairs within the radius, by breadth-first search."""
    left = np.unique(prints)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                for y in left[near]:
                    yield int(x), int(y)
                queue += list(left[near])
                left = left[~near]


def _row_key(id_col: str, text_col: str) -> Column:
    """Tells apart rows that share an id."""
    return F.concat_ws(":", col(id_col).cast("string"), F.hex(F.xxhash64(col(text_col))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, row_key, fp (the fingerprint as a signed long) of every row."""
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.int64())],
                                             names=["doc_id", "row_key", "fp"])

    return (docs.select(col(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col).alias("row_key"),
                        col(text_col).alias("text"))
            .mapInArrow(prints, "doc_id long, row_key string, fp long"))


def links(distinct: DataFrame, radius: int = 3, bucket_limit: int = 8192) -> DataFrame:
    """Edges (u, v) that join all fingerprints ``fp`` (distinct) that are within the radius."""
    def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [e for prints in batch.column(0)
                     for e in forest(prints.values.to_numpy().view(np.uint64), radius)]
            ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

    spark, level = distinct.sparkSession, masks(radius)
    tables: Column = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                               for t, m in enumerate(level)))
    buckets, found = distinct.select("fp", F.inline(tables)), None
    while True:
        sizes = materialise(buckets.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
        members = buckets.join(sizes, ["t", "k"])
        small = (members.filter(F.col("n") <= bucket_limit).groupBy("t", "k")
                 .agg(F.collect_list("fp").alias("prints")).select("prints").mapInArrow(spanning, "u long, v long"))
        small = materialise(small.distinct(), "links")
        found = small if found is None else found.unionByName(small)
        if sizes.filter(F.col("n") > bucket_limit).isEmpty():
            return found
        large = materialise(members.filter(F.col("n") > bucket_limit).select("fp", "t"), "large-buckets")
        # radius + 1 rows for each table of this level: a fixed number, whatever the input
        cut = [(t, t * (radius + 1) + j, _signed(f)) for t, m in enumerate(level) for j, f in enumerate(finer(m, radius))]
        level = [f for m in level for f in finer(m, radius)]
        next_tables = F.broadcast(spark.createDataFrame(cut, "t int, finer int, mask long"))
        buckets = large.join(next_tables, "t").select(
            "fp", F.col("finer").alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("k")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, kept, row_key: one row per row of ``docs``.

    Null, empty and blank texts have fingerprint zero, which links like any other.
    component_id is the smallest id reachable, null where a component has no id; kept
    marks its rows, or without ids those with the smallest row_key.  Repeated rows keep a row each.  An
    empty table gives no rows.  Other columns are ignored.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min("row_key").alias("key")),
                           "distinct-prints")
    roots = materialise(components(links(distinct.select("fp"), radius)), "roots")
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", "key", F.coalesce("root", "fp").alias("root"))
    least = materialise(placed.groupBy("root").agg(F.min("first").alias("component_id"), F.min("key").alias("least")),
                        "components")
    named = materialise(placed.join(least, "root").select("fp", "component_id", "least"), "named-prints")
    kept = F.when(F.col("component_id").isNull(), F.col("row_key") == F.col("least")).otherwise(
        F.col("doc_id").eqNullSafe(F.col("component_id")))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        kept.alias("kept"), "row_key")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with all their columns."""
    key = free_name(docs, "__row")
    gone = near_duplicates(docs, id_col, text_col, **options).filter("NOT kept").select(
        F.col("row_key").alias(key)).distinct()
    return docs.withColumn(key, _row_key(id_col, text_col)).join(gone, key, "left_anti").drop(key)
