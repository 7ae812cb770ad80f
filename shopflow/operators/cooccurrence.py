"""Items that go together: a sparse item-item product in blocks.

Two items share as many baskets as the product of the basket-item matrix with its transpose says.
A basket is cut into lists of items of one block (about ``BLOCK_ITEMS`` items of the catalogue), and
lists meet as pairs of blocks, so a basket with the whole catalogue is blocks x blocks rows over many tasks,
and one with a few items is a few.  Tasks multiply the lists in numpy and put out sums, never single pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.session import checkpoint_dir, import_in_workers

#: items of a block, about: bounds a list's length
BLOCK_ITEMS = 1024
#: lists of one basket that one task pairs with all of its lists
LISTS_PER_TASK = 64
#: pairs that a task multiplies or holds at once
PAIRS_HELD = 1 << 20

_PAIRS = "i long, j long, n_both long"


def _multiply(a: pa.ListArray, b: pa.ListArray) -> Iterator[np.ndarray]:
    """Codes ``i << 32 | j`` of the pairs i < j of each row's lists, about ``PAIRS_HELD`` at a time."""
    (va, oa), (vb, ob) = ((x.values.to_numpy(), x.offsets.to_numpy()) for x in (a, b))
    la, lb = np.diff(oa).astype(np.int64), np.diff(ob).astype(np.int64)
    ends, row = np.cumsum(la * lb), 0
    while row < len(la):
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + PAIRS_HELD, "right")))
        each = la[row:stop] * lb[row:stop]
        of = np.repeat(np.arange(row, stop), each)
        within = np.arange(len(of)) - np.repeat(ends[row:stop] - each - done, each)
        i, j = va[oa[of] + within // lb[of]], vb[ob[of] + within % lb[of]]
        yield (i << 32 | j)[i < j]
        row = stop


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of the pairs; what is held is put out when it grows beyond ``PAIRS_HELD`` different pairs."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(codes), 1 << 16):
            part = codes[at:at + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"i": part >> 32, "j": part & 0xFFFFFFFF, "n_both": counts[at:at + (1 << 16)]})

    for batch in batches:
        for new in _multiply(batch.column(0), batch.column(1)):
            new, times = np.unique(new, return_counts=True)
            both, place = np.unique(np.concatenate([codes, new]), return_inverse=True)
            summed = np.zeros(len(both), np.int64)
            np.add.at(summed, place, np.concatenate([counts, times]))
            codes, counts = both, summed
            if len(codes) > PAIRS_HELD:
                yield from out()
                codes, counts = codes[:0], counts[:0]
    yield from out()


def co_counts(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Per ordered pair of different items: the baskets with both, and with each.

    Returns ``item``, ``other``, ``n_both`` (at least 1), ``n_item``, ``n_other``.  An item counts once
    a basket; rows with a NULL basket or item count nowhere; an empty table gives no row.  Rows out are the
    non-zero cells of the product.  Items are numbered below 2^31.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    import_in_workers(spark)
    held = df.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct()
    items = held.groupBy("item").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    place = F.row_number().over(Window.partitionBy("block").orderBy("item")) - 1
    # a block holds BLOCK_ITEMS items but for the hash's chance, so twice that many numbers are enough
    items = items.withColumn("block", block).withColumn("number", F.col("block") * (2 * BLOCK_ITEMS) + place).checkpoint()

    met = _met(held, items)
    sums = met.select("a", "b").mapInArrow(_sums, _PAIRS).groupBy("i", "j").agg(F.sum("n_both").alias("n_both"))
    ways = sums.select(F.inline(F.array(F.struct(F.col("i"), F.col("j")), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))),
                       "n_both")

    def named(number: str, name: str) -> DataFrame:
        return items.select(F.col("number").alias(number), F.col("item").alias(name), F.col("n").alias(f"n_{name}"))

    return ways.join(named("i", "item"), "i").join(named("j", "other"), "j").select(
        "item", "other", "n_both", "n_item", "n_other")


def _met(held: DataFrame, items: DataFrame) -> DataFrame:
    """A row per basket and pair of its blocks: the lists ``a`` and ``b``.

    A basket of many lists is joined in parts, each with ``LISTS_PER_TASK`` of them on one side.
    """
    lists = held.join(items, "item").groupBy("basket", "block").agg(F.collect_list("number").alias("numbers")).checkpoint()
    parts = lists.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / F.lit(LISTS_PER_TASK)).alias("parts")).checkpoint()
    sized = lists.join(parts, "basket")
    one = sized.select("basket", F.pmod(F.xxhash64("block"), F.col("parts")).alias("part"), F.col("block").alias("block_i"),
                       F.col("numbers").alias("a"))
    other = sized.select("basket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                         F.col("block").alias("block_j"), F.col("numbers").alias("b"))
    return one.join(other, ["basket", "part"]).filter("block_i <= block_j").sortWithinPartitions("block_i", "block_j")


def top_partners(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` others that share most baskets with each item, ties by the smaller other, as ``rank`` 1 to k.

    The filter on the rank becomes a window group limit, so a task sends on at most k rows an item.
    """
    order = Window.partitionBy("item").orderBy(F.col("n_both").desc(), "other")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
