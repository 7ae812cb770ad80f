"""Exact dedup by a minimal perfect hash over historical distinct digests.

History is every row up to a locator (doc_id) boundary, the batch what arrives
after it.  The history's distinct digests are dealt to shards; each shard holds a
minimal perfect hash whose slots keep the full digest, the winner's locator and its number of rows.
A batch digest is looked up in its shard and compared byte for byte: members take the slot's winner and
add to the slot's number, nonmembers are groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import SPACES, col, free_name, materialise, spread

_GAMMA = 2.0  # bits per key of a level: more make lookups shorter and the table larger
INDEX = "shard int, slots long, sizes binary, bits binary, digests binary, winners binary, counts binary"


def normalised(text: Column) -> Column:
    """Null is empty; each run of ASCII white space is one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _words(digests: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of 32-byte digests for one level."""
    x = digests.view("<u8").reshape(-1, 4)
    h = x[:, level % 4] + x[:, (level + 1) % 4] * np.uint64(2 * level + 0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(16)


class PerfectHash:
    """Level by level, keys alone at their bit stay; the others go on to the next level.

    A key's slot is the number of set bits before its own: 0 to n - 1, each once.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        """``digests``: distinct rows of 32 bytes."""
        sizes, bits, left = [], [], digests
        while len(left):
            m = max(64, int(_GAMMA * len(left)))
            at = (_words(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            bits.append(alone)
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 where no level has its bit."""
        out = np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for level, (m, start) in enumerate(zip(self.sizes, self.starts)):
            at = (_words(digests[left], level) % np.uint64(m)).astype(np.int64) + start
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return out


def _matrix(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(-1, 32)


def build_index(history: DataFrame) -> DataFrame:
    """Index rows, one per shard, of ``history`` (shard, digest binary, first long, n long; distinct digests)."""
    def build(rows: pa.Table) -> pa.Table:
        digests = _matrix(rows["digest"])
        mph = PerfectHash.build(digests)
        order = np.argsort(mph.slots(digests))
        return pa.Table.from_pydict({
            "shard": pa.array([rows["shard"][0].as_py()], pa.int32()), "slots": [len(digests)],
            "sizes": [mph.sizes.astype("<i8").tobytes()], "bits": [np.packbits(mph.bits).tobytes()],
            "digests": [digests[order].tobytes()],
            "winners": [rows["first"].to_numpy()[order].astype("<i8").tobytes()],
            "counts": [rows["n"].to_numpy()[order].astype("<i8").tobytes()]})

    return history.groupBy("shard").applyInArrow(build, INDEX)


def look_up(index: DataFrame, probe: DataFrame,
            slots_of: Callable[[PerfectHash, np.ndarray], np.ndarray] = PerfectHash.slots) -> DataFrame:
    """digest, keep_id, group_size, member: a row per slot with what members of ``probe`` (shard, digest, first, n)
    add to it, and a row per nonmember."""
    def find(found: pa.Table, rows: pa.Table) -> pa.Table:
        probes, n = _matrix(rows["digest"]), rows["n"].to_numpy()
        member, tables = np.zeros(len(rows), bool), []
        if len(found):
            one = {c: found[c][0].as_py() for c in found.column_names}
            sizes = np.frombuffer(one["sizes"], "<i8")
            mph = PerfectHash(sizes, np.unpackbits(np.frombuffer(one["bits"], np.uint8),
                                                   count=int(sizes.sum())).astype(bool))
            held = np.frombuffer(one["digests"], np.uint8).reshape(-1, 32)
            counts = np.frombuffer(one["counts"], "<i8").copy()
            if len(rows):
                slots = slots_of(mph, probes)
                member = (slots >= 0) & (held[slots] == probes).all(axis=1)
                np.add.at(counts, slots[member], n[member])
            tables.append(pa.table({
                "digest": pa.array([d.tobytes() for d in held], pa.binary()),
                "keep_id": pa.array(np.frombuffer(one["winners"], "<i8")), "group_size": pa.array(counts),
                "member": pa.array(np.ones(len(held), bool))}))
        rest = rows.filter(pa.array(~member))
        tables.append(pa.table({"digest": rest["digest"], "keep_id": rest["first"], "group_size": rest["n"],
                                "member": pa.array(np.zeros(len(rest), bool))}))
        return pa.concat_tables(tables)

    return index.groupBy("shard").cogroup(probe.groupBy("shard")).applyInArrow(
        find, "digest binary, keep_id long, group_size long, member boolean")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 boundary: int | None = None, keys_per_shard: int = 65536,
                 lookup: Callable[[DataFrame, DataFrame], DataFrame] = look_up) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, from_history: one row per row of ``docs``.

    Rows with an id up to ``boundary`` (default: the middle of the id range) are the
    history, the others the batch.  Texts are equal when they are so after each
    run of ASCII white space is one space; null text is empty.  The smallest id of
    a group stays; a null id stays only where the group has no other.  Rows that repeat
    id and text count each, and one of them stays.  An empty table gives no rows.  Other columns are
    ignored.
    """
    rows = docs.select(col(id_col).cast("long").alias("doc_id"),
                       F.unhex(F.sha2(normalised(col(text_col)), 256)).alias("digest"))
    rows = materialise(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n")), "exact-rows")
    seen = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    if boundary is None:
        boundary = (seen[0] + seen[1]) // 2 if seen[0] is not None else 0
    shards = max(1, -(-seen[2] // keys_per_shard))
    old = F.coalesce(F.col("doc_id") <= boundary, F.lit(False))
    digests = materialise(
        rows.groupBy("digest", old.alias("old"))
        .agg(F.min("doc_id").alias("first"), F.sum("n").alias("n"))
        .withColumn("shard", spread("digest", buckets=shards, seed=7)), "exact-digests")
    index = materialise(build_index(digests.filter("old")), "exact-index")
    groups = lookup(index, digests.filter("NOT old")).filter("group_size > 1")
    # the groups are written first, so both sides of the join are plain shuffles that
    # Spark can split where one digest has many rows
    groups = materialise(groups, "exact-groups")
    own = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (rows.join(groups, "digest", "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", keep.alias("keep_id"), own.alias("group_size"),
                    (F.col("doc_id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), old.alias("from_history")))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat id and text, the one whose columns have the smallest hash stays, the same on every run.
    """
    key = free_name(docs, "__row")
    keyed = docs.withColumn(key, F.concat_ws(
        ":", F.sha2(normalised(col(text_col)), 256), col(id_col).cast("string")))
    kept = exact_groups(docs, id_col, text_col, **options).filter("kept").select(
        F.concat_ws(":", "text_sha256", F.col("doc_id").cast("string")).alias(key))
    one = keyed.join(kept, key, "left_semi").groupBy(key).agg(
        F.min_by(F.struct(*(col(c) for c in docs.columns)), F.xxhash64(*(col(c) for c in docs.columns))).alias("row"))
    return one.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
