"""Conversation prefix trie, built as a burst trie.

Equal rebuilt conversations are one weighted sequence of turn ids.  All sequences start in the container
of the root.  A container with more turns than ``container_turns`` bursts: its trie nodes become heads
and its sequences go to containers by their next turn ids, one level first, then two, four, ..., so a
long shared beginning takes few rounds.  The other containers are sorted by suffix and swept once with a
stack into nodes, and heads add up what their containers and the heads below them hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import col, materialise

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
_SWEPT = NODE + ", path array<string>, sizes array<long>"
_ROOT, _NO_ENDS = "0" * 32, hashlib.sha256(b"").hexdigest()


def _key(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 32)


def rebuild(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            family: int = 5, shared: int = 9) -> DataFrame:
    """Every conversation as ``ids`` and ``sizes`` of its turns, with a beginning of its family's first one.

    Conversation c starts with the first crc32(c) % ``shared`` turns of conversation c - c % ``family`` and goes
    on with its own after as many.
    """
    own = turns.filter(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv_id"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    own = own.select(
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"), "conv_id",
        F.struct(F.col("turn").isNotNull().alias("timed"), "turn",
                 _key(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("id"),
                 F.octet_length("text").cast("long").alias("size")).alias("turn"))
    # one shuffle: what is dealt by base is dealt by (base, conversation) as well
    whole = own.repartition("base").groupBy("base", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, shared - 1))).over(
        Window.partitionBy("base"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    whole = whole.select("conv_id", "turns", first.alias("first"), taken.alias("h"))
    rest = F.expr("slice(turns, h + 1, greatest(size(turns), 1))")
    whole = whole.select("conv_id", F.concat(
        F.coalesce(F.expr("slice(first, 1, h)"), F.expr("slice(turns, 1, 0)")), rest).alias("turns"))
    return whole.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


def _hash_ends(rebuilt: DataFrame) -> DataFrame:
    """The SHA-256 of each sequence's ascending conversation ids; a hash is sequential, so the ids of one
    sequence are joined to text in many tasks, and one task only streams that text."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
                if seq == current:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = seq, hashlib.sha256(ids.encode())
            yield out(done)
        yield out([] if state is None else [(current, state.hexdigest())])

    def out(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)],
                                          names=["seq", "ends"])

    parts = rebuilt.groupBy("seq", F.floor(F.col("conv_id") / 4096).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    return parts.repartition("seq").sortWithinPartitions("seq", "part").select("seq", "ids").mapInArrow(
        stream, "seq string, ends string")


def _extended(step: int | None) -> Column:
    """The path with the keys of the next ``step`` levels, or of all that are left."""
    more = F.expr(f"slice(ids, depth + 1, {step or 'greatest(size(ids), 1)'})")
    return F.aggregate(more, F.col("path"), lambda path, i: F.array_append(
        path, _key(F.concat(F.element_at(path, -1), i))))


def burst(sequences: DataFrame, container_turns: int) -> tuple[DataFrame, list[DataFrame]]:
    """(sequences with the path of their container, sequences that end at a head).

    ``path`` has the keys of the prefixes from the root down to the container, or to the head.
    """
    waiting = sequences.withColumns({"path": F.array(F.lit(_ROOT)), "depth": F.lit(0)})
    closed, ended, step = [], [], 1
    while True:
        head = F.element_at("path", -1)
        load = F.sum(F.greatest(F.size("ids") - F.col("depth"), F.lit(1)).cast("long"))
        heavy = materialise(waiting.groupBy(head.alias("head")).agg(load.alias("load")).filter(
            F.col("load") > container_turns).select("head"), "trie-heavy")
        if heavy.isEmpty():
            break
        marked = materialise(waiting.withColumn("head", head).join(
            heavy.withColumn("heavy", F.lit(True)), "head", "left").drop("head"), "trie-round")
        closed.append(marked.filter("heavy IS NULL").drop("heavy"))
        bursting = marked.filter("heavy").drop("heavy")
        reaches = F.size("ids") >= F.col("depth") + step
        ended.append(bursting.filter(~reaches).withColumn("path", _extended(None)))
        waiting = materialise(bursting.filter(reaches).withColumn("path", _extended(step)).withColumn(
            "depth", F.col("depth") + step), "trie-containers")
        step *= 2
    for part in closed:
        waiting = waiting.unionAll(part)
    return waiting, ended


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers that come whole and sorted; a container's nodes are held until it ends."""
    N, CONV, CHILDREN, LEAVES, SAVED, ENDS, SIZE, DEPTH, PARENT = range(9)
    types = [*[pa.int64()] * 7, pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]
    names = [c.split()[0] for c in _SWEPT.split(", ")]
    nodes: list[list] = []
    stack: list[list] = []
    path: list[str] | None = None
    top_sizes: list[int] = []
    before: list[str] = []

    def pop() -> None:
        node = stack.pop()
        if not node[CHILDREN]:
            node[LEAVES] = 1
        node[SAVED] += (node[N] - 1) * node[SIZE]
        if stack:
            parent = stack[-1]
            parent[N] += node[N]
            parent[CONV] = node[CONV] if parent[CONV] is None else min(parent[CONV], node[CONV])
            parent[CHILDREN] += 1
            parent[LEAVES] += node[LEAVES]
            parent[SAVED] += node[SAVED]

    def push(depth: int, size: int) -> None:
        node = [0, None, 0, 0, 0, _NO_ENDS, size, depth, stack[-1] if stack else None]
        stack.append(node)
        nodes.append(node)

    def finish() -> pa.RecordBatch:
        while stack:
            pop()
        columns = [[n[CONV] for n in nodes], [n[DEPTH] for n in nodes],
                   [n[PARENT][CONV] if n[PARENT] else None for n in nodes], *([n[k] for n in nodes] for k in (
                       N, CHILDREN, LEAVES, SAVED, ENDS)),
                   [None if n[PARENT] else path for n in nodes], [None if n[PARENT] else top_sizes for n in nodes]]
        nodes.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            ids, sizes, depth = row["ids"], row["sizes"], row["depth"]
            if path is None or row["path"][-1] != path[-1]:
                if path is not None:
                    yield finish()
                path, top_sizes, before = row["path"], sizes[:depth], ids[:depth]
                push(depth, sizes[depth - 1] if depth else 0)
            common = depth
            while common < min(len(ids), len(before)) and ids[common] == before[common]:
                common += 1
            while stack[-1][DEPTH] > common:
                pop()
            for d in range(common, len(ids)):
                push(d + 1, sizes[d])
            end = stack[-1]
            end[N] += row["n"]
            end[CONV] = row["conv_id"] if end[CONV] is None else min(end[CONV], row["conv_id"])
            end[ENDS] = row["ends"]
            before = ids
    if path is not None:
        yield finish()


def nodes(rebuilt: DataFrame, container_turns: int = 4096) -> DataFrame:
    """The trie's nodes over ``rebuilt`` (conv_id, ids, sizes)."""
    rebuilt = materialise(rebuilt.withColumn("seq", F.sha2(F.array_join("ids", ""), 256)), "trie-rebuilt")
    same = rebuilt.groupBy("seq").agg(F.first("ids").alias("ids"), F.first("sizes").alias("sizes"),
                                      F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    sequences = materialise(same.join(_hash_ends(rebuilt), "seq").drop("seq"), "trie-sequences")
    contained, ended = burst(sequences, container_turns)
    swept = contained.withColumn("head", F.element_at("path", -1)).repartition("head").sortWithinPartitions(
        "head", "ids").drop("head").mapInArrow(_sweep, _SWEPT)
    columns = [c.split()[0] for c in NODE.split(", ")]
    if not ended:  # the root never burst
        return swept.select(*columns)
    swept = materialise(swept, "trie-swept")
    below = swept.filter("path IS NULL").select(*columns)
    tops = swept.filter("path IS NOT NULL").withColumn("parent", F.expr("path[size(path) - 2]"))

    def passed(source: DataFrame, levels: str, direct: Column, ends: Column, children: int, leaves: str, saved: str):
        """A row for each head above (or at) the source: what it counts there."""
        at = source.select("*", F.posexplode(F.expr(f"slice(path, 1, {levels})")).alias("e", "key"))
        here = direct & (F.col("e") == F.expr(levels) - 1)
        zero = F.lit(0).cast("long")
        return at.select(
            "key", F.expr("if(e > 0, path[e - 1], null)").alias("up"), F.col("e").cast("long").alias("depth"),
            F.expr("if(e > 0, sizes[e - 1], 0L)").alias("size"), "n_convs", "conv_id",
            F.when(here, F.lit(children).cast("long")).otherwise(zero).alias("children"),
            F.when(here, F.expr(leaves)).otherwise(zero).alias("leaves"),
            F.when(here, F.expr(saved)).otherwise(zero).alias("saved"),
            F.when(F.col("e") == F.expr(levels) - 1, ends).alias("ends"))

    found = passed(tops, "size(path) - 1", F.lit(True), F.lit(None).cast("string"), 1, "n_leaves", "saved_tokens")
    for part in ended:
        found = found.unionAll(passed(part.withColumnRenamed("n", "n_convs"), "size(path)", F.lit(False), F.col("ends"),
                                      0, "0L", "0L"))
    heads = materialise(found.groupBy("key").agg(
        F.max("up").alias("up"), F.max("depth").alias("depth"), F.max("size").alias("size"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")), "trie-heads")
    child_heads = heads.filter("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("more"))
    heads = heads.join(child_heads, "key", "left").withColumn(
        "children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more")
    heads = materialise(heads.withColumns({
        "leaves": F.col("leaves") + (F.col("children") == 0).cast("long"),
        "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("size")}), "trie-own")
    # sums over subtrees of heads: in round j each head adds the sums of the heads 2 ** j levels below it
    sums = heads.select("key", "up", "leaves", "saved")
    for _ in range(int(heads.agg(F.max("depth")).first()[0] or 0).bit_length()):
        lower = sums.filter("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = sums.select(F.col("key").alias("up"), F.col("up").alias("next"))
        sums = materialise(sums.join(lower, "key", "left").join(above, "up", "left").select(
            "key", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-sums")
    above = heads.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    upper = heads.drop("leaves", "saved").join(sums.drop("up"), "key").join(above, "up", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"))
    tops = tops.drop("parent_conv_id").join(above.withColumnRenamed("up", "parent"), "parent", "left").select(*columns)
    return upper.unionByName(below).unionByName(tops)


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                container_turns: int = 4096) -> DataFrame:
    """Nodes of the trie over rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Null roles and texts are empty, null turns come first, equal turn numbers follow their turn's hash, and
    repeated rows are turns of their own.  Rows without conversation id belong to none.  An empty
    table has no node, not even a root; other columns are ignored.  A conversation is one row (32 bytes
    a turn); any number of conversations may be equal or share a beginning.
    """
    return nodes(rebuild(turns, conv, turn, role, text), container_turns)
