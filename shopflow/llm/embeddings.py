"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation learned on a bounded sample turns vectors into balanced binary codes.
Codes are cut into chunks; every set of ``agree`` chunks is a table, whose buckets
hold the vectors that agree in those chunks.  Their numbers are the cheapest that find enough partners
of the sampled vectors at the threshold (``scheme``), at every size of the table.  Inside a bucket the cosine of the original
vectors decides.  A pair counts in the first table where it meets, so nothing is counted
twice; a bucket gives each vector's number of links and its component, never its pairs.
Buckets over ``block`` vectors are cut into pairs of blocks, which all get compared.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, materialise
from shopflow.llm.graph import components

BITS = 64


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by their largest component first."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_rotation(sample: np.ndarray, rounds: int = 50, seed: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (to at most 64 directions) whose signs are balanced bits."""
    mean = sample.mean(axis=0)
    _, directions = np.linalg.eigh(np.cov(sample - mean, rowvar=False).reshape(len(mean), -1))
    directions = directions[:, ::-1][:, :BITS]
    flat = (sample - mean) @ directions
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(flat.shape[1],) * 2))[0]
    for _ in range(rounds):
        bits = np.where(flat @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(bits.T @ flat)
        rotation = (left @ right).T
    return mean, directions @ rotation


class Quantiser:
    """Codes of unit vectors; a length without sample gets a seeded random rotation."""

    def __init__(self, fitted: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.fitted = dict(fitted)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        n, d = vectors.shape
        if d not in self.fitted:
            axes = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0][:, :BITS]
            self.fitted[d] = np.zeros(d), axes
        mean, axes = self.fitted[d]
        bits = np.zeros((n, BITS), bool)
        bits[:, :axes.shape[1]] = (vectors - mean) @ axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def tables(chunks: int, agree: int) -> list[tuple[int, ...]]:
    return list(itertools.combinations(range(chunks), agree))


def partners(u: np.ndarray, cosine: float, seed: int = 11) -> list[np.ndarray]:
    """For each unit vector one at this cosine: off in any direction, and in one in which the vectors differ."""
    rng = np.random.default_rng(seed)
    out = []
    for off in (rng.normal(size=u.shape), u[rng.permutation(len(u))] - u[rng.permutation(len(u))]):
        off = off - (off * u).sum(axis=1, keepdims=True) * u
        off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-12)
        out.append(cosine * u + np.sqrt(max(0.0, 1 - cosine * cosine)) * off)
    return out


def scheme(u: np.ndarray, quantiser: Quantiser, threshold: float, rows: int, pairs: int,
           target: float = 0.998, row_cost: int = 600, most_tables: int = 200) -> tuple[int, int]:
    """(chunks, agree) of the least work for ``rows`` vectors in ``pairs`` comparable pairs, among those
    that let at least ``target`` of the vectors ``u`` meet their partners at the threshold.

    Chunks of one bit, one of which must agree, always do but for opposite codes.
    """
    bits, own = min(BITS, u.shape[1]), quantiser.codes(u).view(np.uint64)
    flips = [((own ^ quantiser.codes(v).view(np.uint64))[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
             for v in partners(u, threshold)]
    best = (float("inf"), (bits, 1))
    for chunks in range(1, bits + 1):
        width = bits // chunks
        same = [(~f[:, :chunks * width].reshape(len(u), chunks, width).any(axis=2)).sum(axis=1) for f in flips]
        for agree in range(1, chunks + 1):
            n = math.comb(chunks, agree)
            if n <= most_tables and min((x >= agree).mean() for x in same) >= target:
                best = min(best, (n * (row_cost * rows + pairs / 2 ** (agree * width)), (chunks, agree)))
    return best[1]


def chunk_values(code: np.ndarray, d: int, chunks: int) -> np.ndarray:
    """The chunks of the codes of vectors of length d, one column each."""
    width = min(BITS, d) // chunks
    return code.view(np.uint64)[:, None] >> np.arange(0, chunks * width, width, dtype=np.uint64) & np.uint64(
        (1 << width) - 1)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of a sorted partition, across its batches."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        change = np.zeros(len(table), bool)
        for k in keys:
            v = table[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        if held:
            change[0] = any(held[-1][k][-1] != table[k][0] for k in keys)
        starts = np.flatnonzero(change)
        first = int(starts[0]) if len(starts) else len(table)
        if first:
            held.append(table.slice(0, first))
        if len(starts):
            if held:
                yield pa.concat_tables(held)
            for a, b in zip(starts[:-1], starts[1:]):
                yield table.slice(a, b - a)
            held = [table.slice(starts[-1])]
    if held:
        yield pa.concat_tables(held)


def block_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component under the pairs a, b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", threshold: float = 0.98, sample: int = 4096,
                 lengths: int = 16, block: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Vectors link when their labels are equal and not null, their lengths equal and their cosine at
    least ``threshold``.  Null, zero and empty vectors, and those with a null or non-finite
    component, link with nothing.  Each row is a vector of its own, repeated rows and
    null ids too; component_id is null where no row of a component has an id.  An empty table gives
    no rows.  Other columns are ignored.  For each of the ``lengths`` most frequent vector lengths a rotation is fitted on about
    ``sample`` different vectors, those of the smallest hashes; other lengths, and those with fewer than 32 vectors, get a
    random rotation.  Every vector is indexed.  Vectors of d < 64 components have d bits, so short ones share
    buckets with many.
    """
    v = col(vector_col).cast("array<double>")
    usable = F.coalesce(_valid(v) & col(label_col).isNotNull(), F.lit(False))
    rows = vectors.select(col(id_col).cast("long").alias("vec_id"), F.when(usable, v).alias("v"),
                          F.when(usable, F.xxhash64(col(label_col), v)).alias("h1"),
                          F.when(usable, F.xxhash64(F.lit(1), v, col(label_col))).alias("h2"),
                          F.when(usable, col(label_col).cast("string")).alias("label"))
    rows = rows.withColumn("node", F.concat(F.hex("h1"), F.lit("."), F.hex("h2"))).drop("h1", "h2")
    # equal vectors are one node, so copies cost nothing
    nodes = materialise(rows.filter("node IS NOT NULL").groupBy("node", "label", "v").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first")), "vectors")

    work = nodes.groupBy(F.size("v").alias("d"), "label").agg(F.count("*").cast("double").alias("n")).groupBy("d").agg(
        F.sum("n"), F.sum(F.col("n") * F.col("n"))).collect()  # a row per vector length
    frequent = sorted(work, key=lambda r: (-r[1], r[0]))[:lengths]
    sampled: dict[int, np.ndarray] = {}
    if frequent:
        # hashes are even, so the share of the range below a bound is the share of the vectors
        bounds = F.create_map(*(F.lit(x) for d, n, _ in frequent
                                for x in (d, min((1 << 63) - 1, int(min(1.0, sample / n) * (1 << 63))))))
        low = F.xxhash64("node", F.lit(3)).bitwiseAND(F.lit((1 << 63) - 1)) <= F.element_at(bounds, F.size("v"))
        by_length: dict[int, list] = {}
        for r in sorted(nodes.filter(low).select("v").collect()):
            by_length.setdefault(len(r["v"]), []).append(r["v"])
        sampled = {d: unit(np.array(x)) for d, x in by_length.items() if len(x) >= 32}
    quantiser = Quantiser({d: fit_rotation(u) for d, u in sampled.items()})

    def typical(d: int) -> np.ndarray:
        return sampled[d] if d in sampled else unit(np.random.default_rng(d).normal(size=(1024, d)))

    schemes = {d: scheme(typical(d), quantiser, threshold, n, pairs) for d, n, pairs in work}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            length = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, at = lists.flatten().to_numpy(), np.cumsum(length) - length
            code, raw = np.zeros(len(batch), np.int64), [b""] * len(batch)
            values: list[np.ndarray] = [np.zeros(0, np.int64)] * len(batch)
            for d in np.unique(length):
                own = np.flatnonzero(length == d)
                u = unit(flat[at[own, None] + np.arange(d)])
                code[own] = quantiser.codes(u)
                chunks, agree = schemes[d]
                parts, width = chunk_values(code[own], d, chunks), np.uint64(min(BITS, d) // chunks)
                value = np.zeros((len(own), math.comb(chunks, agree)), np.uint64)
                for t, s in enumerate(tables(chunks, agree)):
                    for k, c in enumerate(s):
                        value[:, t] |= parts[:, c] << np.uint64(k) * width
                for i, x, y in zip(own, u, value.view(np.int64)):
                    raw[i], values[i] = x.tobytes(), y
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), batch.column("n"), pa.array(length.astype("i4")),
                 pa.array(code), pa.array(raw, pa.binary()), pa.array(values, pa.list_(pa.int64()))],
                names=["node", "label", "n", "d", "code", "u", "buckets"])

    coded = materialise(nodes.select("node", "label", "n", "v").mapInArrow(
        encode, "node string, label string, n long, d int, code long, u binary, buckets array<long>"), "codes")
    keys = F.transform("buckets", lambda value, t: F.struct(
        t.alias("t"), F.xxhash64(t, "label", "d", value).alias("k")))
    bucket = ["t", "k"]
    sizes = materialise(coded.select(F.inline(keys)).groupBy(bucket).agg(F.count("*").alias("size"))
                        .filter("size > 1"), "buckets")
    parts = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")).cast("int")
    members = (coded.select("node", "label", "d", "n", "code", "u", F.inline(keys)).join(sizes, bucket)
               .withColumn("parts", parts).withColumn("own", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select("t", "k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                       "own", "node", "label", "d", "n", "code", "u"))
    group = ["t", "k", "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = [], [], []
        for g in sorted_groups(batches, group):
            if len(g) < 2:
                continue
            code, n, own = (g[c].to_numpy() for c in ("code", "n", "own"))
            d, label = g["d"].to_numpy(), g["label"].to_pylist()
            if (d != d[0]).any():  # different lengths only meet here by equal hashes
                continue
            u = np.frombuffer(b"".join(g["u"].to_pylist()), float).reshape(len(g), -1)
            a, b = np.nonzero(np.triu(u @ u.T >= threshold, 1))
            if g["lo"][0] != g["hi"][0]:
                cross = own[a] != own[b]
                a, b = a[cross], b[cross]
            if not len(a):
                continue
            chunks, agree = schemes[d[0]]
            same = chunk_values(code[a], d[0], chunks) == chunk_values(code[b], d[0], chunks)
            order = np.argsort(~same, axis=1, kind="stable")[:, :agree]
            here = (order == np.array(tables(chunks, agree)[g["t"][0].as_py()], int)).all(axis=1)
            here &= np.array(label, object)[a] == np.array(label, object)[b]
            a, b = a[here], b[here]
            if not len(a):
                continue
            links = np.zeros(len(g), np.int64)
            np.add.at(links, a, n[b])
            np.add.at(links, b, n[a])
            node = g["node"].to_pylist()
            root = block_components(len(g), a, b)
            for i in np.flatnonzero(links):
                for column, value in zip(out, (node[i], node[root[i]], int(links[i]))):
                    column.append(value)
            if len(out[0]) > 10_000:
                yield pa.RecordBatch.from_pydict(dict(zip(("u", "v", "links"), out)))
                out = [], [], []
        if out[0]:
            yield pa.RecordBatch.from_pydict(dict(zip(("u", "v", "links"), out)))

    n_parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialise(members.repartition(n_parts, *group).sortWithinPartitions(*group).mapInArrow(
        compare, "u string, v string, links long"), "vector-links")
    counted = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.select("u", "v").distinct())
    placed = (nodes.select("node", "n", "first").join(materialise(counted, "link-counts"), "node", "left")
              .join(materialise(roots, "vector-roots"), "node", "left")
              .select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first",
                      F.coalesce("root", "node").alias("root")))
    placed = materialise(placed, "placed-vectors")
    least = materialise(placed.groupBy("root").agg(F.min("first").alias("component_id")), "vector-components")
    named = materialise(placed.join(least, "root").select("node", "n_links", "component_id"), "named-vectors")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", F.col("node")).join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
