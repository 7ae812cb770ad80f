"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of like size share a block.  A block holds one Bloom signature per document, stored by
slices: slice b is the bitmap of the documents whose signature has bit b.  A document's entries are
its terms, and for tf >= 2, 4, 8, ... the term with that power, so the AND of an entry's slices is a
bitmap that never misses a document with so many occurrences, and may hold some more.  The sum of the
query's weights over these bitmaps is an upper bound of every score in the block.  The ten best bounds
of an item are scored exactly; whatever document has a bound that could still reach the tenth of them
is scored exactly as well.  No document is left out for any other reason.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import col, free_name, materialise

#: bytes that are no part of a term become a space; only A-Z are lower-cased
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
LEVELS = 12  # powers of two that have entries; a larger tf is bounded by the document's length
HASHES = 5
_NEVER = np.iinfo(np.int64).max


class Terms(NamedTuple):
    """Distinct (document, term) pairs of a chunk with their tf, and each document's number of terms."""

    words: pa.Array
    doc: np.ndarray
    word: np.ndarray
    tf: np.ndarray
    n: np.ndarray


def split_terms(texts: pa.Array, chunk_bytes: int = 8 << 20) -> Iterator[tuple[int, Terms]]:
    """(first row, terms) of chunks of whole texts; null has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    texts = pa.concat_arrays([texts])
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    first = 0
    while first < len(texts):
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + chunk_bytes, "right")))
        yield first, _terms(texts.slice(first, last - first))
        first = last


def _terms(texts: pa.Array) -> Terms:
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = (data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes() if data else b"").translate(_FOLD)
    plain = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(at - at[0])), pa.py_buffer(raw))
    split = pc.ascii_split_whitespace(plain)
    coded = split.flatten().dictionary_encode()
    words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    starts = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    doc = np.repeat(np.arange(n), np.diff(starts))
    blank = pc.index(words, pa.scalar("", words.type)).as_py()
    if blank >= 0:  # at a text's ends
        doc, index = doc[index != blank], index[index != blank]
    size = max(len(words), 1)
    pairs, tf = np.unique(doc * size + index, return_counts=True)
    return Terms(words, pairs // size, pairs % size, tf, np.bincount(doc, minlength=n))


def entry_hashes(words: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w) for w in words), np.uint64, len(words))


def positions(hashes: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The slices of entries (term, power of two): one row per entry, ``bits`` a power of two."""
    h = hashes + np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


class Block:
    """Signatures of documents that need the same number of bits, until they are written as slices."""

    def __init__(self, bits: int):
        self.bits, self.keys, self.ids, self.sizes, self.at = bits, [], [], [], []

    def add(self, key: int, doc_id: int | None, n: int, at: np.ndarray) -> None:
        self.at.append(at.ravel() * 0x100000 + len(self.keys))
        self.keys.append(key)
        self.ids.append(doc_id)
        self.sizes.append(n)

    def full(self, block_bytes: int) -> bool:
        return len(self.keys) >= 2048 or len(self.keys) * self.bits >= 8 * block_bytes

    def row(self) -> tuple:
        at = np.concatenate(self.at)
        plane = np.zeros((self.bits, len(self.keys)), np.uint8)
        plane[at >> 20, at & 0xFFFFF] = 1
        return self.bits, self.keys, self.ids, self.sizes, np.packbits(plane, axis=1).tobytes()


INDEX = "bits int, keys array<long>, ids array<long>, sizes array<long>, slices binary, term string, df long"
_INDEX_TYPES = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
                pa.string(), pa.int64()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def scan(docs: DataFrame, watch: list[str], signatures: bool, bits_per_entry: int = 10,
         block_bytes: int = 2 << 20) -> DataFrame:
    """One pass over whole texts: blocks of signatures, and the documents that hold each watched term.

    ``docs`` has key, doc_id and text.  Documents without a term have no signature.
    """
    names = [c.split()[0] for c in INDEX.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, Block] = {}
        found = np.zeros(len(watch), np.int64)
        watched = pa.array(watch, pa.large_string())
        for batch in batches:
            for first, terms in split_terms(batch.column("text")):
                if len(watch):
                    slot = pc.fill_null(pc.index_in(terms.words, watched), -1).to_numpy(zero_copy_only=False)[terms.word]
                    found += np.bincount(slot[slot >= 0], minlength=len(watch))
                if signatures:
                    keys, ids = (batch.column(c).slice(first, len(terms.n)).to_pylist() for c in ("key", "doc_id"))
                    yield from sign(terms, keys, ids, open_blocks)
        for block in open_blocks.values():
            yield _batch([(*block.row(), None, None)], names, _INDEX_TYPES)
        yield _batch([(*[None] * 5, watch[i], int(found[i])) for i in np.flatnonzero(found)], names, _INDEX_TYPES)

    def sign(terms: Terms, keys: list, ids: list, open_blocks: dict[int, Block]) -> Iterator[pa.RecordBatch]:
        hashes = entry_hashes(terms.words.to_pylist())
        top = np.minimum(np.frexp(terms.tf)[1] - 1, LEVELS)  # floor of log2
        bounds = np.searchsorted(terms.doc, np.arange(len(terms.n) + 1))
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a == b:
                continue
            times = top[a:b] + 1
            level = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            bits = max(256, 1 << int(len(level) * bits_per_entry - 1).bit_length())
            block = open_blocks.setdefault(bits, Block(bits))
            block.add(keys[i], ids[i], int(terms.n[i]), positions(np.repeat(hashes[terms.word[a:b]], times), level, bits))
            if block.full(block_bytes):
                yield _batch([(*open_blocks.pop(bits).row(), None, None)], names, _INDEX_TYPES)

    return docs.select("key", "doc_id", "text").mapInArrow(read, INDEX)


class Law(NamedTuple):
    """The score of a term: integers throughout but for the weight's logarithm."""

    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def size(self, n: np.ndarray) -> np.ndarray:
        return 100 - 75 + (75 * n * self.documents) // max(self.terms, 1)

    @staticmethod
    def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items(NamedTuple):
    """A block of items: their terms that some document holds, by item, and the terms' weights."""

    numbers: list[int]
    terms: list[str]
    starts: np.ndarray  # of an item's terms in term and weight
    term: np.ndarray
    weight: np.ndarray  # times the term's repeats in the item

    def of(self, i: int) -> slice:
        return slice(int(self.starts[i]), int(self.starts[i + 1]))


def upper_bounds(row: dict, items: Items, hashes: np.ndarray, law: Law, terms_at_once: int = 1024) -> np.ndarray:
    """Items x documents of one index row: no score is larger."""
    bits, sizes = row["bits"], np.array(row["sizes"], np.int64)
    slices = np.frombuffer(row["slices"], np.uint8).reshape(bits, -1)
    m, n_docs = law.size(sizes), len(sizes)
    best = [law.part(np.minimum(np.int64((2 << level) - 1), sizes) if level < LEVELS else sizes, m).astype(np.float64)
            for level in range(LEVELS + 1)]
    out = np.zeros((len(items.numbers), n_docs))
    owner = np.repeat(np.arange(len(items.numbers)), np.diff(items.starts))
    by_term = np.argsort(items.term, kind="stable")
    for a in range(0, len(items.terms), terms_at_once):
        part = np.zeros((min(terms_at_once, len(items.terms) - a), n_docs))
        live, level = np.arange(len(part)), 0
        bitmap = np.bitwise_and.reduce(slices[positions(hashes[a:a + len(part)], 0, bits)], axis=1)
        while True:
            some = bitmap.any(axis=1)
            live, bitmap = live[some], bitmap[some]
            if not len(live):
                break
            t, d = np.nonzero(np.unpackbits(bitmap, axis=1, count=n_docs))
            part[live[t], d] = best[level][d]
            level += 1
            if level > LEVELS:
                break
            # an entry with a higher power is there only beside the lower ones
            bitmap = bitmap & np.bitwise_and.reduce(slices[positions(hashes[a + live], level, bits)], axis=1)
        uses = by_term[np.searchsorted(items.term, a, sorter=by_term):
                       np.searchsorted(items.term, a + len(part), sorter=by_term)]
        uses = np.sort(uses)  # by item again
        uses = uses[part.any(axis=1)[items.term[uses] - a]]
        if len(uses):
            first = np.flatnonzero(np.concatenate([[True], owner[uses][1:] != owner[uses][:-1]]))
            for i, j in zip(first.tolist(), [*first[1:].tolist(), len(uses)]):
                use = uses[i:j]  # sums of integers below 2 ** 53: exact
                out[owner[use[0]]] += items.weight[use] @ part[items.term[use] - a]
    return out


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = 10, items_at_once: int = 1024,
           item_bytes: int = 4 << 20) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score; equal scores by ascending doc_id.

    Items go through the index in blocks of at most ``items_at_once`` items and about ``item_bytes`` of
    text.  Documents with score 0 are left out, so null, empty and term-free texts never appear, nor do
    items without a term.  Repeated rows of documents are documents of their own; null ids come last
    among equals.  Repeated rows of items count once; one item id with several texts is ranked for each.
    An empty table on either side gives no row; other columns are ignored.
    """
    rows = docs.select(F.xxhash64(col(id_col), col(text_col)).alias("key"), col(id_col).cast("long").alias("doc_id"),
                       col(text_col).alias("text"))
    asked = items.select(col(item_col).cast("long").alias("item_id"),
                         col(item_text_col).alias("text")).filter("text IS NOT NULL").distinct()
    # blocks by a running sum over fixed-size groups of a hash order would need a sort; a hash deals them evenly
    count, size, longest = asked.agg(F.count("*"), F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    blocks = max(1, -(-count // items_at_once), -(-(size or 0) // item_bytes))
    asked = materialise(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "search-items")
    found, index = [], None
    for block in range(blocks):
        questions = [(r["item_id"], r["text"]) for r in asked.filter(F.col("block") == block).collect()]
        questions.sort(key=lambda q: (q[0] is None, q[0] or 0, q[1]))
        wanted = _item_terms([t for _, t in questions])
        vocabulary = sorted({t for own in wanted for t in own})
        pass_ = materialise(scan(rows, vocabulary, signatures=index is None), "search-index")
        if index is None:
            index = pass_.filter("bits IS NOT NULL").select("bits", "keys", "ids", "sizes", "slices")
            totals = index.select(F.explode("sizes").alias("n")).agg(F.count("*"), F.sum("n")).first()
            law = Law(totals[0], totals[1] or 0)
        df = {r["term"]: r["df"] for r in pass_.filter("term IS NOT NULL").groupBy("term").agg(
            F.sum("df").alias("df")).collect()}  # at most one row per term of this block's items
        found.append(_ranked(rows, index, questions, wanted, df, law, top))
    out = found[0]
    for other in found[1:]:
        out = out.unionAll(other)
    return out


def _item_terms(texts: list[str]) -> list[dict[str, int]]:
    own: list[dict[str, int]] = [{} for _ in texts]
    for first, terms in split_terms(pa.array(texts, pa.string())):
        words = terms.words.to_pylist()
        for d, w, tf in zip(terms.doc.tolist(), terms.word.tolist(), terms.tf.tolist()):
            own[first + d][words[w]] = tf
    return own


def _ranked(rows: DataFrame, index: DataFrame, questions: list, wanted: list[dict[str, int]], df: dict[str, int],
            law: Law, top: int) -> DataFrame:
    weight = {t: law.weight(n) for t, n in df.items()}
    terms = sorted(t for t, w in weight.items() if w > 0)
    slot = {t: i for i, t in enumerate(terms)}
    pairs = [[(slot[t], weight[t] * k) for t, k in sorted(own.items()) if t in slot] for own in wanted]
    flat = [p for own in pairs for p in own]
    items = Items(list(range(len(questions))), terms, np.cumsum([0] + [len(own) for own in pairs]),
                  np.array([p[0] for p in flat], np.int64), np.array([p[1] for p in flat], np.float64))
    item_ids = [q[0] for q in questions]

    def bounds(limit: list[tuple[float, int]] | None):
        """Without ``limit`` each block's best ``top`` of each item; with it, all that may reach it."""
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = entry_hashes(terms)
            for batch in batches:
                for row in batch.to_pylist():
                    ub = upper_bounds(row, items, hashes, law)
                    keys = np.array(row["keys"], np.int64)
                    ids = np.array([_NEVER if i is None else i for i in row["ids"]], np.int64)
                    out: list[list] = []
                    for i, bound in enumerate(ub):
                        if limit is None:
                            hits = np.flatnonzero(bound)
                            hits = hits[np.lexsort((ids[hits], -bound[hits]))[:top]]
                        else:
                            score, doc_id = limit[i]
                            hits = np.flatnonzero((bound > score) | ((bound == score) & (bound > 0) & (ids <= doc_id)))
                        out.append(hits)
                    size = [len(h) for h in out]
                    hit = np.concatenate(out) if out else np.zeros(0, np.int64)
                    item = np.repeat(np.arange(len(out), dtype=np.int32), size)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item), pa.array(keys[hit]), pa.array(ids[hit]),
                         pa.array(ub[item, hit].astype(np.int64))], names=["item", "key", "doc_id", "bound"])
        return index.mapInArrow(read, "item int, key long, doc_id long, bound long")

    def rescored(candidates: DataFrame) -> DataFrame:
        """Exact scores of (item, key) pairs; a key that more rows share only adds rows to score."""
        by_doc = materialise(candidates.groupBy("key").agg(F.collect_set("item").alias("items")), "search-candidates")
        return rows.join(by_doc, "key").select("doc_id", "text", "items").mapInArrow(
            score, "item int, doc_id long, score long")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(terms, pa.large_string())
        for batch in batches:
            doc_ids, wanted_items = batch.column("doc_id").to_pylist(), batch.column("items").to_pylist()
            for first, found in split_terms(batch.column("text")):
                at = pc.fill_null(pc.index_in(found.words, vocabulary), -1).to_numpy(zero_copy_only=False)[found.word]
                own = at >= 0
                doc, at, tf = found.doc[own], at[own], found.tf[own]
                part = law.part(tf, law.size(found.n)[doc])
                edges = np.searchsorted(doc, np.arange(len(found.n) + 1)).tolist()
                out, value = [], np.zeros(len(terms), np.int64)
                for d in range(len(found.n)):
                    here = slice(edges[d], edges[d + 1])
                    value[at[here]] = part[here]
                    for i in wanted_items[first + d]:
                        use = items.of(i)
                        total = int(items.weight[use].astype(np.int64) @ value[items.term[use]])
                        if total > 0:
                            out.append((i, doc_ids[first + d], total))
                    value[at[here]] = 0
                yield _batch(out, ["item", "doc_id", "score"], [pa.int32(), pa.int64(), pa.int64()])

    def best(scored: DataFrame, by: str) -> DataFrame:
        order = Window.partitionBy("item").orderBy(F.desc(by), F.asc_nulls_last("doc_id"))
        return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    first = best(bounds(None), "bound").select("item", "key")
    tenth = best(rescored(first), "score").filter(F.col("rank") == top).collect()  # at most one row per item
    limit = [(0.0, _NEVER)] * len(questions)
    for r in tenth:
        limit[r["item"]] = (float(r["score"]), _NEVER if r["doc_id"] is None else r["doc_id"])
    final = best(rescored(bounds(limit).select("item", "key")), "score")
    # item numbers to ids: a bounded array of this block's items
    return final.select(F.element_at(F.array(*(F.lit(i).cast("long") for i in item_ids)) if item_ids else F.array(
        F.lit(None).cast("long")), F.col("item") + 1).alias("item_id"),
        F.col("rank").cast("int").alias("rank"), "doc_id", "score")
