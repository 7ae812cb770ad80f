"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window.

A document longer than a window fills windows of its own; what is left of it (less
than a window) goes to a shard of about ``rows_per_shard`` documents.  Documents are dealt
by content, so that related ones meet at any size: each has keys (the smallest hashes of its
runs of eight ids, and its most telling terms), and goes with those that share one.
Each shard holds a BM25 inverted index of its whole documents, with the document
frequencies and the mean length of all documents.  The first unused
document seeds a window, its best-scored unused neighbours fill it, and the last one
is cut at the window's end, so windows are full.  What a shard has left over
at its end is cut into sequences with power-of-two lengths, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, materialise, spread
from shopflow.llm.tokens import encoder, ids_crc32, vocabulary_path

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")
RUN, RUN_KEYS, TELLING = 8, 16, 3  # ids of a run, run keys and telling terms of a document

Counted = tuple[np.ndarray, np.ndarray]  # a document's different terms and how often it has each


def counted(ids: np.ndarray) -> Counted:
    ids = np.sort(ids)
    at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
    return ids[at[:-1]], np.diff(at)


def counted_all(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``counted`` of documents that lie one after the other, by one sort: terms, counts, and where each document's begin."""
    n = len(sizes)
    wide, shift = (np.uint32, 16) if ids.itemsize == 2 and n <= 1 << 16 else (np.uint64, 32)
    keys = np.repeat(np.arange(n, dtype=wide) << wide(shift), sizes) | ids.astype(wide)
    keys.sort()
    at = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1], [len(keys) > 0]]))
    keys = keys[at[:-1]]
    edges = np.concatenate([[0], np.cumsum(np.bincount((keys >> wide(shift)).astype(np.int64), minlength=n))])
    return (keys & wide((1 << shift) - 1)).astype(np.uint32), np.diff(at), edges


def counted_each(docs: list[np.ndarray | Counted]) -> list[Counted]:
    """(terms, counts) of each document, which is its ids or has them already."""
    raw = [d for d in docs if not isinstance(d, tuple)]
    terms, tf, edges = counted_all(np.concatenate(raw) if raw else np.zeros(0, np.uint16),
                                   np.array([len(d) for d in raw], np.int64))
    own = iter([(terms[a:b], tf[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())])
    return [d if isinstance(d, tuple) else next(own) for d in docs]


class Corpus(NamedTuple):
    """Mean length of all documents, and each term's number of documents and idf."""

    mean: float
    df: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, n: int, mean: float, df: np.ndarray) -> Corpus:
        return cls(mean, df, np.log((n - df + 0.5) / (df + 0.5) + 1))

    def weight(self, terms: np.ndarray, tf: np.ndarray, size: np.ndarray | int, k1: float = 1.2,
               b: float = 0.75) -> np.ndarray:
        """BM25 weight of terms in documents of ``size`` ids."""
        return self.idf[terms] * tf * (k1 + 1) / (tf + (k1 * (1 - b) + k1 * b / max(self.mean, 1) * size))


def run_hashes(ids: np.ndarray) -> np.ndarray:
    """A hash of the run of ``RUN`` ids that begins at each place."""
    if len(ids) < RUN:
        return np.zeros(0, np.uint64)
    step = 8 // ids.itemsize  # ids in 64 bits
    h = np.ndarray(len(ids) - step + 1, "<u8", np.ascontiguousarray(ids), strides=ids.itemsize)
    while step < RUN:  # hashes of runs of twice the length
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        step *= 2
    return h ^ (h >> np.uint64(32))


def run_keys(h: np.ndarray) -> np.ndarray:
    """The ``RUN_KEYS`` smallest of a document's run hashes, as odd numbers."""
    if not len(h):
        return h.view(np.int64)
    h = np.sort(np.partition(h, RUN_KEYS - 1)[:RUN_KEYS] if len(h) > RUN_KEYS else h) | np.uint64(1)
    return h[np.concatenate([[True], h[1:] != h[:-1]])].view(np.int64)


def term_keys(terms: np.ndarray, weight: np.ndarray) -> list[int]:
    """The terms of the largest weights over 0 and their pairs; even numbers."""
    at = np.argsort(-weight, kind="stable")[:TELLING]
    top = sorted(terms[at[weight[at] > 0]].tolist())
    pairs = [(a + 1 << 32 | b + 1) << 1 for i, a in enumerate(top) for b in top[i + 1:]]
    return [t + 1 << 1 for t in top] + pairs


class Bm25Index:
    """Inverted index over documents: arrays of ids, or (terms, counts) of whole documents.

    ``corpus`` has the statistics of all documents; without it, these are all.
    """

    def __init__(self, docs: list[np.ndarray | Counted], corpus: Corpus | None = None):
        self.n = n = len(docs)
        pairs = counted_each(docs)
        sizes = np.array([tf.sum() for _, tf in pairs], np.int64)
        term = np.concatenate([t for t, _ in pairs]) if n else np.zeros(0, np.uint16)
        tf = np.concatenate([k for _, k in pairs]) if n else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(n, dtype=np.min_scalar_type(n)), [len(t) for t, _ in pairs])
        corpus = corpus or Corpus.of(n, float(sizes.mean()) if n else 0.0, np.bincount(term))
        order = np.argsort(term, kind="stable")
        self.doc, term = doc[order], term[order]
        self.weight = corpus.weight(term, tf[order], sizes[self.doc])
        at = np.flatnonzero(np.concatenate([[len(term) > 0], term[1:] != term[:-1], [len(term) > 0]]))
        self.first, self.end, df = at[:-1], at[1:], np.diff(at)
        slot = np.repeat(np.arange(len(df)), df)
        shared = np.flatnonzero((df > 1)[slot])  # a term of one document has no neighbour
        shared = shared[np.argsort(self.doc[shared], kind="stable")]
        self.terms_of = slot[shared]
        self.bounds = np.searchsorted(self.doc[shared], np.arange(n + 1))
        # postings of frequent terms are rows over all documents, as many as fit 64 MB
        frequent = np.flatnonzero((df > 1) & (df >= n / 8))
        frequent = frequent[np.argsort(-df[frequent], kind="stable")][:(1 << 24) // max(n, 1)]
        self.row = np.full(len(df), -1)
        self.row[frequent] = np.arange(len(frequent))
        at = np.flatnonzero((self.row >= 0)[slot])
        self.rows = np.zeros((len(frequent), n), np.float32)
        self.rows[self.row[slot[at]], self.doc[at]] = self.weight[at]

    def neighbours(self, i: int) -> np.ndarray:
        """Documents by falling BM25 score for all terms of document i."""
        query = self.terms_of[self.bounds[i]:self.bounds[i + 1]]
        if not len(query):
            return query
        row = self.row[query]
        score = self.rows[row[row >= 0]].sum(axis=0).astype(float)
        rare = query[row < 0]
        if len(rare):
            spans = [slice(a, b) for a, b in zip(self.first[rare].tolist(), self.end[rare].tolist())]
            score += np.bincount(np.concatenate([self.doc[s] for s in spans]),
                                 np.concatenate([self.weight[s] for s in spans]), self.n)
        score[i] = 0
        hits = np.flatnonzero(score)
        return hits[np.argsort(-score[hits], kind="stable")]


def fill(docs: list[np.ndarray], window: int,
         owners: list[int | None] | None = None, index: Bm25Index | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, from, to) over all ids of the documents.

    Copies of one owner (not None) come into a sequence only when nothing else is left: a copy would
    be the best match of itself, and fill the window with repeats.
    """
    index, used, lengths = index or Bm25Index(docs), [0] * len(docs), [len(d) for d in docs]
    owners = owners or [None] * len(docs)
    left, seed = sum(lengths), 0
    while left >= window:
        while used[seed] == lengths[seed]:
            seed += 1
        sequence, room, present = [], window, set()
        near = index.neighbours(seed).tolist()
        later = range(seed + 1, len(docs))
        for source, repeats in (([seed], True), (near, False), (later, False), (later, True)):
            for i in source:
                if not room:
                    break
                if used[i] < lengths[i] and (repeats or owners[i] not in present):
                    n = min(room, lengths[i] - used[i])
                    sequence.append((i, used[i], used[i] + n))
                    used[i] += n
                    room -= n
                    if owners[i] is not None:
                        present.add(owners[i])
            if not room:
                break
        left -= window
        yield sequence
    room, sequence = (1 << left.bit_length() - 1) if left else 0, []
    for i, length in enumerate(lengths):  # the rest: binary digits of its length
        while used[i] < length:
            n = min(room, length - used[i])
            sequence.append((i, used[i], used[i] + n))
            used[i] += n
            room -= n
            left -= n
            if not room:
                yield sequence
                room, sequence = (1 << left.bit_length() - 1) if left else 0, []


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         end_id: int = 2, window: int = 4096, rows_per_shard: int = 1024) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text is empty (the end id alone).  Every row is packed, repeated rows and null
    ids too; an empty table gives no piece; other columns are ignored.  A shard holds
    about ``rows_per_shard`` remainders of less than ``window`` ids each, whatever the texts' lengths;
    a group of related documents that is larger than a quarter of that is spread over several shards.
    """
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(vocabulary)
        df = np.zeros(max(model.model.get_vocab_size(), end_id + 1), np.int64)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, ids, offsets in model.encode(batch.column("text")):
                out: list[tuple] = []
                doc_ids = batch.column("doc_id").slice(first, len(offsets) - 1).to_pylist()
                ids = np.insert(ids, offsets[1:], end_id)
                edges = (offsets + np.arange(len(offsets))).tolist()
                runs = run_hashes(ids)
                all_terms, all_tf, at = counted_all(ids, np.diff(edges))
                at = at.tolist()
                df += np.bincount(all_terms, minlength=len(df))
                for k, (doc_id, a, b) in enumerate(zip(doc_ids, edges[:-1], edges[1:])):
                    own = ids[a:b]
                    full = len(own) // window * window
                    terms, tf = all_terms[at[k]:at[k + 1]], all_tf[at[k]:at[k + 1]]
                    crcs = [ids_crc32(own[s:s + window]) for s in range(0, full, window)]
                    out.append((row, doc_id, len(own), crcs,
                                own[full:].tobytes(),
                                terms.astype("<u4").tobytes() if full else None,
                                tf.astype("<u4").tobytes() if full else None,
                                run_keys(runs[a:max(a, b - RUN + 1)]), None, None))
                    row += 1
                if out:
                    yield batch_of(out)
        seen = np.flatnonzero(df)
        yield batch_of([(*[None] * 8, t, k) for t, k in zip(seen.tolist(), df[seen].tolist())])

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = ["row", "doc_id", "doc_tokens", "crcs", "ids", "terms", "tf", "keys", "term", "df"]
    kinds = [*[pa.int64()] * 3, pa.list_(pa.int64()), *[pa.binary()] * 3, pa.list_(pa.int64()), *[pa.int64()] * 2]
    cut = materialise(rows.mapInArrow(
        tokenise, "row long, doc_id long, doc_tokens long, crcs array<long>, ids binary, terms binary, tf binary, "
                  "keys array<long>, term long, df long"), "packing-ids")
    whole = cut.filter("row IS NOT NULL").drop("term", "df")
    n, mean = whole.agg(F.count("*"), F.avg("doc_tokens")).first()
    # at most as many rows as the vocabulary has terms
    found = cut.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(max((r["term"] for r in found), default=0) + 1, np.int64)
    for r in found:
        df[r["term"]] = r["df"]
    corpus = Corpus.of(n, mean or 0.0, df)
    width = "<u4" if encoder(vocabulary).dtype.itemsize > 2 else "<u2"
    shards = max(1, -(-n // rows_per_shard))

    def terms_of(ids: bytes, terms: bytes | None, tf: bytes | None) -> np.ndarray | Counted:
        if terms is None:
            return np.frombuffer(ids, width)
        return np.frombuffer(terms, "<u4"), np.frombuffer(tf, "<u4").astype(np.int64)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("doc_tokens").to_numpy()
            pairs = counted_each([terms_of(*d) for d in zip(*(batch.column(c).to_pylist() for c in ("ids", "terms", "tf")))])
            term = np.concatenate([t for t, _ in pairs]) if pairs else np.zeros(0, np.int64)
            weight = corpus.weight(term, np.concatenate([k for _, k in pairs]) if pairs else term,
                                   np.repeat(sizes, [len(t) for t, _ in pairs]))
            weight[corpus.df[term] < 2] = 0  # a term of one document tells nothing
            edges = np.cumsum([0] + [len(t) for t, _ in pairs]).tolist()
            keys = [term_keys(term[a:b], weight[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(keys, pa.list_(pa.int64())), batch.column("keys")],
                names=["row", "by_term", "by_run"])

    if shards == 1:
        dealt = whole.withColumn("shard", F.lit(0))
    else:
        part = max(2, rows_per_shard // 4)
        keyed = materialise(whole.select("row", "ids", "terms", "tf", "doc_tokens", "keys").mapInArrow(
            key, "row long, by_term array<long>, by_run array<long>"), "packing-keys")
        keyed = keyed.select("row", F.explode(F.concat("by_run", "by_term")).alias("key"))
        # written first, so that Spark can split the hot side of their joins
        often = materialise(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "packing-often")
        # the commonest run that fits a part, else the commonest terms that do, else the rarest key of all; as one
        # number (fits, run, how often, a hash of the key for ties), which a hash aggregate can hold
        most = (1 << 30) - 1
        often_bits = F.least(F.col("n"), F.lit(most))
        rank = F.when(F.col("n") <= part, (1 << 62) + F.shiftleft(F.col("key").bitwiseAND(F.lit(1)), 61)
                      + F.shiftleft(often_bits, 31)).otherwise(F.shiftleft(most - often_bits, 31))
        rank = rank + F.xxhash64("key").bitwiseAND(F.lit((1 << 31) - 1))
        chosen = materialise(keyed.join(often, "key").groupBy("row").agg(F.max_by("key", rank).alias("key")),
                             "packing-groups")
        parts = materialise(chosen.groupBy("key").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")),
                            "packing-parts")
        salted = chosen.join(parts, "key").select(
            "row", spread("key", F.pmod(F.xxhash64("row"), F.col("parts")), buckets=shards, seed=6).alias("shard"))
        dealt = whole.drop("keys").join(salted, "row", "left").withColumn(
            "shard", F.coalesce("shard", spread("row", buckets=shards, seed=6)))

    def pack_shard(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "doc_tokens", "ids", "row")])
        base = rows["shard"][0].as_py() << 32
        doc_ids, totals, crcs, ids, terms, tf = (
            rows[c].to_pylist() for c in ("doc_id", "doc_tokens", "crcs", "ids", "terms", "tf"))
        out = []
        for doc_id, total, own in zip(doc_ids, totals, crcs):
            out += [(doc_id, k * window, window, crc, total, base + len(out) + k, 0) for k, crc in enumerate(own)]
        rest = [i for i, b in enumerate(ids) if b]
        arrays = [np.frombuffer(ids[i], width) for i in rest]
        index = Bm25Index([terms_of(ids[i], terms[i], tf[i]) for i in rest], corpus)
        for k, sequence in enumerate(fill(arrays, window, [doc_ids[i] for i in rest], index), base + len(out)):
            offset = 0
            for j, a, b in sequence:
                i, start = rest[j], len(crcs[rest[j]]) * window
                out.append((doc_ids[i], start + a, b - a, ids_crc32(arrays[j][a:b]), totals[i], k, offset))
                offset += b - a
        columns = list(zip(*out)) if out else [[]] * 7
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=piece_names)

    piece_names = [c.split()[0] for c in PIECE.split(", ")]
    return dealt.select("row", "shard", "doc_id", "doc_tokens", "crcs", "ids", "terms", "tf").groupBy(
        "shard").applyInArrow(pack_shard, PIECE)


def padding(pieces: DataFrame, window: int = 4096) -> DataFrame:
    """Sequences, ids and padding: a length that is a power of two needs none."""
    size = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    return size.agg(F.count("*").alias("sequences"), F.sum("n").alias("ids"),
                    F.sum(F.when(F.bit_count("n") == 1, 0).otherwise(window - F.col("n"))).alias("padding"))
