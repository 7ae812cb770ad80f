"""Ranked search against scores of every document."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopflow.llm import signatures

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return _TERM.findall(low)


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        if text is None:
            continue
        ranked = []
        for (doc, bag), size in zip(bags, sizes):
            m = 100 - 75 + (75 * size * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                (1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in terms(text) if bag[t])
            if score > 0:
                ranked.append((-score, doc is None, doc or 0))
        out += [(item, k, None if missing else doc, -s) for k, (s, missing, doc) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "the lazy dog"), (2, "WORD3 word5 word5 about"), (3, None), (4, ""), (5, "größe İ 漢字 it's"), (6, "!?"),
         (7, "nowhere"), (8, "quick " * 50 + "brown"), (8, "quick " * 50 + "brown"), (None, "schnelle braune hund"),
         (9, "word1 " * 3 + " ".join(f"word{i}" for i in range(900)))]


@pytest.mark.parametrize("items_at_once", [1024, 3])
def test_against_all_scores(spark, docs, items_at_once):
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, rank int")
    found = signatures.search(docs, items, items_at_once=items_at_once)
    assert rows_of(found) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS)


def test_copies_and_ties(spark):
    docs = [(i, "same passage of words here" if i % 3 else f"other {i} words passage passage") for i in range(400)]
    items = [(1, "passage of words"), (2, "other 3 passage")]
    found = signatures.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                              spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(found) == brute(docs, items)


def test_empty_tables(spark, empty, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert signatures.search(empty, items).count() == 0
    assert signatures.search(docs, items.limit(0)).count() == 0


def test_bounds_hold_and_exclude(spark, docs):
    """No bound lies under its score, and on the driver's documents most have a bound under the tenth score."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = table.select(F.col("doc_id").alias("key"), "doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    wanted = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()][:10]
    vocabulary = sorted({t for w in wanted for t in terms(w)})
    index = signatures.scan(rows, vocabulary, signatures=True).collect()
    df = {r["term"]: 0 for r in index if r["term"]}
    for r in index:
        if r["term"]:
            df[r["term"]] += r["df"]
    blocks = [r.asDict() for r in index if r["bits"]]
    law = signatures.Law(sum(len(b["keys"]) for b in blocks), sum(map(sum, (b["sizes"] for b in blocks))))
    known = sorted(t for t in df if law.weight(df[t]) > 0)
    own = [Counter(t for t in terms(w) if t in known) for w in wanted]
    items = signatures.Items(
        list(range(len(wanted))), known, np.cumsum([0] + [len(o) for o in own]),
        np.array([known.index(t) for o in own for t in sorted(o)]),
        np.array([law.weight(df[t]) * o[t] for o in own for t in sorted(o)], float))
    hashes, kept, seen = signatures.entry_hashes(known), 0, 0
    exact = {(i, d): s for i, _, d, s in brute(list(texts.items()), list(enumerate(wanted)), top=10**9)}
    tenth = [sorted((s for (i, _), s in exact.items() if i == k), reverse=True)[9] for k in range(len(wanted))]
    for block in blocks:
        bounds = signatures.upper_bounds(block, items, hashes, law, terms_at_once=7)
        for i in range(len(wanted)):
            for d, bound in zip(block["keys"], bounds[i]):
                assert bound >= exact.get((i, d), 0)
                kept += bound >= tenth[i]
                seen += 1
    assert kept < seen / 20


def test_terms_of_odd_bytes():
    odd = pa.array(["a\x00b", None, "", "  ", "É_é^~`{x}", "İI", " 　x", "9/:@[Z"])
    got = []
    for first, t in signatures.split_terms(odd, chunk_bytes=4):
        words = t.words.to_pylist()
        got += [(first + d, words[w], k) for d, w, k in zip(t.doc.tolist(), t.word.tolist(), t.tf.tolist())]
    want = [(i, t, k) for i, s in enumerate(odd.to_pylist()) for t, k in Counter(terms(s)).items()]
    assert sorted(got) == sorted(want)
