"""run() of the pipeline against the same five steps by brute force."""

import hashlib
import re
from collections import Counter, defaultdict
from math import exp

import corpus_pipeline
from shopflow.llm import langid
from shopflow.llm.tokens import encoder, vocabulary_path
from tests.conftest import SF_SMALL
from tests.llm.test_documents import brute_components, brute_print


def copies(doc_id, rate):
    u = int(hashlib.md5(f"1:{doc_id}".encode()).hexdigest()[:12], 16) / 2 ** 48
    k, p = 0, exp(-rate)
    below = p
    while below <= u and k < 500:
        k += 1
        p *= rate / k
        below += p
    return k


def test_pipeline_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.Classifier(langid.fit(table.filter(~langid.held_out())))
    judged = {r.doc_id: (r, model.predict(r.text)) for r in table.collect()}
    rows = [r for r, (lang, score, margin) in judged.values() if lang != "und" and score >= 0.005 and margin > 0]
    least = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    rows = list(least.values())
    root = brute_components([brute_print(r.text) for r in rows])
    first = defaultdict(lambda: 1 << 60)
    for r, c in zip(rows, root):
        first[c] = min(first[c], r.doc_id)
    rows = [r for r, c in zip(rows, root) if first[c] == r.doc_id]
    n = Counter(r.source for r in rows)
    scale = len(rows) / sum(k ** 0.7 for k in n.values())
    mixed = {r.doc_id: copies(r.doc_id, n[r.source] ** 0.7 / n[r.source] * scale) for r in rows}
    ids = encoder(vocabulary_path()).model.encode_batch([r.text for r in rows], add_special_tokens=False)
    want = {r.doc_id: (len(e.ids) + 1, mixed[r.doc_id] * (len(e.ids) + 1)) for r, e in zip(rows, ids) if mixed[r.doc_id]}
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    packed, size = Counter(), {}
    for p in pieces:
        packed[p.doc_id] += p.length
        size[p.doc_id] = p.doc_tokens
    assert {d: (size[d], packed[d]) for d in packed} == want
    lengths = Counter()
    for p in pieces:
        lengths[p.sequence_id] += p.length
    assert all(x <= 4096 and (x == 4096 or x.bit_count() == 1) for x in lengths.values())


def test_stages_on_odd_rows(spark, docs, empty):
    """Nulls, blank, long and repeated texts, clashing names: each stage keeps the columns and loses nothing it should not."""
    for table in (docs, empty):
        rows = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, "")
            assert out.columns == table.columns, name
            kept, came = Counter(map(str, out.collect())), Counter(map(str, rows.collect()))
            assert set(kept) <= set(came), name
            if name != "mixing sources to target weights":
                assert all(kept[r] <= came[r] for r in kept), name
            if table is docs:
                assert kept or name == "mixing sources to target weights", name
        packed = corpus_pipeline.STAGES[-1][1](spark, table, "").collect()
        whole = Counter((r.doc_id, r.doc_tokens) for r in packed if r.start == 0)
        assert sum(whole.values()) == table.count()
        assert sum(r.length for r in packed) == sum(t * n for (_, t), n in whole.items())
