"""Operators over documents against brute force, with the edge rows of the fixture."""

import array
import hashlib
import math
import pathlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shopflow.llm import exact, langid, mixing, packing, rollups, sharding, simhash, wavelet
from shopflow.llm.tokens import Encoder, encoder, vocabulary_path


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def reference_ids(rows):
    model = encoder(vocabulary_path()).model
    return [e.ids for e in model.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(array.array("I", ids).tobytes())


def test_tokens_equal_the_library_on_whole_texts(docs):
    import pyarrow as pa

    rows = texts(docs) + [(0, "x" * 5000), (0, "…! × 'S 'll'ves a'b <|endoftext|> naïve—foo é\x85ñ")]
    got = [ids[a:b].tolist() for _, ids, off in encoder(vocabulary_path()).encode(pa.array([t for _, t in rows]))
           for a, b in zip(off[:-1], off[1:])]
    assert got == reference_ids(rows)


def test_encoder_keeps_pieces_in_a_bounded_cache(docs):
    import pyarrow as pa

    def letters(i):
        return "".join("abcdefghij"[int(c)] for c in str(i))

    def encoded(model, rows):
        return [ids[a:b].tolist() for _, ids, off in model.encode(pa.array(rows, pa.string())) for a, b in zip(off[:-1], off[1:])]

    # 200,000 pieces of letters are learned once
    model, learned = Encoder(vocabulary_path()), []
    learn = model._learn
    model._learn = lambda pieces: [learned.append(len(pieces)), learn(pieces)][1]
    many = [" ".join(letters(i) for i in range(k, k + 1000)) for k in range(0, 200_000, 1000)]
    first = encoded(model, many)
    assert sum(learned) == 200_000
    assert encoded(model, many) == first and sum(learned) == 200_000
    # pieces that come and go, in chunks of a few rows: digits, signs, letters beyond ASCII and a long one
    rows = [t for _, t in texts(docs)] + [f"{letters(i % 37)} Ñandú{letters(i % 11)} {'ÿ' * (i % 50)} Æß{i} x.Y-{i % 7}, ©{letters(i)}·"
                                          for i in range(300)] + ["", None, "a", "long" * 100, "long" * 100]
    want = reference_ids([(0, t) for t in rows])
    for cache in (0, 1, 50, 1000):
        model = Encoder(vocabulary_path(), cache=cache, chunk_bytes=100)
        assert encoded(model, rows) == want == encoded(model, rows)
        assert len(model.known) == len(model.size) == len(model.used) <= cache and len(model.flat) == model.size.sum()
        assert all(len(p.encode()) <= 64 for p in model.known.to_pylist())
    # ids that don't tell where a piece ends
    model = Encoder(vocabulary_path())
    assert model._merged(pa.array([letters(i) + c for i in range(999) for c in "aàéßöøÿ"], pa.large_string())) is not None
    model.closing[:] = False
    assert encoded(model, rows) == want
    model.closing[:] = True
    assert encoded(model, rows) == want


def test_exact_groups(spark, docs, empty):
    rows = texts(docs)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (d, _), t in zip(rows, norm):
        groups[t].append(d)
    for boundary in (None, -1, 100):  # some history, none, all
        got = exact.exact_groups(docs, boundary=boundary).collect()
        assert len(got) == len(rows)
        for r in got:
            own = [g for t, g in groups.items()
                   if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256][0]
            least = min((d for d in own if d is not None), default=None)
            assert (r.keep_id, r.group_size) == (least, len(own)) and r.doc_id in own
        kept = Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept.values()) == {1} and len(kept) == len(groups)
    stay = exact.drop_repeats(docs)
    assert stay.columns == docs.columns and stay.count() == len(groups)
    assert exact.exact_groups(empty).count() == 0 and exact.drop_repeats(empty).count() == 0


def test_groups_come_through_the_perfect_hash(spark, docs):
    """With a lookup that finds nothing, or whose slots are wrong, members of history are lost to it."""
    want = Counter(map(tuple, exact.exact_groups(docs, boundary=5).collect()))
    for slots_of in (lambda mph, digests: np.full(len(digests), -1), lambda mph, digests: (mph.slots(digests) + 1) % 3):
        got = exact.exact_groups(docs, boundary=5, lookup=lambda index, probe: exact.look_up(index, probe, slots_of))
        assert Counter(map(tuple, got.collect())) != want
    # a slot's number holds the rows of both sides, its winner is history's
    digest = [bytes([i]) * 32 for i in range(6)]
    old = spark.createDataFrame([(0, digest[i], 10 + i, 2) for i in range(4)], "shard int, digest binary, first long, n long")
    new = spark.createDataFrame([(0, digest[i], 90 + i, 5) for i in (1, 3, 5)], old.schema)
    rows = {bytes(r.digest): tuple(r)[1:] for r in exact.look_up(exact.build_index(old), new).collect()}
    assert rows == {digest[0]: (10, 2, True), digest[1]: (11, 7, True), digest[2]: (12, 2, True),
                    digest[3]: (13, 7, True), digest[5]: (95, 5, False)}


def test_the_same_repeat_stays_on_every_run(spark):
    rows = [(1, "a  b", s) for s in "xyz"] + [(1, "a b", "w"), (2, "a b", "v")]
    seen = {tuple(exact.drop_repeats(spark.createDataFrame(p, "doc_id long, text string, source string")
                                     .repartition(n)).collect()) for p, n in ((rows, 1), (rows[::-1], 3), (rows, 4))}
    assert len(seen) == 1


def test_perfect_hash_is_minimal_and_bytes_decide():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 256, (5000, 32), dtype=np.uint8)
    mph = exact.PerfectHash.build(keys)
    assert sorted(mph.slots(keys)) == list(range(5000))
    assert exact.PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=3):
    root = list(range(len(prints)))
    for _ in prints:
        new = [min(root[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= radius) for p in prints]
        new = [min(a, b) for a, b in zip(new, root)]
        if new == root:
            return root
        root = new
    return root


def test_simhash_components(docs, empty):
    rows = texts(docs)
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints)
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None)
             for r in set(root)}
    want = Counter((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, root))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    stay = simhash.drop_near_duplicates(docs)
    assert stay.columns == docs.columns and stay.count() == sum(r.kept for r in got)
    assert simhash.near_duplicates(empty).count() == 0


def test_covering_masks_miss_no_pair_and_large_buckets_are_cut(spark):
    masks = simhash.masks(3)
    rng = np.random.default_rng(2)
    for _ in range(2000):
        bits = rng.choice(64, 3, replace=False)
        x = sum(1 << int(b) for b in bits)
        assert any(not x & m for m in masks)
        m = int(rng.integers(0, len(masks)))
        if not x & masks[m]:
            assert any(not x & f for f in simhash.finer(masks[m], 3))
    # a dense group, whose buckets are all over the limit
    base = int(rng.integers(0, 1 << 62))
    prints = sorted({base ^ sum(1 << int(b) for b in rng.choice(62, int(k), replace=False))
                     for k in rng.integers(0, 5, 150)} | {int(x) for x in rng.integers(0, 1 << 62, 50)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = simhash.components(simhash.links(df, 3, bucket_limit=40))
    roots = {r.node: r.root for r in got.collect()}
    root = brute_components(prints)
    assert [roots.get(p, p) for p in prints] == [prints[r] for r in root]


def test_packing_covers_every_id_once(docs, empty):
    rows = texts(docs)
    want = Counter((d, tuple(ids) + (2,)) for (d, _), ids in zip(rows, reference_ids(rows)))
    pieces = packing.pack(docs, window=512, rows_per_shard=4).collect()
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 512 or (at < 512 and at.bit_count() == 1)
    for (d, ids), times in want.items():
        own = [p for p in by_doc[d] if p.doc_tokens == len(ids)]
        spans = Counter((p.start, p.length, p.ids_crc32) for p in own)
        assert sum(p.length for p in own) >= times * len(ids)
        for (start, length, check), n in spans.items():
            assert check == crc(ids[start:start + length]) or len(by_doc[d]) > len(own)
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    assert packing.pack(empty).count() == 0


def test_bm25_prefers_shared_rare_terms():
    docs = [np.array(x, np.uint16) for x in ([1, 2, 3, 9], [4, 5, 6], [1, 2, 3, 7], [9, 8, 8], [6, 7, 7, 5])]
    assert packing.Bm25Index(docs).neighbours(0).tolist()[0] == 2
    assert packing.Bm25Index([]).n == 0
    filled = [s for s in packing.fill(docs, 8)]
    assert sum(b - a for s in filled for _, a, b in s) == sum(map(len, docs))
    assert [i for i, _, _ in filled[0]][:2] == [0, 2]
    # a copy of the seed is its best match, yet no neighbour of it
    copies = [docs[0], docs[0], docs[2], docs[1], docs[1] + 20, docs[1] + 30, docs[1] + 40]
    assert packing.Bm25Index(copies).neighbours(0).tolist() == [1, 2]
    assert [i for i, _, _ in next(packing.fill(copies, 8))] == [0, 1]
    assert [i for i, _, _ in next(packing.fill(copies, 8, [7, 7, 8, 9, 10, 11, None]))] == [0, 2]


def test_related_documents_meet_over_several_shards(spark):
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in "bcdfghklmnprstvw" for b in ("al", "en", "ir", "ost", "und", "ay", "ick", "oom")]

    def some(n):
        return " ".join(rng.choice(words, n))

    rows = []
    for family in range(20):  # three documents share half of their text
        passage = some(120)
        rows += [(len(rows) + k, f"{some(60)} {passage} {some(60)}", family) for k in range(3)]
    rows += [(i, some(240), None) for i in range(len(rows), 400)]
    order = rng.permutation(len(rows)).tolist()  # ids say nothing about families
    df = spark.createDataFrame([(order[i], text) for i, text, _ in rows], "doc_id long, text string")
    family = {order[i]: f for i, _, f in rows if f is not None}
    shards = defaultdict(set)
    for p in packing.pack(df, window=1024, rows_per_shard=40).collect():
        shards[p.doc_id].add(p.sequence_id >> 32)
    assert len({s for own in shards.values() for s in own}) > 5
    together = sum(len({s for d, g in family.items() if g == f for s in shards[d]}) == 1 for f in range(20))
    assert together >= 18


def test_bm25_asks_with_all_terms_of_the_whole_document():
    # 40 rarer terms do not hide the passage that documents 0 and 1 share
    passage = list(range(100, 120))
    docs = [np.array(x, np.uint16) for x in (
        passage + list(range(40)), passage, passage + list(range(200, 210)),
        *([k, 300 + k] for k in range(40)), [300, 301])]
    assert packing.Bm25Index(docs).neighbours(0).tolist()[:2] == [1, 2]
    # of two documents both terms are in more than half
    assert packing.Bm25Index(docs[1:3]).neighbours(0).tolist() == [1]
    # a document is found by terms that its remainder lacks
    index = packing.Bm25Index([packing.counted(np.array([5, 6, 9])), np.array([5, 6]), np.array([8])])
    assert [i for i, _, _ in next(packing.fill([np.array([9]), np.array([5, 6]), np.array([8])], 3, index=index))] == [0, 1]


def test_copies_fill_a_window_only_when_nothing_else_is_left():
    a, b = np.array([1, 2, 3, 4], np.uint16), np.array([50, 51, 52, 53], np.uint16)
    # no neighbour but its own copies: another document comes before them
    assert [i for i, _, _ in next(packing.fill([a, a, a, b], 8, [1, 1, 1, 2]))] == [0, 3]
    assert [i for i, _, _ in next(packing.fill([a, a, a], 8, [1, 1, 1]))] == [0, 1]


def test_copies_of_one_document_spread_over_shards(spark):
    df = spark.range(400).selectExpr(
        "IF(id % 2 = 0, 7, id) AS doc_id",
        "IF(id % 2 = 0, repeat('the quick brown fox jumps over lazy dogs ', 5), concat('text ', id)) AS text")
    shards = Counter(p.sequence_id >> 32 for p in packing.pack(df, window=64, rows_per_shard=20).collect()
                     if p.doc_id == 7 and p.start == 0)
    assert sum(shards.values()) >= 200 and max(shards.values()) <= 60


def test_wavelet_files_round_trip(docs, empty):
    rows = texts(docs)
    got = wavelet.token_files(docs, bytes_per_partition=200, tokens_per_shard=300).orderBy("start").collect()
    want = sorted(((d, t or "", ids + [1]) for (d, t), ids in zip(rows, reference_ids(rows))),
                  key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _, _ in want]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (d, len(ids), crc(ids)) for d, _, ids in want)
    assert wavelet.token_files(empty).count() == 0


def test_wavelet_partitions_follow_bytes():
    size = 10 ** 9 * 4000  # 10^9 rows
    assert wavelet.partitions_for(size, 200) == -(-size // (128 << 20))
    assert wavelet.partitions_for(0, 200) == 1 and wavelet.partitions_for(5 << 20, 200) == 5
    assert wavelet.partitions_for(1 << 30, 200) == 200


def test_wavelet_rows_of_one_id_lie_in_several_files(spark):
    df = spark.range(600).selectExpr("7 AS doc_id", "concat('text ', repeat('more ', 600), id) AS text")
    made = wavelet.write_shards(df, wavelet.shared_path(spark, "wavelet"), bytes_per_partition=200_000).collect()
    assert sum(r.documents for r in made) == 600 and len({r.shard >> 20 for r in made}) >= 4


def test_wavelet_planes_order_ids_by_the_bits_above():
    rng = np.random.default_rng(4)
    for dtype, bits in (("<u2", 16), ("<u4", 17), ("<i8", 3), ("<u2", 1)):
        for n in (0, 1, 7, 8, 9, 1000, 4097):
            ids = rng.integers(0, 1 << bits, n).astype(dtype)
            want, order = [], ids.tolist()
            for b in range(bits - 1, -1, -1):
                want.append([i >> b & 1 for i in order])
                order.sort(key=lambda i: i >> b & 1)
            got = wavelet._planes(ids, bits)
            assert [np.unpackbits(p, count=n, bitorder="little").tolist() for p in got] == want, (dtype, n)
            if n:
                assert wavelet.WaveletShard(wavelet.dump([1], [n], ids)).decode().tolist() == ids.tolist()


def test_wavelet_access_unpacks_one_frame_of_a_plane(monkeypatch):
    monkeypatch.setattr(wavelet, "_FRAME", 64)
    ids = np.random.default_rng(5).integers(0, 1 << 16, 9000).astype(np.uint16)
    shard = wavelet.WaveletShard(wavelet.dump([1], [9000], ids))
    assert shard.access(8999) == ids[8999] and len(shard._open) <= 2 * shard.bits
    assert [shard.access(i) for i in range(0, 9000, 531)] == ids[::531].tolist()
    token = int(ids[4321])
    assert list(shard.occurrences(token)) == np.flatnonzero(ids == token).tolist()
    assert shard.decode().tolist() == ids.tolist()


@pytest.mark.parametrize("n", [0, 1, 63, 513, 3000])
def test_wavelet_access_rank_select(n):
    ids = np.random.default_rng(n).choice([0, 1, 2, 5, 40000, 49407], n).astype(np.uint16)
    shard = wavelet.WaveletShard(wavelet.dump([None], [n], ids))
    assert shard.doc_ids == [None] and shard.decode().tolist() == ids.tolist()
    for i in range(0, n, 97):
        assert shard.access(i) == ids[i]
    for token in (0, 5, 49407, 7, 1 << 20):
        lo, hi = n // 5, n - n // 7
        where = [i for i in range(lo, hi) if ids[i] == token]
        assert shard.count(token, lo, hi) == len(where) and list(shard.occurrences(token, lo, hi)) == where


def test_poisson_mixing(spark, docs, empty):
    mixed = mixing.mix(docs, exponent=0.5)
    assert mixed.columns == [*docs.columns, "replica_"]
    again = mixing.mix(docs, exponent=0.5).collect()
    assert Counter(map(str, mixed.collect())) == Counter(map(str, again))
    rates = {r.source: r.rate for r in mixing.rates(docs, exponent=0.5).collect()}
    counts = Counter(r.source for r in docs.collect())
    assert sum(rates[s] * n for s, n in counts.items()) == pytest.approx(sum(counts.values()))
    from math import exp, factorial

    for rate in (0.3, 1.0, 4.5):
        below = mixing.thresholds(rate)
        assert below[2] == pytest.approx(sum(exp(-rate) * rate ** k / factorial(k) for k in range(3)))
    assert mixing.thresholds(2000.0)[2000] == pytest.approx(0.506, abs=0.01)
    many = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "small").otherwise(
        "large").alias("source"))
    sizes = {r.source: r["count"] for r in mixing.mix(many, weights={"small": 1, "large": 1}).groupBy("source").count().collect()}
    assert abs(sizes["small"] - 10000) < 500 and abs(sizes["large"] - 10000) < 500
    assert mixing.mix(many, weights={"small": 1}).filter("source = 'large'").count() == 0
    assert mixing.mix(empty).count() == 0
    shuffled = mixing.mix(docs, exponent=0.5, broadcast_bytes=0)  # too large to broadcast: joined by shuffle
    assert Counter(map(str, shuffled.collect())) == Counter(map(str, again))


def test_rendezvous_sharding(spark, docs, empty):
    got = sharding.assign(docs, [1.0] * 40, parts=3).collect()
    rows = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts(docs))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == rows
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    def draw(key, shard):
        name = f"9:{'' if key is None else key}:{shard}"
        return -math.log((int(hashlib.md5(name.encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48), shard

    for r in got:  # one by one, by the definition
        assert r.shard == min(draw(r.doc_id, s) for s in range(40))[1]
        assert r.grown_shard == min(draw(r.doc_id, s) for s in range(41))[1]
    many = spark.range(20000)
    share = many.groupBy(sharding.shard_of(F.col("id"), [1.0, 3.0, 0.0]).alias("s")).count().collect()
    by = {r.s: r["count"] for r in share}
    assert set(by) == {0, 1} and abs(by[0] - 5000) < 300
    assert sharding.assign(empty, [1.0]).count() == 0


def test_language_id(spark, docs, empty):
    words = {"en": "the of and to in that with which", "de": "der die und das nicht ein mit sich"}
    import random

    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(words[lang].split(), k=rnd.choice([1, 5, 80, 3000]))), lang, "s")
            for i in range(120) for lang in ("en" if i % 2 else "de",)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit(corpus.filter(~langid.held_out()))
    assert set(model) == {"en", "de"}
    judged = langid.identify(corpus, model).withColumn("held_out", langid.held_out()).collect()
    held = [r for r in judged if r.held_out]
    assert [r.held_out for r in judged] == [zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in judged]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held) > 0
    assert all(0 <= r.score <= 1 and r.lang_pred in model for r in judged)
    odd = langid.identify(docs, model)
    assert odd.columns[:len(docs.columns)] == docs.columns and "score_" in odd.columns
    by = {r.text: r for r in odd.collect()}
    for t in (None, "", " \n ", "123 !!"):
        assert (by[t].lang_pred, by[t].score_, by[t].rejected) == ("und", 0.0, True)
    assert langid.fit(empty) == {} and langid.identify(empty, {}).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}


def test_token_rollups(spark, docs, empty, scratch):
    counts = rollups.count_tokens(docs.select("doc_id", "source", "lang", "text"), vocabulary_path())
    counts = counts.withColumn("tokenizer", F.lit("v1"))
    n = {(d, t): len(ids) for (d, t), ids in zip(texts(docs), reference_ids(texts(docs)))}
    want = Counter()
    for r in docs.collect():
        want[(r.source, r.lang, "v1")] += n[(r.doc_id, r.text)]
    book = rollups.Rollup(spark, f"file://{scratch}/book")
    assert book.totals().count() == 0
    assert book.commit("b1", rollups.inserts(counts)) and not book.commit("b1", rollups.inserts(counts))
    assert {(r.source, r.lang, r.tokenizer): r.tokens for r in book.totals().collect()} == want
    book.compact()
    assert not book.commit("b1", rollups.inserts(counts)) and book.committed() == {"b1"}
    seven = counts.filter("doc_id = 7").limit(1)
    changed = seven.select("*", F.lit("d").alias("new_source"), F.col("lang").alias("new_lang"),
                           F.lit("v2").alias("new_tokenizer"), (F.col("tokens") + 5).alias("new_tokens"))
    assert book.commit("b2", rollups.revisions(changed))
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in book.totals().collect()}
    one = seven.collect()[0].tokens
    assert got[("d", "en", "v2")] == (1, one + 5) and got[("c", "en", "v1")] == (1, one)
    assert book.commit("b3", rollups.deletes(counts.filter("doc_id = 9")))
    book.compact()
    assert book.commit("b4", rollups.inserts(rollups.count_tokens(
        empty.select("doc_id", "source", "lang", "text"), vocabulary_path()).withColumn("tokenizer", F.lit("v1"))))
    assert sum(r.documents for r in book.totals().collect()) == docs.count() - 1
    # a batch that failed half-way is written again
    (pathlib.Path(scratch) / "book/batches/b5").mkdir(parents=True)
    assert book.commit("b5", rollups.inserts(counts.limit(1)))


def test_language_id_by_a_plain_loop_of_compressions(spark, docs):
    """Every text of the driver's table and the odd ones, compressed one by one with the library alone."""
    import zstandard as z

    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(table.filter(~langid.held_out()))
    assert len(model) > 1 and all(len(d) <= 161 * 1025 for d in model.values())
    both = table.select("doc_id", "text").union(docs.select("doc_id", "text"))

    def size(raw, content):
        params = z.ZstdCompressionParameters.from_level(
            6, write_content_size=0, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        kept = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(compression_params=params)
        return sum(len(z.ZstdCompressor(compression_params=params, dict_data=kept).compress(raw[i:i + 2048]))
                   for i in range(0, len(raw), 2048))

    want = []
    for r in both.collect():
        raw = re.sub(r"[\W\d_]+", " ", (r.text or "").lower()).encode()
        if not any(c.isalpha() for c in r.text or ""):
            want.append((r.doc_id, "und", 0.0, True))
            continue
        if len(raw) < 96:
            raw = (raw.strip() + b" ") * -(-96 // (len(raw) + 1))
        sizes = sorted((size(raw, content), lang) for lang, content in model.items())
        share = 1 - sizes[0][0] / sizes[1][0]
        want.append((r.doc_id, sizes[0][1], round(share, 9), share < 0.005))
    got = [(r.doc_id, r.lang_pred, round(r.score, 9), r.rejected) for r in langid.identify(both, model).collect()]
    same = [a == b for a, b in zip(sorted(got, key=str), sorted(want, key=str))]
    assert len(got) == len(want) and all(same)


def test_labels_without_bound(spark):
    """Ever more labels get smaller dictionaries, none is left out; samples come from all over a text."""
    head = "license header of every text " * 60
    rows = [(i, head + f"wort{i % 700} eigen{i % 700} " * 40, f"l{i % 700:03d}", "s") for i in range(2100)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit(corpus, max_bytes=700 * 1024)
    assert len(model) == 700 and max(map(len, model.values())) <= 1024
    assert sum(b"eigen" in content for content in model.values()) > 100
    # a label whose texts begin without a letter is learned all the same
    odd = spark.createDataFrame([(i, "1" * 5000 + " ja nein vielleicht", "de", "s") for i in range(3)], corpus.schema)
    assert b"vielleicht" in langid.fit(odd)["de"]


def test_terms_of_many_documents_by_one_sort():
    rng = np.random.default_rng(2)
    for dtype, top in (("<u2", 65536), ("<u4", 1 << 20), ("i8", 1 << 20)):
        docs = [rng.integers(0, top, n).astype(dtype) % 50 + (top - 50) for n in (0, 1, 700, 0, 30, 1)]
        ready = packing.counted(np.array([3, 3, 4]))
        for own, (terms, tf) in zip([*docs, ready], packing.counted_each([*docs, ready])):
            want = own if isinstance(own, tuple) else (packing.counted(own) if len(own) else ([], []))
            assert terms.tolist() == list(want[0]) and tf.tolist() == list(want[1])
    assert packing.counted_each([]) == []
