"""Embedding near-dedup and WARC bundles against brute force."""

import base64
import hashlib
from collections import Counter

import numpy as np
import pytest

from shopflow.llm import embeddings, warc
from tests.conftest import SF_CHECK


def brute(rows):
    ok = [i for i, (_, v, lab) in enumerate(rows)
          if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = [set() for _ in rows], list(range(len(rows)))
    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b):
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    links[i].add(j)
    for _ in rows:
        root = [min([root[i], *(root[j] for j in links[i])]) for i in range(len(rows))]
    ids = [min((rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None), default=None)
           for i in range(len(rows))]
    return Counter((r[0], len(k), c) for r, k, c in zip(rows, links, ids))


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):  # clusters around the threshold
        base = rng.normal(size=24)
        for _ in range(12):
            rows.append((len(rows), (base + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.12])).tolist(), c % 3))
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, [None] + [1.0] * 23, 1),
             (904, [], 1), (905, rows[0][1], None), (906, [float("inf")] * 24, 0), (None, rows[0][1], rows[0][2]),
             (0, rows[0][1], rows[0][2]), (907, [x * 1e200 for x in rows[0][1]], rows[0][2]), (908, [1.0, 2.0], 2),
             (909, [2.0, 4.0], 2), (910, [5.0], 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, node int, size string")
    for block in (2048, 4):  # also with buckets cut into pairs of blocks
        got = embeddings.near_vectors(df, block=block).collect()
        want = brute(rows)
        found = sum(r.n_links for r in got)
        assert found >= 0.9 * sum(n * k for (_, n, _), k in want.items())
        assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def planted(mean_share, n, seed, d=64):
    """Vectors of d dimensions with this share of a common mean, and for each one at cosine 0.98 to 0.985."""
    rng = np.random.default_rng(seed)
    mean = np.eye(d)[0] * np.sqrt(mean_share)
    u = embeddings.unit(mean + embeddings.unit(rng.normal(size=(n, d))) * np.sqrt(1 - mean_share))
    off = rng.normal(size=u.shape)
    off = embeddings.unit(off - (off * u).sum(axis=1, keepdims=True) * u)
    cosine = rng.uniform(0.9801, 0.985, (n, 1))
    return u, cosine * u + np.sqrt(1 - cosine ** 2) * off


@pytest.mark.parametrize("mean_share", [0.0, 0.9])
@pytest.mark.parametrize("d", [64, 256])
def test_recall_through_the_tables(spark, monkeypatch, mean_share, d):
    """Ids divisible by 50 against all rows, end to end; every table asks that chunks agree."""
    chosen, scheme = [], embeddings.scheme
    monkeypatch.setattr(embeddings, "scheme", lambda *a: chosen.append(scheme(*a)) or chosen[-1])
    x = np.concatenate(planted(mean_share, 2000, 12, d))
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())],
                               "vec_id long, embedding array<double>, label int")
    want = ((x[::50] @ x.T >= 0.98).sum(axis=1) - 1).sum()
    found = embeddings.near_vectors(df).filter("vec_id % 50 = 0").agg({"n_links": "sum"}).first()[0]
    assert want >= 80 and 0.9 * want <= found <= want
    assert [agree > 0 for _, agree in chosen] == [True]


def test_every_length_has_tables():
    """Also without a sample, in few dimensions and for small tables: no scheme compares all pairs."""
    q = embeddings.Quantiser({})
    for d in (1, 2, 3, 8, 24, 64, 300):
        u = embeddings.unit(np.random.default_rng(d).normal(size=(1024, d)))
        for rows in (2, 1000, 10 ** 9):
            chunks, agree = embeddings.scheme(u, q, 0.98, rows, float(rows) ** 2)
            assert 1 <= agree <= chunks <= min(64, d)


def test_scheme_keeps_recall_on_large_tables():
    chosen = {}
    for mean_share in (0.0, 0.5, 0.9):
        sample, (a, b) = planted(mean_share, 4096, 13)[0], planted(mean_share, 4096, 14)
        q = embeddings.Quantiser({64: embeddings.fit_rotation(sample)})
        chunks, agree = chosen[mean_share] = embeddings.scheme(sample, q, 0.98, 10 ** 8, 10 ** 16)
        same = embeddings.chunk_values(q.codes(a), 64, chunks) == embeddings.chunk_values(q.codes(b), 64, chunks)
        assert (same.sum(axis=1) >= agree).mean() >= 0.97
    assert all(agree > 0 for _, agree in chosen.values())


def test_codes_are_balanced():
    sample = embeddings.unit(np.random.default_rng(5).normal(size=(2000, 32)) + 0.5)
    codes = embeddings.Quantiser({32: embeddings.fit_rotation(sample)}).codes(sample)
    share = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").mean(axis=0)[:32]
    assert (abs(share - 0.5) < 0.1).all()


def test_bundles_round_trip(spark, scratch):
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""),
            (5, "u", "ä" * 500_000), (5, "u", "ä" * 500_000), (None, "u", "<p>x</p>"), (None, "u", "lonely"),
            (6, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, path int")
    payload = {i: (r[2] or "").encode() for i, r in enumerate(rows)}
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[payload[i]] = min(first.get(payload[i], r[0]), r[0])
    want = Counter()
    for i, r in enumerate(rows):
        lead = first.get(payload[i])
        again = lead is not None and r[0] != lead
        want[(r[0], len(payload[i]), base64.b32encode(hashlib.sha1(payload[i]).digest()).decode(),
              "revisit" if again else "response", lead if again else None)] += 1
    manifest = warc.write_bundles(pages, f"file://{scratch}/warc", bundle_bytes=1 << 20)
    assert Counter(map(tuple, warc.read_bundles(manifest).collect())) == want
    one = next(b for b in (warc.Bundle(r.path) for r in manifest.collect()) if "<urn:page:6>" in b.index())
    fields, http, body, _ = warc.parse(one.record("<urn:page:6>"))
    assert fields["warc-type"] == "response" and body == b"a\r\n\r\nb" and http["content-length"] == "6"
    import zstandard

    data = open(one.uri.removeprefix("file://"), "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1")
    assert warc.archive(pages, revisit_bytes=1 << 30).filter("record_type = 'revisit'").count() == 0
    assert warc.archive(pages.limit(0)).count() == 0
