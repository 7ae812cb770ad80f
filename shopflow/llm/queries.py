"""Registered queries of the operators, over the whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import (embeddings, exact, extract, langid, mixing, packing, rollups, sharding, signatures,
                          simhash, trie, warc, wavelet)
from shopflow.llm.common import materialise, shared_path
from shopflow.llm.tokens import vocabulary_path
from shopflow.session import import_in_workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    import_in_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.identify(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "margin_bytes", "rejected")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).drop("from_history")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after three batches: all documents in, toxic ones out, and those of
    quality 1 counted anew with the end-of-text id; the second batch is sent twice."""
    docs, version, revised = table(spark, sf_dir, "documents"), "word_bpe_49k", "word_bpe_49k+end"
    counts = rollups.count_tokens(docs.select("doc_id", "source", "lang", "text"), vocabulary_path())
    counts = materialise(counts.withColumn("tokenizer", F.lit(version)), "token-counts")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    labelled = counts.join(labels, "doc_id")
    toxic = labelled.filter("toxic = 1")
    good = labelled.filter("quality = 1 AND coalesce(toxic, 0) = 0").select(
        *counts.columns, F.col("source").alias("new_source"), F.col("lang").alias("new_lang"),
        F.lit(revised).alias("new_tokenizer"), (F.col("tokens") + 1).alias("new_tokens"))
    rollup = rollups.Rollup(spark, shared_path(spark, "rollup"))
    rollup.commit("load", rollups.inserts(counts))
    rollup.commit("retract", rollups.deletes(toxic))
    rollup.compact()
    rollup.commit("revise", rollups.revisions(good))
    rollup.commit("retract", rollups.deletes(toxic))
    return rollup.totals()


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(table(spark, sf_dir, "documents"))


def op9_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), [1.0] * 40)


def op10_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_language_id": op2_language_id,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_token_counts": op5_token_counts,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_wavelet": op8_wavelet,
    "op9_rendezvous": op9_rendezvous,
    "op10_itq": op10_itq,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_signature_search": op12_signature_search,
    "op13_host_consensus": op13_host_consensus,
}

#: CRC-32 of a byte: eight steps of the polynomial, as a list
_CRC_STEPS = """steps AS (
            SELECT list(v ORDER BY i) AS table_
            FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b:
                      CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
                  FROM range(256) AS r(i)))"""

ORACLE: dict[str, str] = {
    "op1_mixing": """
        WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (SELECT source, (n ** 0.7) / n * (sum(n) OVER () / sum(n ** 0.7) OVER ()) AS rate FROM sizes),
        below AS (
            SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (
                PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS p
            FROM rates, range(0, 200) AS ks(k)),
        drawn AS (
            SELECT *, CAST('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)
                      / 281474976710656.0::DOUBLE AS u
            FROM documents),
        counted AS (
            SELECT doc_id, (SELECT count(*) FROM below b
                            WHERE b.source IS NOT DISTINCT FROM d.source AND b.p <= d.u) AS copies
            FROM drawn d)
        SELECT d.doc_id, text, lang, source, n_chars, CAST(r.k AS INTEGER) AS replica
        FROM documents d JOIN counted c ON c.doc_id = d.doc_id, range(0, 200) AS r(k)
        WHERE r.k < c.copies""",
    "op7_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
              FROM documents)
        WINDOW same AS (PARTITION BY text_sha256)""",
    "op9_rendezvous": "WITH " + _CRC_STEPS + r""",
        sized AS (
            SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, xor(list_reduce(
                list_prepend(4294967295, list_transform(
                    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda c: CAST('0x' || c AS BIGINT))),
                lambda a, c: xor(a >> 8, table_[(xor(a, c) & 255) + 1])), 4294967295) AS text_crc32
            FROM documents, steps),
        drawn AS (
            SELECT doc_id, s, -ln((CAST('0x' || substr(md5('9:' || doc_id || ':' || s), 1, 12) AS BIGINT) + 0.5::DOUBLE)
                                  / 281474976710656.0::DOUBLE) AS draw
            FROM (SELECT DISTINCT doc_id FROM documents), range(0, 41) AS shards(s)),
        placed AS (
            SELECT doc_id, arg_min(s, draw) FILTER (WHERE s < 40) AS shard, arg_min(s, draw) AS grown
            FROM drawn GROUP BY doc_id)
        SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY
                   CAST('0x' || substr(md5('part:' || doc_id || ':' || text_crc32), 1, 8) AS BIGINT) % 256,
                   doc_id, text_crc32, size) - 1 AS slot,
               CAST(grown AS INTEGER) AS grown_shard
        FROM sized JOIN placed USING (doc_id)""",
    "op11_prefix_trie": """
        WITH """ + _CRC_STEPS + """,
        talks AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        starts AS (
            SELECT conv_id, s, xor(list_reduce(
                list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                lambda a, c: xor(a >> 8, table_[(xor(a, c) & 255) + 1])), 4294967295) % 9 AS h
            FROM talks, steps),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS s
            FROM starts c LEFT JOIN talks b ON b.conv_id = c.conv_id - c.conv_id % 5),
        nodes AS (
            SELECT s[1:d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE any_value(strlen(s[d].text)) END AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                   FILTER (WHERE len(s) = d), '')) AS ends_sha256
            FROM rebuilt, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d) GROUP BY p, d),
        parents AS (
            SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.p[1:n.depth] = n.p) AS n_children
            FROM nodes n LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]),
        sums AS (
            SELECT p[1:e] AS top, e, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
            FROM parents, LATERAL (SELECT unnest(range(0, depth + 1)) AS e) GROUP BY top, e)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
        FROM parents JOIN sums ON top = p AND e = depth""",
    "op12_signature_search": r"""
        WITH parts AS (
            SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        asked AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY item_id, term),
        sizes AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM parts GROUP BY r),
        whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
        occurs AS (SELECT r, term, count(*) AS tf FROM parts WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM occurs, whole GROUP BY term, docs),
        scores AS (
            SELECT item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (
                1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN occurs USING (term) JOIN sizes USING (r), whole
            GROUP BY item_id, doc_id, r),
        ranked AS (
            SELECT item_id, doc_id, score,
                   CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
            FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
