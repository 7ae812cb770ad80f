"""Language identification by compression with per-language dictionaries.

Each language has a zstandard raw-content dictionary cut from labelled texts.  A
text is compressed with every dictionary, block by block over its whole length, and the
dictionary with the smallest total wins; narrow margins are rejected.  Blocks
keep a long text from becoming its own dictionary, and bound memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import col, free_name

UNDETERMINED = "und"
_BETWEEN_WORDS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text that is compressed: lower case, one space for all that is no letter."""
    return _BETWEEN_WORDS.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder; a null id is never held out."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        texts_per_language: int = 160, bytes_per_text: int = 1024, max_bytes: int = 80 << 20) -> dict[str, bytes]:
    """Dictionary content by language, from a bounded sample of the labelled rows.

    The bound: for each label about twice ``texts_per_language`` ids and 32 of the smallest hashes are looked at, and that
    many different texts taken, of each the letters of ``bytes_per_text`` characters from a place that the id's hash
    gives.  With so many labels that all this were more than ``max_bytes``, each has fewer texts, one at least.  Rows
    without label or letter are passed over; no rows: no language.
    """
    rows = labelled.filter(col(lang_col).isNotNull() & col(text_col).rlike(r"\p{L}")).select(
        col(lang_col).cast("string").alias("lang"), F.xxhash64(col(id_col)).alias("h"), col(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a label
    if not counts:
        return {}
    texts = max(1, min(texts_per_language, max_bytes // (len(counts) * bytes_per_text)))
    # hashes are even, so the share of the range below a bound is the share of the ids
    last = labelled.sparkSession.createDataFrame(
        [(lang, min((1 << 64) * (2 * texts + 32) // n, (1 << 64) - 1) - (1 << 63)) for lang, n in sorted(counts.items())],
        "lang string, last long")
    if sum(len(lang.encode()) + 16 for lang in counts) <= 8 << 20:  # beyond, joined by shuffle
        last = F.broadcast(last)
    spread_out = F.regexp_replace("text", r"[^\p{L}]+", " ")
    place = F.pmod(F.xxhash64("h", F.lit(2)), F.greatest(F.char_length("spelt") - bytes_per_text, F.lit(0)) + 1)
    sample = rows.join(last, "lang").filter(F.col("h") <= F.col("last")).withColumn("spelt", spread_out).select(
        "lang", "h", F.substring("spelt", place.cast("int") + 1, F.lit(bytes_per_text)).alias("part")).groupBy(
        "lang", "h").agg(F.min("part").alias("part"))
    parts: dict[str, dict[str, None]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["h"])):
        if any(map(str.isalpha, r["part"])):
            parts.setdefault(r["lang"], {})[r["part"]] = None
    # the best matches are those nearest to the text, so the first picked go last
    return {lang: b" ".join(letters(p)[:bytes_per_text] for p in reversed(list(own)[:texts]))
            for lang, own in sorted(parts.items())}


class Classifier:
    """Compressed sizes of texts under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6, block: int = 2048, short: int = 96):
        import zstandard as z

        self.languages, self.block, self.short, self.compress = sorted(dictionaries), block, short, []
        for lang in self.languages:
            params = z.ZstdCompressionParameters.from_level(
                level, write_content_size=0, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
            content = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=params)
            self.compress.append(z.ZstdCompressor(compression_params=params, dict_data=content).compress)

    def sizes(self, text: str) -> list[int]:
        raw = letters(text)
        if len(raw) < self.short:  # too few bytes to save any: a text this short is compressed several times over
            raw = (raw.strip() + b" ") * -(-self.short // (len(raw) + 1))
        blocks = [raw[i:i + self.block] for i in range(0, len(raw), self.block)]
        return [sum(len(c(b)) for b in blocks) for c in self.compress]

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """Language, score and margin in bytes; ties go to the first language by name."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[0], 1.0, sizes[0]
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.languages[best], 1 - sizes[best] / second if second else 0.0, second - sizes[best]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_score: float = 0.005,
             prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score, margin_bytes, rejected, named with ``prefix`` and, where
    ``docs`` has such a column, with underscores added.

    score is the share of the second smallest size that the smallest saves (0 to 1).  Null texts
    and texts without a letter are ``und`` with score 0; they and texts with a
    score under ``min_score`` or no margin at all are rejected.  Without dictionaries every text is ``und``.
    Every row stays, with all its columns.
    """
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(dictionaries)
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "margin_bytes"])

    own = free_name(docs, "__language")
    out = docs.withColumn(own, F.pandas_udf(classify, "lang_pred string, score double, margin_bytes long")(
        col(text_col)))
    narrow = (F.col(own)["lang_pred"] == UNDETERMINED) | (F.col(own)["score"] < min_score) | (
        F.col(own)["margin_bytes"] <= 0)
    return out.select(*(col(c) for c in docs.columns),
                      *(F.col(own)[c].alias(free_name(docs, prefix + c)) for c in ("lang_pred", "score", "margin_bytes")),
                      narrow.alias(free_name(docs, prefix + "rejected")))
