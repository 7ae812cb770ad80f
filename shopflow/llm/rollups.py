"""Token-count rollups kept by deltas: signed changes, additive totals, idempotent commits.

A batch of changes is summed to one signed row per source, language and tokenizer
version and written to ``<root>/batches/<id>``; Spark's ``_SUCCESS`` file is its commit.
A batch that is committed already is left as it is, one that failed half-way is
written again.  Totals are the sums over the committed batches.  ``compact`` folds them
into a base that remembers their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import col, free_name
from shopflow.llm.tokens import encoder

KEYS = ["source", "lang", "tokenizer"]
CHANGE = "source string, lang string, tokenizer string, documents long, tokens long"


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with, in place of the text, the number of ids of each whole text as its last
    column ``out`` (underscores added where it exists); null text: 0."""
    kept = docs.drop(text_col)
    out = free_name(kept, out)
    names = kept.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(vocabulary)
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            for first, _, offsets in model.encode(batch.column(len(names))):
                n[first:first + len(offsets) - 1] = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(n)], names=[*names, out])

    schema = kept.withColumn(out, F.lit(0).cast("long")).schema
    return docs.select(*(col(c) for c in names), col(text_col)).mapInArrow(count, schema)


def _changes(rows: DataFrame, sign: int, documents: int, tokens: str, prefix: str = "") -> DataFrame:
    return rows.select(*(col(prefix + k).cast("string").alias(k) for k in KEYS),
                       F.lit(sign * documents).cast("long").alias("documents"),
                       (F.coalesce(col(tokens), F.lit(0)) * sign).cast("long").alias("tokens"))


def inserts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Changes that add rows (source, lang, tokenizer, tokens); null keys are keys, null tokens none."""
    return _changes(rows, 1, 1, tokens)


def deletes(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Changes that take rows away as they were counted."""
    return _changes(rows, -1, 1, tokens)


def revisions(rows: DataFrame, tokens: str = "tokens", revised: str = "new_") -> DataFrame:
    """Changes that replace counted rows by their ``new_`` source, lang, tokenizer and tokens."""
    return _changes(rows, -1, 1, tokens).unionByName(_changes(rows, 1, 1, revised + tokens, revised))


class Rollup:
    """The rollup below one folder of the shared store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _list(self, path: str) -> list[str]:
        """Names below ``path`` that were written to the end."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(at):
            return []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(f.getPath().getName() for f in store.listStatus(at)
                      if store.exists(done(f.getPath(), "_SUCCESS")))

    def _base(self) -> tuple[str | None, set[str]]:
        versions = self._list(f"{self.root}/base")
        if not versions:
            return None, set()
        path = f"{self.root}/base/{versions[-1]}"
        merged = self.spark.read.parquet(path).select(F.explode("batches")).distinct().collect()
        return path, {r[0] for r in merged}

    def committed(self) -> set[str]:
        return self._base()[1] | set(self._list(f"{self.root}/batches"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch once; False if it was there already.  One writer at a time."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a batch id has letters, digits, - and _ only: {batch!r}")
        if batch in self.committed():
            return False
        summed = changes.groupBy(KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        summed.write.mode("overwrite").parquet(f"{self.root}/batches/{batch}")
        return True

    def _parts(self) -> tuple[list[str], set[str]]:
        base, merged = self._base()
        fresh = [b for b in self._list(f"{self.root}/batches") if b not in merged]
        return ([base] if base else []) + [f"{self.root}/batches/{b}" for b in fresh], merged | set(fresh)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens; keys without documents and tokens are left out."""
        paths, _ = self._parts()
        rows = (self.spark.read.schema(CHANGE).parquet(*paths) if paths
                else self.spark.createDataFrame([], CHANGE))
        return (rows.groupBy(KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
                .filter("documents <> 0 OR tokens <> 0"))

    def compact(self) -> None:
        """Fold the committed batches into a new base; batches of the base stay known."""
        paths, ids = self._parts()
        if not ids:
            return
        marks: Column = F.array(*(F.lit(b) for b in sorted(ids)))
        # a row of its own keeps the ids even where all keys have gone
        none = self.spark.range(1).select(*(F.lit(None).cast("string").alias(k) for k in KEYS),
                                          F.lit(0).cast("long").alias("documents"),
                                          F.lit(0).cast("long").alias("tokens"), marks.alias("batches"))
        version = len(self._list(f"{self.root}/base"))
        (self.totals().withColumn("batches", F.array().cast("array<string>")).unionByName(none)
         .write.mode("overwrite").parquet(f"{self.root}/base/{version:08d}"))
