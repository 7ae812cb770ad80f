"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes the documents that its predecessor kept, with their columns, and
calls one operator; its output is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopflow.llm import exact, langid, mixing, packing, simhash
from shopflow.llm.common import col, free_name, materialise
from shopflow.llm.queries import table
from shopflow.session import import_in_workers

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold; rejected documents go.

    Null texts and texts without a letter are rejected, as is every text where no document has a label.  Repeated
    rows are judged alike.  Columns stay as they are; an empty table gives an empty one.
    """
    import_in_workers(spark)
    prefix = free_name(docs, "__language_")
    judged = langid.identify(docs, langid.fit(docs.filter(~langid.held_out())), prefix=prefix)
    return judged.filter(~col(prefix + "rejected")).select(*(col(c) for c in docs.columns))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays; a null id only where the group has no other.

    Null text is empty text.  Of rows that repeat id and text, the one with the smallest hash of all columns stays.
    """
    import_in_workers(spark)
    return exact.drop_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays; a null id only where the group has no other.

    Texts without a word, null ones too, have fingerprint zero and are one group; repeated rows leave one.
    """
    import_in_workers(spark)
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to the power 0.7 of their sizes; a document comes as often as it is drawn, perhaps never.

    Null is a source of its own; rows with one id, null too, draw the same number.
    """
    import_in_workers(spark)
    replica = free_name(docs, "__replica")
    return mixing.mix(docs, replica=replica).drop(replica)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids; null and empty texts are the end id alone, repeated rows are packed each."""
    import_in_workers(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: compression, SimHash and the tokenizer have no SQL form; tests/llm holds a brute-force pipeline against run()
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
