import pytest

from shopflow.session import import_in_workers


@pytest.fixture(autouse=True)
def workers(spark):
    import_in_workers(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty, blank and long texts, near and exact copies, repeated rows, clashing names."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix jugs of liquid"
    long = " ".join(f"word{i % 977} about {i % 13}" for i in range(6000))
    rows = [
        (1, base, "en", "a"), (2, base.replace(" ", "\t\n"), "en", "a"), (3, base + " dog", "en", "b"),
        (4, None, None, None), (5, "", "en", "a"), (6, " \n ", "de", "b"), (7, long, "en", "c"),
        (7, long, "en", "c"), (None, base, "en", "a"), (None, "nur ein satz", "de", "a"), (8, "123 !!", "en", "a"),
        (9, "der schnelle braune fuchs springt und der hund schläft", "de", "b"), (10, long + " end", "en", None),
        (11, "Größe İ ΑΣ 漢字 it's \x1c don't", "de", "a"),
    ]
    cols = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, cols)
    extra = ("shard", "fp", "digest", "replica", "score", "tokens", "__row", "__source", "u", "v", "n")
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(7).alias(c) for c in extra))


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
