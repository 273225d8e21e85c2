import pytest
from cases import FILL, SCHEMA, sentence


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeats, and clashing names."""
    texts = [
        (1, sentence(1, 120)),
        (1, sentence(1, 120)),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (None, sentence(2, 80)),
        (None, None),
        (5, sentence(3, 60_000)),
        (6, "x" * 200_000),
        (7, "日本語のテキスト 🙂 mail a.b@c.de"),
        (8, "12345 !!! ###"),
        (9, sentence(1, 120)),
    ]
    rows = [(i, text, *FILL) for i, text in texts]
    rows.append((10, sentence(4, 50), *[None] * len(FILL)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small_tables):
    return spark.read.parquet(f"{small_tables}/documents.parquet")
