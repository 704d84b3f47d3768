import pytest
from pyspark.sql import types as T

from wattlake.llm.workers import reachable

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text, source), with columns whose names operators use inside."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("source", T.StringType()),
            *[T.StructField(x, T.StringType()) for x in ("id", "at", "digest", "node", "_rank", "shard")],
        ]
    )
    return lambda rows, parts=3: spark.createDataFrame(
        [(*row, *(["other"] * 6)) for row in rows], schema
    ).repartition(parts)


#: Nulls in every column, empty and very long texts, ties, repeated rows.
ODD = [
    (1, "Hello World", "a"),
    (2, "hello world", "a"),
    (2, "hello world", "a"),
    (3, None, "b"),
    (4, "", None),
    (5, "   \n\t", "b"),
    (None, "hello WORLD", "b"),
    (None, None, None),
    (6, LONG, "c"),
    (7, LONG + " end", "c"),
    (8, "ÀÉ hello", "c"),
    (9, "àé hello", "c"),
    (10, "a b c", None),
    (11, "A  b\nc", "a"),
    (12, "<|endoftext|> x <|im_end|>", "a"),
    (12, "another text with the same id", "a"),
]


@pytest.fixture
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture
def none(docs_of):
    return docs_of([])
