import pytest
from pyspark.sql import types as T

from ..conftest import SF_SMALL


@pytest.fixture(scope="session")
def docs_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


#: Ids, texts and sources of every odd kind; columns that clash with names used inside.
ODD = [
    (None, "one two three four five six", "en", None),
    (1, None, None, "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", "en", "a"),
    (4, "one two three four five six", "en", "b"),
    (4, "one two three four five six", "en", "b"),
    (5, "one two", None, "b"),
    (6, "ONE TWO", "de", "b"),
    (7, "123 456 ___ +++", "xx", "b"),
    (8, "word " * 60_000, "en", "a"),
    (9, " ".join(f"w{i}" for i in range(40_000)), "en", "a"),
    (10, "ärger für öl " * 40, "de", "c"),
]
ODD_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("node", T.StringType()),
        T.StructField("root", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("tokens", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("h", T.StringType()),
        T.StructField("block", T.StringType()),
    ]
)


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame([r + (1, "x", "x", "x", "x", "x", "x", "x", "x") for r in ODD], ODD_SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
