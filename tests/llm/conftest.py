from __future__ import annotations

import pytest
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                        StructField("source", StringType()), StructField("n_chars", LongType()), StructField("score", StringType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType()), StructField("text", StringType())])
VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())), StructField("label", IntegerType()), StructField("id", StringType())])
PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType()), StructField("digest", StringType())])


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, lang); the further column has a clashing name."""
    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]), "x") for r in rows], DOCUMENTS)
    return make


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame([(*r, "y") for r in rows], LABELS)


@pytest.fixture
def vectors(spark):
    return lambda *rows: spark.createDataFrame([(*r, "z") for r in rows], VECTORS)


@pytest.fixture
def pages(spark):
    return lambda *rows: spark.createDataFrame([(*r, "w") for r in rows], PAGES)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
