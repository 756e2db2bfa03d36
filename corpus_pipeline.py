"""The corpus pipeline: language, toxicity, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written
as Parquet before the next one reads it. All but the last return the columns of ``documents``.

Cases: rows with null ids stay unless a stage rejects their text; repeated rows of an id with the
same text become one in the near-copy stage; further columns are left out; empty tables stay so.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips.llm import language_id, minhash, packing, suffix_dedup, toxicity
from citytrips.llm.common import stored, table
from citytrips.llm.queries import PASSAGE, TOXIC

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CARRIED = COLUMNS[1:]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters go."""
    found = language_id.predict(docs, language_id.fit(docs), CARRIED)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), CARRIED)
    return found.where(F.col("score") < TOXIC).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages of PASSAGE bytes or more that occur more than once."""
    found = suffix_dedup.remove_repeats(docs, ("lang", "source"), PASSAGE)
    return found.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", clean),
    ("near_duplicates", distinct),
    ("repeated_passages", passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fitted models and byte-exact packing have no SQL form; the tests hold stages against brute force.
ORACLE_SQL = None
