"""Column names and evolving schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snake_case(name: str) -> str:
    """``PULocationID`` → ``pu_location_id``, ``PUlocationID`` → ``p_ulocation_id``."""
    words = re.sub(r"([a-z\d])([A-Z])", r"\1_\2", re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name))
    return re.sub(r"\W+", "_", words).strip("_").lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Snake-case column names."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType, extra: bool = False) -> DataFrame:
    """Project to the declared schema, nulls for missing columns.

    Text that does not parse becomes null rather than failing the load. ``extra`` keeps the
    columns the schema does not know, after the declared ones.
    """
    known = {f.name for f in schema.fields}
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            source = F.col(field.name)
            text = isinstance(df.schema[field.name].dataType, T.StringType)
            value = source.try_cast(field.dataType) if text else source.cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    if extra:
        columns += [F.col(c) for c in df.columns if c not in known]
    return df.select(*columns)


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of monthly frames; a column that only some months have is null in the others."""
    if not frames:
        raise ValueError("no month could be read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
