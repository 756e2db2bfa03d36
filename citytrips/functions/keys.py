"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citytrips.rules import NULL_KEY_TEXT


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the text of the parts joined by ``-``; a null part has a placeholder."""
    texts = [
        F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(NULL_KEY_TEXT))
        for p in parts
    ]
    return F.md5(F.concat_ws("-", *texts))
