"""Combining any number of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multijoin(tables: list[DataFrame], key: str) -> DataFrame:
    """Inner join of all tables on ``key``; other columns must have names of their own."""
    return reduce(lambda left, right: left.join(right, key), tables)


def stack_inputs(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables, with the number of their table in ``file_ord``."""
    marked = [t.withColumn("file_ord", F.lit(i)) for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.unionByName(b), marked)
