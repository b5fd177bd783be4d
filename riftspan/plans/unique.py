"""Removal of repeated alignments from a file grouped by template name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riftspan.functions.flags import FIRST, has_flag
from riftspan.operators.ordered import consecutive_runs


def first_of_duplicates(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row, by ``order``, for every value of ``key``.

    The minimum is formed before the shuffle, so a group of many copies reaches one task as a few rows.
    """
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def unique_reads(alignments: DataFrame, block: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per template run, mate number and position; add the run number ``read_id``.

    Rows follow each other in the order ``(*block, *order)``; a run is a stretch of equal names.
    """
    runs = consecutive_runs(alignments, "qname", block, order, "read_id")
    marked = runs.withColumn("_mate", has_flag(FIRST))
    kept = first_of_duplicates(marked, ["read_id", "_mate", "tid", "pos"], [*block, *order])
    return kept.drop("_mate")
