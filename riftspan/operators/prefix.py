"""Counting points in ranges by prefix counts, without ever pairing ranges with points.

Points and range bounds are first reduced to one row per coordinate, so a bin holds at most
``width`` rows however many copies there are. A running sum inside each bin plus the total of all
earlier bins gives, for every bound, the number of points below it. Range counts are differences of
two bounds, and overlap counts are the difference of a count of starts and a count of ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riftspan.functions.interval import int_div

BIN_WIDTH = 4096


@dataclass(frozen=True)
class RangeCount:
    """One count to take per query row: points of ``series`` with ``lo <= x < hi``.

    Without ``lo`` all points below ``hi`` count.
    """

    name: str
    series: str
    lo: Column | None
    hi: Column


def sums_below(marks: DataFrame, by: Sequence[str], columns: Sequence[str], width: int = BIN_WIDTH) -> DataFrame:
    """For every coordinate of ``marks``: ``by``, ``_x``, and the sum of each of ``columns`` over smaller coordinates.

    ``marks`` has the columns ``by``, ``_x`` (bigint) and ``columns``. Bounds enter with zeros.
    """
    by = list(by)
    # Joins below would infer these conditions for one use of ``per_x`` only, and it would be computed twice.
    known = marks.dropna(subset=[*by, "_x"])
    per_x = (
        known.groupBy(*by, "_x")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .withColumn("_bin", int_div(F.col("_x"), width))
    )
    in_bin = W.partitionBy(*by, "_bin").orderBy("_x").rowsBetween(W.unboundedPreceding, -1)
    local = per_x.select(*by, "_bin", "_x", *[F.coalesce(F.sum(c).over(in_bin), F.lit(0)).alias(f"_local_{c}") for c in columns])
    # One row per bin: bounded by the length of the coordinate axis, not by the number of points.
    earlier = W.partitionBy(*by).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = per_x.groupBy(*by, "_bin").agg(*[F.sum(c).alias(c) for c in columns])
    bases = bins.select(*by, "_bin", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_base_{c}") for c in columns])
    return local.join(bases, [*by, "_bin"]).select(*by, "_x", *[(F.col(f"_base_{c}") + F.col(f"_local_{c}")).alias(c) for c in columns])


def points_below(marks: DataFrame, by: Sequence[str], width: int = BIN_WIDTH) -> DataFrame:
    """For every coordinate of ``marks``: ``(*by, _x, _below)``, the summed ``_n`` of smaller ones."""
    return sums_below(marks, by, ["_n"], width).withColumnRenamed("_n", "_below")


def count_in_ranges(
    queries: DataFrame,
    key: Sequence[str],
    group: str,
    points: DataFrame,
    x: str,
    counts: Sequence[RangeCount],
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Counts per query row: ``key`` columns plus one bigint column per :class:`RangeCount`.

    ``points`` has the columns ``group``, ``series`` (string) and ``x`` (bigint). ``key`` must be
    unique in ``queries``. Bounds are bigint columns over ``queries``.
    """

    def bound(c: RangeCount, sign: int, at: Column) -> Column:
        return F.struct(
            F.lit(c.name).alias("name"), F.lit(c.series).alias("series"), F.lit(sign).alias("sign"), at.cast("long").alias("q")
        )

    bounds = [bound(c, 1, c.hi) for c in counts] + [bound(c, -1, c.lo) for c in counts if c.lo is not None]
    asked = queries.select(*key, group, F.explode(F.array(*bounds)).alias("_l")).select(
        *key,
        group,
        F.col("_l.series").alias("series"),
        F.col("_l.q").alias("_x"),
        F.col("_l.name").alias("_name"),
        F.col("_l.sign").alias("_sign"),
    )
    by = [group, "series"]
    marks = points.select(*by, F.col(x).alias("_x"), F.lit(1).alias("_n")).unionByName(
        asked.select(*by, "_x", F.lit(0).alias("_n"))
    )
    below = points_below(marks, by, width)
    answered = asked.join(below, [*by, "_x"])
    return answered.groupBy(*key).agg(
        *[
            F.sum(F.when(F.col("_name") == c.name, F.col("_sign") * F.col("_below")).otherwise(F.lit(0)))
            .cast("long")
            .alias(c.name)
            for c in counts
        ]
    )


def interval_marks(intervals: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """Starts and ends of non-empty intervals as points ``(group, series, _px)``."""
    ends = F.array(
        F.struct(F.lit("start").alias("series"), F.col(start).cast("long").alias("_px")),
        F.struct(F.lit("end").alias("series"), F.col(end).cast("long").alias("_px")),
    )
    return (
        intervals.filter(F.col(end) > F.col(start))
        .select(group, F.explode(ends).alias("_p"))
        .select(group, "_p.series", "_p._px")
    )


def count_overlaps(
    queries: DataFrame,
    key: Sequence[str],
    group: str,
    span: tuple[Column, Column],
    intervals: DataFrame,
    interval_span: tuple[str, str],
    name: str = "n_overlaps",
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Number of ``intervals`` of the same ``group`` that overlap each query interval (``key``, ``name``).

    Those starting before the query ends, minus those that have ended by the time it starts.
    """
    counted = count_in_ranges(
        queries,
        key,
        group,
        interval_marks(intervals, group, *interval_span),
        "_px",
        [
            RangeCount("_started", "start", None, span[1]),
            RangeCount("_ended", "end", None, span[0] + 1),
        ],
        width,
    )
    return counted.select(*key, (F.col("_started") - F.col("_ended")).alias(name))
