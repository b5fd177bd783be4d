"""Anti-join of rows with blocked regions, by one lookup per location.

The coordinate axis of each contig is cut into bins. A bin knows the regions that start in it, how far the regions that
start before it reach, and where the next region behind it starts. That is all a location has to know that starts in
this bin, however long it is, and however long and nested the regions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riftspan.functions.interval import int_div
from riftspan.session import reliable_checkpoint

BIN_WIDTH = 32_768


def _bin(position: Column, width: int) -> Column:
    return int_div(F.greatest(position, F.lit(0).cast("long")), width)


def region_index(regions: DataFrame, width: int = BIN_WIDTH) -> DataFrame:
    """One row per contig and bin up to the last region's end: ``_bc``, ``_bb``, ``_reach``, ``_here``, ``_ahead``.

    ``_here`` holds the regions that start in the bin as ``(start, end)``: one for each start, the longest, so at most ``width``.
    Running values go over one row per bin, so the length of the contig bounds them and not the number of regions.
    """
    longest = (
        regions.select(F.col("contig").alias("_bc"), F.col("start").cast("long").alias("_s"), F.col("end").cast("long").alias("_e"))
        .filter("_bc is not null and _e >= _s")
        .groupBy("_bc", "_s")
        .agg(F.max("_e").alias("_e"))
    )
    filled = (
        longest.groupBy("_bc", _bin(F.col("_s"), width).alias("_bb"))
        .agg(F.collect_list(F.struct("_s", "_e")).alias("_here"), F.min("_s").alias("_first"), F.max("_e").alias("_last"))
    )
    # A bin with regions stands for the empty bins up to the next one, or up to where its contig's regions end.
    order = W.partitionBy("_bc").orderBy("_bb")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    known = filled.select(
        "_bc",
        "_bb",
        "_here",
        F.max("_last").over(before).alias("_reach"),
        F.max("_last").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("_reach_after"),
        F.lead("_first").over(order).alias("_ahead"),
        F.lag("_bb").over(order).isNull().alias("_leads"),
        "_first",
        F.lead("_bb").over(order).alias("_next"),
    )
    stop = F.coalesce("_next", _bin(F.col("_reach_after"), width) + 1)
    begin = F.when(F.col("_leads"), F.lit(0).cast("long")).otherwise(F.col("_bb"))
    laid_out = known.withColumn("_at", F.explode(F.sequence(begin, F.greatest(stop - 1, F.col("_bb")))))
    own, early = F.col("_at") == F.col("_bb"), F.col("_at") < F.col("_bb")
    return laid_out.select(
        "_bc",
        F.col("_at").alias("_bb"),
        F.when(own | early, F.col("_reach")).otherwise(F.col("_reach_after")).alias("_reach"),
        F.when(own, F.col("_here")).otherwise(F.expr("cast(array() as array<struct<_s:bigint,_e:bigint>>)")).alias("_here"),
        F.when(early, F.col("_first")).otherwise(F.col("_ahead")).alias("_ahead"),
    )


def drop_blocked(
    rows: DataFrame,
    locations: list[tuple[Column, Column, Column]],
    regions: DataFrame,
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Rows none of whose ``locations`` (contig, start, end) overlaps a region (contig, start, end).

    Overlap is tested as ``start < region end and region start < end``: an empty location, or an empty
    region, overlaps what it lies strictly inside of. A location with a NULL part, or one that ends before it starts, blocks nothing.

    The index of the regions is written, so that the planner knows its true size and broadcasts it only if it is small.
    """
    index = reliable_checkpoint(region_index(regions, width))
    result = rows
    for contig, start, end in locations:
        start, end = start.cast("long"), end.cast("long")
        here = F.exists("_here", lambda r: (r["_s"] < end) & (r["_e"] > start))
        hit = (F.coalesce(F.col("_reach") > start, F.lit(False)) | here | F.coalesce(F.col("_ahead") < end, F.lit(False))) & (start <= end)
        result = result.join(index, (contig == F.col("_bc")) & (_bin(start, width) == F.col("_bb")) & hit, "left_anti")
    return result
