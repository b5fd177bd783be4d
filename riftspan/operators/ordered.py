"""Running values over the order of a large table, in two levels.

A window over a whole table would run in one task. Here the caller names a ``block`` (a file split,
or a range of a dense order key) that bounds how many rows one task sees. Each block is scanned on
its own, the small table of block summaries gives what precedes every block, and both are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riftspan.session import reliable_checkpoint


def consecutive_runs(
    df: DataFrame, value: str, block: Sequence[str], order: Sequence[str], run: str = "run_id"
) -> DataFrame:
    """Number the maximal runs of equal ``value`` in row order, from zero, across all blocks.

    Rows are ordered by ``(*block, *order)``.
    """
    block, order = list(block), list(order)
    within = W.partitionBy(*block).orderBy(*order)
    previous = F.lag(value).over(within)
    first_row = F.row_number().over(within) == 1
    marked = df.withColumn("_new", F.when(first_row, 0).otherwise(F.when(previous.eqNullSafe(F.col(value)), 0).otherwise(1)))
    local = marked.withColumn("_local", F.sum("_new").over(within.rowsBetween(W.unboundedPreceding, 0)))

    position = F.struct(*order)
    ends = df.groupBy(*block).agg(
        F.min_by(value, position).alias("_first"), F.max_by(value, position).alias("_last")
    )
    starts = local.groupBy(*block).agg(F.sum("_new").alias("_starts"))
    summary = ends.join(starts, block)
    over_blocks = W.orderBy(*block)
    joint = F.when(F.lag("_last").over(over_blocks).isNull(), 0).otherwise(
        F.when(F.lag("_last").over(over_blocks) == F.col("_first"), 0).otherwise(1)
    )
    offsets = summary.withColumn("_joint", joint).select(
        *block,
        (
            F.sum(F.col("_joint") + F.col("_starts")).over(over_blocks.rowsBetween(W.unboundedPreceding, 0))
            - F.col("_starts")
        ).alias("_offset"),
    )
    return (
        local.join(offsets, block)
        .withColumn(run, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_new", "_local", "_offset")
    )


def global_row_number(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Number all rows from 1 in the given total order.

    Spark's range-partitioned sort splits heavy leading keys by the later ones. The sorted rows are
    checkpointed so that partition sizes and row positions come from one and the same sort.
    """
    in_order = reliable_checkpoint(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), 33)
    sizes = in_order.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per sort partition.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = in_order.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    position = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(name, F.col("_offset") + position + 1).drop("_mid", "_part", "_offset")


def running_total(
    df: DataFrame, amount: str, block: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """Sum of ``amount`` over all earlier rows in the order ``(*block, *order)``."""
    block, order = list(block), list(order)
    earlier_rows = W.partitionBy(*block).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(amount).over(earlier_rows), F.lit(0)))
    totals = df.groupBy(*block).agg(F.sum(amount).alias("_total"))
    earlier_blocks = W.orderBy(*block).rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(*block, F.coalesce(F.sum("_total").over(earlier_blocks), F.lit(0)).alias("_base"))
    return local.join(bases, block).withColumn(name, F.col("_base") + F.col("_local")).drop("_local", "_base")
