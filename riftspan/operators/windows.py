"""Tumbling genomic windows and base-wise depth inside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riftspan.functions.interval import int_div

#: Windows generated per spine row in the first of two steps.
SPINE_CHUNK = 8192


def window_spine(contigs: DataFrame, by: Sequence[str], length: str, window: int) -> DataFrame:
    """Every window ``(*by, window_id)`` of every contig, the last one possibly short.

    Window numbers are generated in two steps so that a long contig is spread over many tasks.
    """
    chunks = contigs.filter(F.col(length) > 0).select(
        *by,
        int_div(F.col(length) - 1, window).alias("_last"),
    )
    chunks = chunks.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, _last div {SPINE_CHUNK})")))
    spread = chunks.repartition(*by, "_chunk")
    ids = F.expr(f"sequence(_chunk * {SPINE_CHUNK}, least(_last, (_chunk + 1) * {SPINE_CHUNK} - 1))")
    return spread.select(*by, F.explode(ids).alias("window_id"))


def depth_by_window(alignments: DataFrame, by: Sequence[str], window: int) -> DataFrame:
    """Base-wise depth statistics of every window that an alignment touches.

    ``alignments`` has the columns ``by``, ``start``, ``end`` (half-open, from zero) and ``mapq``. Result:
    ``window_id``, ``depth_sum``, ``depth_sq_sum`` (sums over positions of depth and its square) and
    ``mapq_sum`` (mapping quality weighted by base).

    An alignment is two rows, its start and its end, however many windows it spans. Changes of depth are added up per position and
    summed inside their window; the depth that a window begins with is carried in by running sums over windows, in two
    levels. Windows without a change lie between two with one and have the depth in between.
    """
    by = list(by)
    start, end = (F.greatest(F.col(c).cast("long"), F.lit(0).cast("long")) for c in ("start", "end"))
    mapq = F.col("mapq").cast("long")
    changes = alignments.filter(end > start).dropna(subset=by).select(
        *by,
        F.explode(
            F.array(
                F.struct(start.alias("at"), F.lit(1).alias("d"), mapq.alias("q")),
                F.struct(end.alias("at"), F.lit(-1).alias("d"), (-mapq).alias("q")),
            )
        ).alias("_c"),
    )
    per_position = changes.groupBy(*by, F.col("_c.at").alias("_x")).agg(F.sum("_c.d").alias("_d"), F.sum("_c.q").alias("_q"))
    placed = per_position.withColumn("window_id", int_div(F.col("_x"), window))
    order = W.partitionBy(*by, "window_id").orderBy("_x")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    run = F.coalesce(F.lead("_x").over(order), (F.col("window_id") + 1) * window) - F.col("_x")
    runs = placed.select(
        *by, "window_id", "_d", "_q", F.sum("_d").over(so_far).alias("_depth"), F.sum("_q").over(so_far).alias("_mapq"), run.alias("_run")
    )
    # What the changes of a window add inside it, and to all windows after it.
    inside = (
        runs.groupBy(*by, "window_id")
        .agg(
            F.sum("_d").alias("_d"),
            F.sum("_q").alias("_q"),
            F.sum(F.col("_depth") * F.col("_run")).alias("_sum"),
            F.sum(F.col("_depth") * F.col("_depth") * F.col("_run")).alias("_sq"),
            F.sum(F.col("_mapq") * F.col("_run")).alias("_msum"),
        )
        .withColumn("_chunk", int_div(F.col("window_id"), SPINE_CHUNK))
        # The join below would infer this for one of its sides only, and all before would be computed twice.
        .filter(F.col("_chunk").isNotNull())
    )
    over_chunks = W.partitionBy(*by).orderBy("_chunk")
    before = over_chunks.rowsBetween(W.unboundedPreceding, -1)
    chunks = inside.groupBy(*by, "_chunk").agg(F.sum("_d").alias("_d"), F.sum("_q").alias("_q"), F.min("window_id").alias("_first"))
    carried = chunks.select(
        *by,
        "_chunk",
        F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_base_d"),
        F.coalesce(F.sum("_q").over(before), F.lit(0)).alias("_base_q"),
        F.lead("_first").over(over_chunks).alias("_next_chunk"),
    )
    in_chunk = W.partitionBy(*by, "_chunk").orderBy("window_id")
    earlier = in_chunk.rowsBetween(W.unboundedPreceding, -1)
    here = inside.select(
        "*",
        F.coalesce(F.sum("_d").over(earlier), F.lit(0)).alias("_in_d"),
        F.coalesce(F.sum("_q").over(earlier), F.lit(0)).alias("_in_q"),
        F.lead("window_id").over(in_chunk).alias("_next"),
    ).join(carried, [*by, "_chunk"])
    depth, quality = F.col("_base_d") + F.col("_in_d"), F.col("_base_q") + F.col("_in_q")
    after, after_q = depth + F.col("_d"), quality + F.col("_q")
    stop = F.coalesce("_next", "_next_chunk", F.col("window_id") + 1)
    own = F.struct(
        F.col("window_id").alias("window_id"),
        (depth * window + F.col("_sum")).alias("depth_sum"),
        (depth * depth * window + 2 * depth * F.col("_sum") + F.col("_sq")).alias("depth_sq_sum"),
        (quality * window + F.col("_msum")).alias("mapq_sum"),
    )
    between = F.when((after > 0) & (stop > F.col("window_id") + 1), F.sequence(F.col("window_id") + 1, stop - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    rest = F.transform(
        between,
        lambda w: F.struct(
            w.alias("window_id"), (after * window).alias("depth_sum"), (after * after * window).alias("depth_sq_sum"), (after_q * window).alias("mapq_sum")
        ),
    )
    return here.select(*by, F.explode(F.concat(F.array(own), rest)).alias("_w")).select(*by, "_w.*").filter("depth_sum > 0")
