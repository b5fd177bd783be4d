"""Windowed depth of coverage, reference composition, and depth medians."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riftspan.config import DepthSettings
from riftspan.functions.interval import float_ratio
from riftspan.functions.reads import coverage_row, fragment_centre, fragment_row
from riftspan.operators.quantiles import exact_quantiles
from riftspan.operators.windows import depth_by_window, window_spine

# Contig names that count as autosomes, and those that get a median besides them.
AUTOSOMES = [*[str(i) for i in range(1, 23)], *[f"chr{i}" for i in range(1, 23)], "one", "two"]
ALLOSOMES = ["X", "Y", "chrX", "chrY"]


def fragment_windows(alignments: DataFrame, contigs: DataFrame, settings: DepthSettings) -> DataFrame:
    """Fragments per window, every window included: ``contig``, ``window_id``, ``cov``, ``cov_sd``, ``mean_mapq``.

    Windows without fragments enter the grouping as zero rows, which saves a join with the spine. A
    fragment whose centre lies beyond the contig's end counts nowhere.
    """
    w = settings.window_length
    centre = fragment_centre(F.col("end"))
    counted = alignments.filter(fragment_row(settings.min_mapq, settings.min_unclipped)).select(
        "contig", F.floor(centre / F.lit(w)).cast("long").alias("window_id"), F.lit(1).alias("_n"), F.col("mapq").cast("long").alias("_q"), F.lit(False).alias("_real")
    )
    empty = window_spine(contigs, ["contig"], "length", w).select(
        "contig", "window_id", F.lit(0).alias("_n"), F.lit(0).cast("long").alias("_q"), F.lit(True).alias("_real")
    )
    sums = counted.unionByName(empty).groupBy("contig", "window_id").agg(
        F.sum("_n").alias("_n"), F.sum("_q").alias("_q"), F.max("_real").alias("_real")
    )
    return sums.filter("_real").select(
        "contig",
        "window_id",
        F.col("_n").cast("float").alias("cov"),
        F.lit(None).cast("float").alias("cov_sd"),
        F.coalesce(float_ratio(F.col("_q"), F.col("_n")), F.lit(0.0).cast("float")).alias("mean_mapq"),
    )


def coverage_windows(alignments: DataFrame, contigs: DataFrame, settings: DepthSettings) -> DataFrame:
    """Mean and deviation of base coverage per window, and base-weighted mapping quality.

    The divisor is the full window length even where the contig ends inside the window. Bases in
    windows beyond the contig's end count nowhere.
    """
    w = settings.window_length
    rows = alignments.filter(coverage_row(settings.min_mapq)).select(
        "contig", F.col("pos").alias("start"), "end", "mapq"
    )
    touched = depth_by_window(rows, ["contig"], w).withColumn("_real", F.lit(False))
    empty = window_spine(contigs, ["contig"], "length", w).select(
        "contig", "window_id", *[F.lit(0).cast("long").alias(c) for c in ("depth_sum", "depth_sq_sum", "mapq_sum")], F.lit(True).alias("_real")
    )
    sums = touched.unionByName(empty).groupBy("contig", "window_id").agg(
        *[F.sum(c).alias(c) for c in ("depth_sum", "depth_sq_sum", "mapq_sum")], F.max("_real").alias("_real")
    ).filter("_real")
    mean = F.col("depth_sum") / F.lit(w)
    variance = (F.col("depth_sq_sum") - F.col("depth_sum") * mean) / F.lit(max(w - 1, 1))
    deviation = F.sqrt(F.greatest(variance, F.lit(0.0))) if w > 1 else F.lit(0.0)
    return sums.select(
        "contig",
        "window_id",
        mean.cast("float").alias("cov"),
        deviation.cast("float").alias("cov_sd"),
        F.coalesce(float_ratio(F.col("mapq_sum"), F.col("depth_sum")), F.lit(0.0).cast("float")).alias("mean_mapq"),
    )


def count_rows(alignments: DataFrame, settings: DepthSettings, counters: Observation) -> DataFrame:
    """``alignments``, of which the next action on them counts the rows ``processed`` and those ``skipped``, which add to no window.

    The counts come with the action's own pass over the rows, and a task that is run again does not count twice.
    """
    if settings.count_kind == "coverage":
        adds = coverage_row(settings.min_mapq)
    else:
        adds = fragment_row(settings.min_mapq, settings.min_unclipped)
    skipped = F.count_if(~F.coalesce(adds, F.lit(False)))
    return alignments.observe(counters, F.count(F.lit(1)).alias("processed"), skipped.alias("skipped"))


def counted_rows(counters: Observation) -> tuple[int, int] | None:
    """Rows processed and skipped by an action that has ended; None if its plan came to need no rows (nothing lies in the regions)."""
    try:
        found = counters.get
    except Py4JJavaError:  # the observation has no values
        return None
    return found["processed"], found["skipped"]


def depth_windows(alignments: DataFrame, contigs: DataFrame, settings: DepthSettings) -> DataFrame:
    """Windows of the configured kind; ``contigs`` has ``contig`` and ``length``."""
    kinds = {"coverage": coverage_windows, "fragments": fragment_windows}
    if settings.count_kind not in kinds:
        raise ValueError(f"unknown count kind: {settings.count_kind}")
    return kinds[settings.count_kind](alignments, contigs, settings)


def composition(pieces: DataFrame, by: list[str], text: str) -> DataFrame:
    """G/C share among A, C, G, T (NULL if there are none) and presence of N, per window.

    ``pieces`` holds sequence pieces that each lie within one window ``by``.
    """

    def without(column: Column, letters: str) -> Column:
        return reduce(lambda c, letter: F.replace(c, F.lit(letter)), letters, column)

    length = F.length(text)
    staged = pieces.withColumn("_no_gc", without(F.col(text), "gcGC")).withColumn("_rest", without(F.col("_no_gc"), "atAT"))
    sums = staged.select(
        *by,
        (length - F.length("_no_gc")).cast("long").alias("_gc"),
        (length - F.length("_rest")).cast("long").alias("_acgt"),
        (F.contains("_rest", F.lit("n")) | F.contains("_rest", F.lit("N"))).alias("_gap"),
    ).groupBy(*by).agg(F.sum("_gc").alias("_gc"), F.sum("_acgt").alias("_acgt"), F.max("_gap").alias("has_gap"))
    return sums.select(*by, float_ratio(F.col("_gc"), F.col("_acgt")).alias("gc"), "has_gap")


def with_composition(windows: DataFrame, reference: DataFrame) -> DataFrame:
    """Add ``gc`` and ``has_gap`` of the reference to depth windows."""
    return windows.join(reference, ["contig", "window_id"], "left")


def depth_medians(windows: DataFrame, autosomes: list[str], allosomes: list[str]) -> DataFrame:
    """Median coverage per known contig and over all autosomes (row ``autosomes``): ``name``, ``median``.

    Each window enters under its contig and, on an autosome, also under the common name; both kinds
    of median come from one pass.
    """
    names = F.array(
        F.col("contig"), F.when(F.col("contig").isin(autosomes), F.lit("autosomes"))
    )
    named = (
        windows.filter(F.col("contig").isin(autosomes + allosomes))
        .select(F.explode(names).alias("name"), F.col("cov").cast("double").alias("cov"))
        .filter(F.col("name").isNotNull())
    )
    return exact_quantiles(named, ["name"], "cov", {"median": 0.5})
