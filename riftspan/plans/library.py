"""Insert-size model of a sequencing library."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riftspan.config import Config
from riftspan.functions.reads import library_sample
from riftspan.operators.quantiles import leading_rows, values_at_ranks

#: Read length assumed where the header gives none.
ASSUMED_READ_LENGTH = 150


@dataclass(frozen=True)
class LibraryProperties:
    """Read length and insert-size statistics that decide what counts as normal."""

    max_rlen: int
    median_isize: float
    std_dev_isize: float
    max_normal_isize: int


def first_pairs(alignments: DataFrame, order: list[str], n: int) -> DataFrame:
    """Insert sizes of the first ``n`` clean pairs by ``order``, whose first column is a number."""
    clean = alignments.filter(library_sample()).select(*order, "tlen")
    return leading_rows(clean, order[0], n).orderBy(*order).limit(n).select("tlen")


def insert_size_model(sampled: DataFrame, config: Config) -> DataFrame:
    """One row with the columns of :class:`LibraryProperties` from the sampled insert sizes ``tlen``.

    The median is the upper of two middle values, and the deviation is taken about it after
    trimming outliers.
    """
    sampled = sampled.select(F.col("tlen").cast("double").alias("tlen"))
    middle = values_at_ranks(sampled, [], "tlen", {"median": F.expr("_n div 2")}).select("median")
    median = middle.scalar()
    reach = F.lit(config.library_cutoff_deviation * config.library_cutoff_sd_mult) * median
    spread = (
        sampled.filter((F.col("tlen") >= median - reach) & (F.col("tlen") <= median + reach))
        .withColumn("_median", median)
        .agg(
            F.max("_median").alias("median_isize"),
            F.sqrt(F.avg(F.pow(F.col("tlen") - F.col("_median"), 2))).alias("std_dev_isize"),
        )
    )
    normal = F.ceil(F.col("median_isize") + F.lit(config.lib_estimation_sd_mult) * F.col("std_dev_isize"))
    return spread.select(
        F.lit(ASSUMED_READ_LENGTH).cast("bigint").alias("max_rlen"),
        "median_isize",
        "std_dev_isize",
        normal.cast("bigint").alias("max_normal_isize"),
    )


def sample_size(config: Config) -> int:
    """One pair more than configured is used."""
    return config.lib_estimation_sample_size + 1


def estimate_library(alignments: DataFrame, config: Config, compat: bool = False) -> LibraryProperties:
    """Model from all clean pairs.

    ``compat`` takes only the first ones of the file, as many as configured. Without a sort, ``limit`` reads a
    file split by split and stops early.
    """
    sampled = alignments.filter(library_sample()).select("tlen")
    if compat:
        sizes = sampled.limit(sample_size(config)).collect()
        sampled = alignments.sparkSession.createDataFrame(sizes, "tlen bigint")
    model = insert_size_model(sampled, config).first()
    if model["median_isize"] is None:
        raise ValueError("no clean read pairs in the input")
    return LibraryProperties(**model.asDict())


def library_from_header(header: list[str], config: Config, compat: bool = False) -> LibraryProperties | None:
    """Properties noted in the first ``@RG`` line that carries them all.

    ``compat`` reproduces two slips of the original behaviour: the read length is taken from the
    insert-size field, and the normal limit adds the multiplier instead of multiplying by it.
    """
    for line in header:
        if not line.startswith("@RG"):
            continue
        fields = dict(t.split(":", 1) for t in line.split("\t")[1:] if ":" in t)
        if not {"PI", "PS"} <= fields.keys() or not (compat or "PR" in fields):
            continue
        median, deviation = float(fields["PI"]), float(fields["PS"])
        k = config.lib_estimation_sd_mult
        limit = median + deviation + k if compat else median + k * deviation
        read_length = int(float(fields["PI" if compat else "PR"]))
        return LibraryProperties(read_length, median, deviation, math.ceil(limit))
    return None
