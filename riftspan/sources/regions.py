"""Region lists from the command line, BED files, and selecting rows by region."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.errors import InvalidBedFile, InvalidRegion


@dataclass(frozen=True)
class Region:
    """Zero-based half-open interval on a contig; without an end it reaches to the end of the contig."""

    contig: str
    start: int
    end: int | None


def parse_region(text: str, compat: bool = False) -> Region:
    """Parse ``contig:start-end``.

    Text positions are one-based and inclusive. ``compat`` takes the start as it is and finds the
    pattern anywhere in the text, with letters and digits only in the contig name.
    """
    if compat:
        match = re.search(r"([0-9A-Za-z]+):([0-9]+)-([0-9]+)", text)
        shift = 0
    else:
        match = re.fullmatch(r"\s*(.+):([0-9,_]+)-([0-9,_]+)\s*", text)
        shift = 1
    if match is None:
        raise InvalidRegion(text)
    start, end = (int(match.group(i).replace(",", "").replace("_", "")) for i in (2, 3))
    return Region(match.group(1), max(start - shift, 0), end)


def parse_regions(text: str, compat: bool = False) -> list[Region]:
    """Parse a comma-separated list of regions."""
    return [parse_region(part, compat) for part in text.split(",")]


def region_table(spark: SparkSession, regions: list[Region]) -> DataFrame:
    """Regions as a table with their place in the list."""
    rows = [(i, r.contig, r.start, r.end) for i, r in enumerate(regions)]
    return spark.createDataFrame(rows, "region_ord int, contig string, start bigint, end bigint")


def whole_contigs(contigs: list[tuple[str, int | None]]) -> list[Region]:
    """One region per contig; without a length it is open-ended."""
    return [Region(name, 0, length) for name, length in contigs]


def fetch_regions(rows: DataFrame, regions: DataFrame, contig: str, start: Column, end: Column) -> DataFrame:
    """Rows overlapping a region, once per region they overlap, with ``region_ord``.

    The region list comes from the command line or a header, so it is small by nature.
    """
    places = regions.select(
        "region_ord", F.col("contig").alias("_rc"), F.col("start").alias("_rs"), F.col("end").alias("_re")
    )
    hit = (F.col(contig) == F.col("_rc")) & (F.col("_re").isNull() | (start < F.col("_re"))) & (end > F.col("_rs"))
    return rows.join(F.broadcast(places), hit).drop("_rc", "_rs", "_re")


def read_bed(spark: SparkSession, path: str, contigs: list[str]) -> DataFrame:
    """Regions ``(contig, start, end)``; a short line or an unknown contig is an error."""
    fields = F.split("value", "\t")
    known = spark.createDataFrame([(c,) for c in contigs], "_known string").distinct()
    lines = spark.read.text(path).select("value", fields.alias("f"))
    checked = lines.join(known, F.get("f", F.lit(0)) == F.col("_known"), "left")
    bad = F.when(F.size("f") < 3, F.concat(F.lit("too few fields: "), F.col("value"))).when(
        F.col("_known").isNull(), F.concat(F.lit("unknown contig: "), F.get("f", F.lit(0)))
    )
    first_bad = checked.select(bad.alias("bad")).filter("bad IS NOT NULL").first()
    if first_bad is not None:
        raise InvalidBedFile(first_bad["bad"])
    return lines.select(
        F.get("f", F.lit(0)).alias("contig"),
        F.get("f", F.lit(1)).cast("bigint").alias("start"),
        F.get("f", F.lit(2)).cast("bigint").alias("end"),
    )
