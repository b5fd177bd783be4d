"""Files staged as tables in the order of position, so that a region read touches only what it needs.

A staged table is a folder of Parquet files, range-partitioned and sorted by contig and start. ``_index`` holds the
contigs, least start and greatest end of each file, ``_header`` the header lines. A read with regions
opens only the files that can hold rows of a region, and hands the regions to the scan as a predicate, which
skips row groups by their statistics. A long row only keeps its own row group from being skipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.session import file_system
from riftspan.sources.regions import Region
from riftspan.sources.textio import guard_output

PLACE = ["_contig", "_start", "_end"]
#: Spans that go into the predicate as they are; of more, the hull per contig, and for too many contigs nothing but the file list.
MOST_SPANS = 100
#: Row groups of 16 MB keep the stretch of a group short.
GROUP_BYTES = 16 << 20


def stage(
    rows: DataFrame, path: str, contig: str, start: Column, end: Column, header: list[str] = (), overwrite: bool = False
) -> None:
    """Write ``rows`` as a staged table; rows without a place come first and belong to no region."""
    spark = rows.sparkSession
    guard_output(spark, path, overwrite)
    placed = rows.withColumns({"_contig": F.col(contig), "_start": start.cast("long"), "_end": end.cast("long")})
    ordered = placed.repartitionByRange("_contig", "_start").sortWithinPartitions("_contig", "_start")
    ordered.write.mode("overwrite" if overwrite else "error").option("parquet.block.size", GROUP_BYTES).parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    file = F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1)
    index = written.filter("_contig is not null").groupBy(file.alias("file"), "_contig").agg(F.min("_start").alias("first"), F.max("_end").alias("last"))
    index.coalesce(1).write.parquet(f"{path}/_index")
    lines = [(i, line) for i, line in enumerate(header)]
    spark.createDataFrame(lines, "i int, line string").coalesce(1).write.parquet(f"{path}/_header")


def is_staged(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a staged table."""
    system, place = file_system(spark, f"{path.rstrip('/')}/_index")
    return system.exists(place)


def staged_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines of the file that was staged."""
    return [r["line"] for r in spark.read.parquet(f"{path}/_header").orderBy("i").collect()]


def spans(regions: list[Region]) -> list[Region]:
    """Regions merged to disjoint spans per contig."""
    merged: list[Region] = []
    for r in sorted(regions, key=lambda r: (r.contig, r.start)):
        last = merged[-1] if merged else None
        if last and last.contig == r.contig and (last.end is None or r.start <= last.end):
            end = None if last.end is None or r.end is None else max(last.end, r.end)
            merged[-1] = Region(r.contig, last.start, end)
        else:
            merged.append(r)
    return merged


def _hulls(merged: list[Region]) -> list[Region]:
    out: dict[str, Region] = {}
    for r in merged:
        known = out.get(r.contig, r)
        end = None if known.end is None or r.end is None else max(known.end, r.end)
        out[r.contig] = Region(r.contig, min(known.start, r.start), end)
    return list(out.values())


def _touches(r: Region, contig: str, start: str, end: str) -> Column:
    hit = (F.col(contig) == r.contig) & (F.col(end) > r.start)
    return hit if r.end is None else hit & (F.col(start) < r.end)


def read_staged(spark: SparkSession, path: str, regions: list[Region] | None = None) -> DataFrame:
    """Rows of a staged table; with ``regions`` at least all rows that overlap one (:func:`fetch_regions` decides which do)."""
    every = spark.read.parquet(path)
    columns = [c for c in every.columns if c not in PLACE]
    if regions is None:
        return every.select(*columns)
    merged = spans(regions)
    table = spark.createDataFrame([(r.contig, r.start, r.end) for r in merged], "_contig string, _lo bigint, _hi bigint")
    index = spark.read.parquet(f"{path}/_index")
    hit = (F.col("last") > F.col("_lo")) & (F.col("_hi").isNull() | (F.col("first") < F.col("_hi")))
    files = [r["file"] for r in index.join(table, "_contig").filter(hit).select("file").distinct().collect()]
    if not files:
        return every.select(*columns).limit(0)
    found = spark.read.schema(every.schema).parquet(*sorted(f"{path}/{f}" for f in files))
    terms = merged if len(merged) <= MOST_SPANS else _hulls(merged)
    if len(terms) <= MOST_SPANS:
        found = found.filter(reduce(lambda a, b: a | b, [_touches(r, *PLACE) for r in terms]))
    return found.select(*columns)
