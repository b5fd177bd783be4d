"""SAM text files. Binary BAM files are read by :mod:`riftspan.sources.bam`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.functions.cigar import clip_columns, end_position
from riftspan.sources.headers import Contig, alignment_contigs, contig_table
from riftspan.sources.regions import Region
from riftspan.sources.staged import is_staged, read_staged, staged_header
from riftspan.sources.textio import ORDER, read_header, read_lines, without_header, write_lines

#: Contig tables up to this size are broadcast.
BROADCAST_CONTIGS = 500_000


def alignment_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines of a SAM or BAM file, or of one that was staged."""
    if is_staged(spark, path):
        return staged_header(spark, path)
    if path.endswith(".bam"):
        from riftspan.sources.bam import bam_header

        return bam_header(path)
    return read_header(spark, path, "@")


def parse_alignments(lines: DataFrame, contigs: list[Contig]) -> DataFrame:
    """Alignment columns from SAM lines in ``value``; order columns are kept."""
    spark = lines.sparkSession
    table = contig_table(spark, contigs).select("contig", "tid")
    small = F.broadcast if len(contigs) <= BROADCAST_CONTIGS else (lambda t: t)
    f = F.col("f")
    tags = F.map_from_entries(
        F.transform(
            F.slice(f, F.lit(12), F.size(f)), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t)))
        )
    )

    def number(i: int, kind: str) -> Column:
        return F.get(f, F.lit(i)).cast(kind)

    name = F.get(f, F.lit(2))
    mate = F.get(f, F.lit(6))
    seq = F.get(f, F.lit(9))
    rows = lines.select(*ORDER, "value", F.split("value", "\t").alias("f")).select(
        *ORDER,
        F.get(f, F.lit(0)).alias("qname"),
        number(1, "int").alias("flag"),
        F.when(name != "*", name).alias("contig"),
        (number(3, "bigint") - 1).alias("pos"),
        number(4, "int").alias("mapq"),
        F.get(f, F.lit(5)).alias("cigar"),
        F.when(mate == "=", F.when(name != "*", name)).when(mate != "*", mate).alias("mcontig"),
        (number(7, "bigint") - 1).alias("mpos"),
        number(8, "bigint").alias("tlen"),
        F.when(seq == "*", 0).otherwise(F.length(seq)).alias("seq_len"),
        tags.alias("tags"),
        F.col("value").alias("raw"),
    )
    mates = table.select(F.col("contig").alias("mcontig"), F.col("tid").alias("mtid"))
    return (
        rows.join(small(table), "contig", "left")
        .join(small(mates), "mcontig", "left")
        .withColumn("tid", F.coalesce("tid", F.lit(-1)))
        .withColumn("mtid", F.coalesce("mtid", F.lit(-1)))
    )


def read_alignments(spark: SparkSession, path: str, file_ord: int = 0, regions: list[Region] | None = None) -> DataFrame:
    """Alignment rows of a SAM or BAM file with ``end``, the exclusive end on the reference.

    Of a staged file, ``regions`` keeps what cannot overlap them from being read.
    """
    if is_staged(spark, path):
        return read_staged(spark, path, regions).withColumn("file_ord", F.lit(file_ord))
    header = alignment_header(spark, path)
    if path.endswith(".bam"):
        from riftspan.sources.bam import read_bam_lines

        lines = read_bam_lines(spark, path, file_ord)
    else:
        lines = without_header(read_lines(spark, path, file_ord), "@")
    rows = parse_alignments(lines, alignment_contigs(header))
    return rows.withColumns({"end": end_position(), **clip_columns()})


def write_alignments(
    rows: DataFrame,
    line: Column,
    order: list[Column | str],
    header: list[str],
    path: str,
    overwrite: bool = False,
    single_file: bool = False,
) -> None:
    """Write SAM text, or BAM if the path ends in ``.bam``."""
    if path.endswith(".bam"):
        from riftspan.sources.bam import write_bam

        write_bam(rows, line, order, header, path, overwrite, single_file)
        return
    write_lines(rows, line, order, header, path, overwrite, single_file)
