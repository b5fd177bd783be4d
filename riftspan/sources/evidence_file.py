"""Evidence files: contig, start, end and a JSON document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.plans.evidence import from_signal, signal_json
from riftspan.sources.textio import ORDER, read_lines, without_header, write_lines

HEADER = "#contig\tstart\tend\tsignal"


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """Evidence columns with the index columns ``file_contig``, ``file_start``, ``file_end``.

    The JSON document decides the place of the evidence, the first three columns only which rows a
    region selects.
    """
    parts = F.split("value", "\t")
    lines = without_header(read_lines(spark, path), "#").select(
        *ORDER,
        F.get(parts, F.lit(0)).alias("file_contig"),
        F.get(parts, F.lit(1)).cast("bigint").alias("file_start"),
        F.get(parts, F.lit(2)).cast("bigint").alias("file_end"),
        F.get(parts, F.lit(3)).alias("signal"),
    )
    return from_signal(lines, F.col("signal"), (*ORDER, "file_contig", "file_start", "file_end"))


def write_evidence(
    evidence: DataFrame, order: list[Column | str], path: str, overwrite: bool = False, single_file: bool = False
) -> None:
    """Write evidence rows in the given order."""
    line = F.concat_ws(
        "\t", F.col("contig"), F.col("start").cast("string"), F.col("end").cast("string"), signal_json(evidence)
    )
    write_lines(evidence, line, order, [HEADER], path, overwrite, single_file)
