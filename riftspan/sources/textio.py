"""Line-based files: reading with a row order, reading headers, writing in order with a header."""

from __future__ import annotations

import contextlib
import glob
import os
import re
import shutil
import sys
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.errors import OutputExists
from riftspan.session import file_system, mounted_folder

#: Row order of data read from files: input number, then (file, split), then row of the split.
ORDER = ["file_ord", "block", "seq"]
BLOCK = ["file_ord", "block"]
#: Tables about files are broadcast up to so many rows.
BROADCAST_FILES = 100_000
#: Number in the name of a part that Spark wrote.
PART_NUMBER = r"/part-(\d+)[^/]*$"


def read_lines(spark: SparkSession, path: str | list[str], file_ord: int = 0, separator: str = "\n") -> DataFrame:
    """Lines with the order columns, without any shuffle; with another ``separator``, the texts between its occurrences.

    Splits of a file are told apart by their offset. Inside a split, row ids grow with the rows. The parts of a
    folder are in the order of their numbers, which their names as text are not beyond 100,000 parts.
    """
    file = F.col("_metadata.file_path")
    part = F.regexp_extract(file, PART_NUMBER, 1)
    # Spark's own line ends include those with a carriage return.
    lines = spark.read.text(path) if separator == "\n" else spark.read.text(path, lineSep=separator)
    return lines.select(
        F.lit(file_ord).alias("file_ord"),
        F.struct(
            F.when(part != "", part.cast("long")).alias("part"), file.alias("file"), F.col("_metadata.file_block_start").alias("start")
        ).alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def files_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file`` (as in the metadata of rows) and ``file_ord`` for the files of all paths, which may be folders of parts.

    Files are listed on the driver, as for any scan; no job is run.
    """
    listed = [(_one_slash(file), i) for i, path in enumerate(paths) for file in spark.read.text(path).inputFiles()]
    return small_if(spark.createDataFrame(listed, "file string, file_ord int"), len(listed))


def small_if(table: DataFrame, rows: int) -> DataFrame:
    """``table`` to be broadcast if it has few rows; else the planner decides."""
    return F.broadcast(table) if rows <= BROADCAST_FILES else table


def _one_slash(file: str) -> str:
    """A scan lists files as ``file:///x``, and names them ``file:/x`` in the metadata of rows."""
    return file.replace(":///", ":/", 1)


def read_many(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of all files with the order columns, as one scan however many files there are."""
    lines = read_lines(spark, list(dict.fromkeys(paths))).drop("file_ord").withColumn("file", F.regexp_replace("block.file", "^([^:]+):///", "$1:/"))
    return lines.join(files_of(spark, paths), "file").select(*ORDER, "value")


def without_header(lines: DataFrame, mark: str) -> DataFrame:
    """Drop lines that start with ``mark``.

    The text of dropped lines is also blanked: the optimizer may evaluate later filters on parsed
    fields first, and header lines do not parse.
    """
    is_row = ~F.col("value").startswith(mark)
    return lines.filter(is_row).withColumn("value", F.when(is_row, F.col("value")))


def read_header(spark: SparkSession, path: str, mark: str) -> list[str]:
    """Leading lines that start with ``mark``; only the first split is touched."""
    wanted = 1_000
    while True:
        # limit() without a sort reads partitions one by one and stops early.
        lines = [r["value"] for r in spark.read.text(_first_file(spark, path)).limit(wanted).collect()]
        header = []
        for line in lines:
            if not line.startswith(mark):
                return header
            header.append(line)
        if len(lines) < wanted:
            return header
        wanted *= 10


def in_part_order(paths: Iterable[str]) -> list[str]:
    """Paths by part number, then by name."""

    def place(path: str) -> tuple[int, str]:
        number = re.search(PART_NUMBER, path)
        return (int(number.group(1)) if number else -1, path)

    return sorted(paths, key=place)


def _first_file(spark: SparkSession, path: str) -> str:
    system, place = file_system(spark, path)
    if not (system.exists(place) and system.getFileStatus(place).isDirectory()):
        return path
    names = [str(f.getPath().getName()) for f in system.listStatus(place)]
    parts = in_part_order(f"{path.rstrip('/')}/{n}" for n in names if not n.startswith(("_", ".")))
    return parts[0] if parts else path


def guard_output(spark: SparkSession, path: str, overwrite: bool) -> None:
    """Refuse to write over existing output unless allowed; ``-`` is standard output."""
    if path == "-" or overwrite:
        return
    system, place = file_system(spark, path)
    if system.exists(place):
        raise OutputExists(path)


def write_lines(
    body: DataFrame,
    line: Column,
    order: Sequence[Column | str],
    header: list[str],
    path: str,
    overwrite: bool = False,
    single_file: bool = False,
) -> None:
    """Write lines in order, the header first, as a folder of parts that can simply be concatenated.

    Header lines take part in the sort with a lower rank, so they begin the first part. With
    ``single_file`` (or for standard output, ``-``) the parts are afterwards copied into one file,
    streamed part by part. A path ending in ``.gz`` is compressed.
    """
    spark = body.sparkSession
    guard_output(spark, path, overwrite)
    keys = [F.lit(1).alias("_rank"), F.lit(0).alias("_no")]
    ordered = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    rows = body.select(*keys, *ordered, line.alias("value"))
    if header:
        top = spark.createDataFrame(
            [(0, i, text) for i, text in enumerate(header)], "_rank int, _no int, value string"
        )
        rows = top.unionByName(rows, allowMissingColumns=True)
    in_order = rows.orderBy("_rank", "_no", *[f"_o{i}" for i in range(len(ordered))]).select("value")
    compression = "gzip" if path.endswith(".gz") else "none"
    if not single_file and path != "-":
        in_order.write.mode("overwrite" if overwrite else "error").option("compression", compression).text(path)
        return
    # Parts lie beside the output, or in the shared folder, where executors can write as well.
    folder = mounted_folder(spark, "riftspan-stdout") if path == "-" else f"{path}.parts"
    in_order.write.mode("overwrite" if overwrite else "error").option("compression", compression).text(folder)
    with contextlib.ExitStack() as stack:
        target = sys.stdout.buffer if path == "-" else stack.enter_context(open(path, "wb"))
        for name in in_part_order(glob.glob(os.path.join(glob.escape(folder), "part-*"))):
            with open(name, "rb") as source:
                shutil.copyfileobj(source, target)
        target.flush()
    shutil.rmtree(folder)
