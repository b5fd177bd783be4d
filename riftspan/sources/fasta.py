"""Reference sequence from FASTA text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.operators.ordered import running_total
from riftspan.plans.depth import composition
from riftspan.sources.textio import BLOCK, read_lines


#: Bases of a line that are looked at together.
PIECE = 16_384
#: Bases after which the text is cut at reading. They occur every few hundred bases, and no proper end of them begins them anew.
CUT = "TGCA"


def _fragments(spark: SparkSession, path: str, cut: str) -> DataFrame:
    """Parts of lines in the order of ``(*BLOCK, seq, no)`` with their ``text``, and ``begins`` where a line begins.

    The text is read by ``cut`` instead of by line ends, so that many tasks share a contig on one line. The reader takes
    the cut away; it is put back but at the end of a file that does not end with it, as the size of the file tells.
    """
    records = read_lines(spark, path, separator=cut).withColumn("file", F.col("block.file"))
    size = spark.read.text(path, lineSep=cut).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.octet_length("value").alias("n")
    )
    closed = size.groupBy("file").agg((F.sum(F.col("n") + len(cut)) <= F.max("size")).alias("closed"))
    place = F.struct("block.start", "seq")
    ends = records.groupBy("file").agg(F.min(place).alias("first"), F.max(place).alias("last")).join(closed, "file")
    texts = records.join(ends, "file").select(
        *BLOCK, "seq", (place == F.col("first")).alias("first"),
        F.concat("value", F.when((place == F.col("last")) & ~F.col("closed"), "").otherwise(cut)).alias("value"),
    )
    return texts.select(*BLOCK, "seq", "first", F.posexplode(F.split("value", "\r?\n")).alias("no", "text")).select(
        *BLOCK, "seq", "no", "text", (F.col("first") | (F.col("no") > 0)).alias("begins")
    )


def _names_and_bases(spark: SparkSession, path: str, cut: str) -> DataFrame:
    """Name lines as one row each, and parts of sequence lines, in the order of ``(*BLOCK, seq, no)``."""
    counted = _fragments(spark, path, cut).withColumn("_line", F.col("begins").cast("bigint"))
    numbered = running_total(counted, "_line", BLOCK, ["seq", "no"], "_line_before").withColumn("line", F.col("_line_before") + F.col("_line"))
    named = numbered.filter(F.col("begins") & F.startswith("text", F.lit(">"))).select("line")
    # A name may hold the cut.
    parts = numbered.join(named, "line").groupBy("line").agg(F.array_sort(F.collect_list(F.struct(*BLOCK, "seq", "no", "text"))).alias("parts"))
    names = parts.select("line", F.array_join("parts.text", "").alias("name"))
    return (
        numbered.join(names, "line", "left")
        .filter(F.col("name").isNull() | F.col("begins"))
        .select(*BLOCK, "seq", "no", F.coalesce("name", "text").alias("value"), F.col("name").isNotNull().alias("is_name"))
    )


def read_fasta(spark: SparkSession, path: str, cut: str = CUT) -> DataFrame:
    """Sequence pieces ``(contig, offset, bases)``, the offset counted from the start of the contig.

    Both the contig a piece belongs to and its offset are running values over the file. They are
    formed per split and corrected by split totals, so no task sees more than a split, and a piece is as long as
    a line or the way between two occurrences of ``cut``. A sequence in small letters needs a cut in small letters;
    one that lacks the cut is read whole where it is on one line.
    """
    if not cut or cut[0] in cut[1:] or not cut.isalpha():
        raise ValueError(f"the cut must be letters, the first of which occurs once: {cut!r}")
    lines = _names_and_bases(spark, path, cut).filter("value <> ''")
    is_name = F.col("is_name")
    counted = lines.withColumn("_names", is_name.cast("bigint")).withColumn(
        "_bases", F.when(is_name, 0).otherwise(F.length(F.trim("value"))).cast("bigint")
    )
    with_names = running_total(counted, "_names", BLOCK, ["seq", "no"], "_names_before")
    placed = running_total(with_names, "_bases", BLOCK, ["seq", "no"], "_bases_before")
    # One row per contig of the file.
    starts = placed.filter("_names = 1").select(
        (F.col("_names_before") + 1).alias("_contig_no"),
        F.regexp_extract("value", r"^>\s*(\S+)", 1).alias("contig"),
        F.col("_bases_before").alias("_from"),
    )
    return (
        placed.filter("_names = 0")
        .withColumn("_contig_no", F.col("_names_before"))
        .join(starts, "_contig_no")
        .select("contig", (F.col("_bases_before") - F.col("_from")).alias("offset"), F.trim("value").alias("bases"))
    )


def reference_windows(spark: SparkSession, path: str, window: int, cut: str = CUT) -> DataFrame:
    """Composition of the reference per window: ``contig``, ``window_id``, ``gc``, ``has_gap``."""
    # A contig on one line is cut first: taking windows out of one long text costs its length every time.
    pieces = F.posexplode(F.regexp_extract_all("bases", F.lit(f".{{1,{PIECE}}}"), F.lit(0)))
    lines = read_fasta(spark, path, cut).select("contig", "offset", pieces.alias("_no", "bases")).select(
        "contig", (F.col("offset") + F.col("_no") * F.lit(PIECE).cast("bigint")).alias("offset"), "bases"
    )
    first = F.floor(F.col("offset") / window).cast("bigint")
    last = F.floor((F.col("offset") + F.length("bases") - 1) / window).cast("bigint")
    touched = lines.withColumn("window_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("window_id") * window - F.col("offset"), F.lit(0))
    end = F.least((F.col("window_id") + 1) * window - F.col("offset"), F.length("bases"))
    in_window = touched.select(
        "contig", "window_id", F.substr("bases", (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece")
    )
    return composition(in_window, ["contig", "window_id"], "piece")
