"""Variant files in VCF text, plain or compressed. Binary BCF is read by :mod:`riftspan.sources.bcf`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from riftspan.functions.calls import clustered_genotype
from riftspan.functions.text import short_float
from riftspan.sources.headers import variant_samples
from riftspan.sources.regions import Region
from riftspan.sources.staged import is_staged, read_staged, staged_header
from riftspan.sources.textio import ORDER, read_header, read_lines, read_many, small_if, without_header, write_lines


def variant_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines, the column line included."""
    if is_staged(spark, path):
        return staged_header(spark, path)
    if path.endswith(".bcf"):
        from riftspan.sources.bcf import bcf_header

        return bcf_header(path)
    return read_header(spark, path, "#")


def parse_variants(lines: DataFrame, samples: list[str] | Column) -> DataFrame:
    """Variant columns from VCF lines in ``value``; order columns and the line (``raw``) are kept.

    ``samples`` are the sample names of the file, or a column with those of each line.
    """
    f = F.col("f")

    def text(i: int) -> Column:
        return F.get(f, F.lit(i))

    keys = F.split(text(8), ":")
    info = F.transform_values(
        F.when(text(7) != ".", F.str_to_map(text(7), F.lit(";"), F.lit("="))).otherwise(
            F.create_map().cast("map<string,string>")
        ),
        lambda _, v: F.coalesce(v, F.lit("")),
    )

    def call(sample: Column, i: Column) -> Column:
        values = F.split(F.get(f, i + 9), ":")
        shared = F.least(F.size(keys), F.size(values))
        fields = F.map_from_arrays(F.slice(keys, F.lit(1), shared), F.slice(values, F.lit(1), shared))
        return F.struct(sample.alias("sample"), fields.alias("fields"))

    calls = F.transform(samples if isinstance(samples, Column) else name_list(samples), call)
    none = F.array().cast("array<string>")
    return lines.withColumn("f", F.split("value", "\t")).select(
        *ORDER,
        text(0).alias("chrom"),
        (text(1).cast("bigint") - 1).alias("pos"),
        text(2).alias("id"),
        text(3).alias("ref"),
        F.when(text(4) == ".", none).otherwise(F.split(text(4), ",")).alias("alts"),
        text(5).alias("qual"),
        F.when(text(6) == ".", none).otherwise(F.split(text(6), ";")).alias("filters"),
        info.alias("info"),
        calls.alias("calls"),
        F.col("value").alias("raw"),
    )


def read_variants(spark: SparkSession, path: str, file_ord: int = 0, regions: list[Region] | None = None) -> DataFrame:
    """Variant rows of a VCF or BCF file. Of a staged file, ``regions`` keeps what cannot overlap them from being read."""
    if is_staged(spark, path):
        return read_staged(spark, path, regions).withColumn("file_ord", F.lit(file_ord))
    samples = variant_samples(variant_header(spark, path))
    if path.endswith(".bcf"):
        from riftspan.sources.bcf import read_bcf_lines

        lines = read_bcf_lines(spark, path, file_ord)
    else:
        lines = without_header(read_lines(spark, path, file_ord), "#")
    return parse_variants(lines, samples)


def header_facts(spark: SparkSession, paths: Sequence[str]) -> list[Row]:
    """``file_ord``, ``contigs`` (sorted names) and ``samples`` of many text files, by one job."""
    lines = read_many(spark, paths).filter(F.col("value").startswith("#"))
    contig = F.when(F.col("value").startswith("##contig=<"), F.regexp_extract("value", r"[<,]ID=([^,>]+)", 1))
    names = F.when(F.col("value").startswith("#CHROM"), F.split("value", "\t"))
    facts = lines.groupBy("file_ord").agg(F.sort_array(F.collect_set(contig)).alias("contigs"), F.first(names, ignorenulls=True).alias("f"))
    none = F.array().cast("array<string>")
    samples = F.when(F.size("f") > 9, F.slice("f", F.lit(10), F.size("f"))).otherwise(none)
    return facts.select("file_ord", "contigs", F.coalesce(samples, none).alias("samples")).orderBy("file_ord").collect()


def read_many_variants(spark: SparkSession, paths: Sequence[str], facts: Sequence[Row]) -> DataFrame:
    """Variant rows of many text files: one scan, each line joined with the samples of its file."""
    known = spark.createDataFrame([(f["file_ord"], f["samples"]) for f in facts], "file_ord int, samples array<string>")
    lines = without_header(read_many(spark, paths), "#")
    return parse_variants(lines.join(small_if(known, sum(len(f["samples"]) + 1 for f in facts)), "file_ord"), F.col("samples"))


def write_variants(
    rows: DataFrame,
    line: Column,
    order: list[Column | str],
    header: list[str],
    path: str,
    overwrite: bool = False,
    single_file: bool = False,
) -> None:
    """Write VCF text (compressed if the path ends in ``.gz``), or BCF if it ends in ``.bcf``."""
    if path.endswith(".bcf"):
        from riftspan.sources.bcf import write_bcf

        write_bcf(rows, line, order, header, path, overwrite, single_file)
        return
    write_lines(rows, line, order, header, path, overwrite, single_file)


def variant_end(end_key: str = "END") -> Column:
    """Exclusive end of a row for region queries: the declared end, else the reference allele's."""
    declared = F.try_element_at(F.col("info"), F.lit(end_key)).cast("bigint")
    by_ref = F.col("pos") + F.length("ref")
    return F.when(declared > F.col("pos"), declared).otherwise(by_ref)


def _sv_info(with_strands: bool) -> Column:
    strands = F.concat(F.lit("STRANDS="), F.col("strands"))
    return F.concat_ws(
        ";",
        F.concat(F.lit("END2="), F.col("end2").cast("string")),
        F.concat(F.lit("CHR2="), F.col("chrom2")),
        F.concat(F.lit("SVTYPE="), F.col("sv_type")),
        F.when(F.col("strands").isNotNull(), strands) if with_strands else F.lit(None),
        F.concat(F.lit("SVLEN="), F.col("sv_len").cast("string")),
        F.concat(F.lit("ALGORITHMS="), F.array_join("algorithms", ",")),
    )


def name_list(names: list[str]) -> Column:
    """Sample names as one constant, so that a plan does not grow with the cohort; names hold no tabs."""
    return F.split(F.lit("\t".join(names)), "\t") if names else F.array().cast("array<string>")


def _line(sv_id: Column, form: Column, cells: Column) -> Column:
    return F.concat_ws(
        "\t",
        F.col("chrom"),
        (F.col("pos") + 1).cast("string"),
        sv_id,
        F.col("reference"),
        F.col("alt"),
        F.lit("0"),
        F.lit("."),
        _sv_info(True),
        form,
        F.when(F.size(cells) > 0, F.array_join(cells, "\t")),
    )


def standardized_line() -> Column:
    """Line of a standardized variant: genotype and called flag per sample."""
    tool = F.get("algorithms", F.lit(0))
    cells = F.transform("calls", lambda c: F.concat_ws(":", c["gt"], c["called"].cast("string")))
    return _line(F.lit("."), F.concat(F.lit("GT:"), tool), cells)


def clustered_line() -> Column:
    """Line of a clustered variant: all samples, with a flag per algorithm; absent ones are missing.

    Needs the column ``cells`` of the sample matrix. Algorithms are in alphabetical order.
    """

    def cell(c: Column) -> Column:
        gt = F.when(c["gt"] == "./.", "./.").otherwise(clustered_genotype(c["gt"]))
        flags = F.transform("algorithms", lambda a: F.array_contains(c["called_by"], a).cast("int").cast("string"))
        return F.concat_ws(":", gt, F.array_join(flags, ":"))

    form = F.concat(F.lit("GT:"), F.array_join("algorithms", ":"))
    return _line(F.col("sv_id"), form, F.transform("cells", cell))


#: Evidence fields in output order; the first three are numbers with a fraction.
ANNOTATIONS = ["PR", "SR", "RD", "VL", "VM", "VR", "ROH"]


def annotated_line(columns: list[str]) -> Column:
    """The input line with evidence fields appended to the format and to the first sample."""
    parts = F.split("raw", "\t")
    keys, values = [], []
    for name in ANNOTATIONS:
        if name in columns:
            value = short_float(F.col(name)) if name in ("PR", "SR", "RD") else F.col(name).cast("string")
            present = F.col(name).isNotNull()
            keys.append(F.when(present, F.lit(name)))
            values.append(F.when(present, value))
    return F.concat_ws(
        "\t",
        F.slice(parts, 1, 8),
        F.concat_ws(":", F.get(parts, F.lit(8)), *keys),
        F.concat_ws(":", F.get(parts, F.lit(9)), *values),
        F.slice(parts, F.lit(11), F.size(parts)),
    )


def depth_line(with_deviation: bool, with_reference: bool) -> Column:
    """Line of a depth window."""
    start, end = F.col("start"), F.col("end")
    info = [
        F.concat(F.lit("END="), end.cast("string")),
        F.concat(F.lit("MAPQ="), short_float(F.col("mean_mapq"))),
    ]
    if with_reference:
        gc = F.when(F.col("gc").isNotNull(), F.concat(F.lit("GC="), short_float(F.col("gc"))))
        info = [info[0], gc, F.when(F.col("has_gap"), F.lit("GAP")), info[1]]
    cells = [F.lit("./."), short_float(F.col("cov"))]
    if with_deviation:
        cells.append(short_float(F.col("cov_sd")))
    cells.append(short_float(F.col("mean_mapq")))
    return F.concat_ws(
        "\t",
        F.col("contig"),
        (start + 1).cast("string"),
        F.format_string("%s:%d-%d", F.col("contig"), start + 1, end),
        F.lit("N"),
        F.lit("<WINDOW>"),
        F.lit("0"),
        F.lit("."),
        F.concat_ws(";", *info),
        F.lit("GT:RCV:RCVSD:MQ" if with_deviation else "GT:RCV:MQ"),
        F.concat_ws(":", *cells),
    )


def depth_rows(variants: DataFrame) -> DataFrame:
    """Depth windows ``(contig, start, end, cov, mapq)`` of the first sample of a depth file."""
    fields = F.get("calls", F.lit(0))["fields"]

    def single(name: str) -> Column:
        return F.try_element_at(fields, F.lit(name)).cast("float").cast("double")

    return variants.select(
        F.col("chrom").alias("contig"),
        F.col("pos").alias("start"),
        variant_end().alias("end"),
        single("RCV").alias("cov"),
        single("MQ").alias("mapq"),
    )
