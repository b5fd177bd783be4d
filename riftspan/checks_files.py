"""Queries that go through files: rows are written by a sink of the library and read back by its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan import bind
from riftspan.bind import with_cte
from riftspan.checks import register
from riftspan.functions.text import plain_number
from riftspan.plans import depth as dp
from riftspan.session import new_table
from riftspan.sources import sam, vcf
from riftspan.sources.headers import Contig, depth_header
from riftspan.sources.regions import read_bed
from riftspan.sources.textio import write_lines

_LENGTH = 2_000_000_000
_CONTIGS = [Contig(c, _LENGTH) for c in bind.CONTIGS]


@register(
    "sam_round_trip",
    with_cte(
        """SELECT qname, flag, contig, tid, pos, stop, mapq, cigar, mcontig, mtid, mpos, tlen, seq_len, left_soft, left_hard, right_soft, right_hard
        FROM (SELECT CAST(qname AS VARCHAR) AS qname, flag, contig, tid, pos, stop, mapq, cigar, mcontig, mtid, mpos, tlen, seq_len,
          left_soft, left_hard, right_soft, right_hard FROM reads)""",
        "reads",
    ),
)
def sam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments written as lines and read back with all that is derived from them."""
    names = ["qname", "flag", "contig", "pos", "mapq", "cigar", "mcontig", "mpos", "tlen", "seq_len", "ord"]
    mate = F.when(F.col("mcontig") == F.col("contig"), "=").otherwise(F.col("mcontig"))
    line = F.concat_ws(
        "\t", F.col("qname").cast("string"), F.col("flag").cast("string"), F.col("contig"), (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"),
        F.col("cigar"), mate, (F.col("mpos") + 1).cast("string"), F.col("tlen").cast("string"), F.repeat(F.lit("A"), F.col("seq_len")), F.lit("*"),
    )
    path = f"{new_table(spark)}/reads.sam"
    header = ["@HD\tVN:1.6\tSO:unsorted", *[f"@SQ\tSN:{c.name}\tLN:{c.length}" for c in _CONTIGS]]
    sam.write_alignments(bind.reads(spark, sf_dir, *names), line, ["ord"], header, path)
    back = sam.read_alignments(spark, path)
    number = [F.col(c).cast("bigint").alias(c) for c in ("left_soft", "left_hard", "right_soft", "right_hard")]
    return back.select(
        "qname", "flag", "contig", "tid", "pos", F.col("end").alias("stop"), "mapq", "cigar", "mcontig", "mtid", "mpos", "tlen", "seq_len", *number
    )


def _whole_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth windows whose depth is a whole number, which all engines print alike."""
    return bind.depth(spark, sf_dir).withColumn("cov", F.floor(F.abs("cov")))


_TAB = " || chr(9) || "


@register(
    "depth_lines",
    with_cte(
        "SELECT "
        + _TAB.join(
            [
                "contig",
                "(start + 1)",
                "contig || ':' || (start + 1) || '-' || stop",
                "'N'",
                "'<WINDOW>'",
                "'0'",
                "'.'",
                "'END=' || stop || ';MAPQ=' || CAST(mapq AS BIGINT)",
                "'GT:RCV:MQ'",
                "'./.:' || CAST(floor(abs(cov)) AS BIGINT) || ':' || CAST(mapq AS BIGINT)",
            ]
        )
        + " AS line FROM depth",
        "depth",
    ),
)
def depth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a file of depth windows."""
    path = f"{new_table(spark)}/depth.vcf"
    rows = _whole_depth(spark, sf_dir).withColumnRenamed("mapq", "mean_mapq")
    vcf.write_variants(rows, vcf.depth_line(False, False), ["contig", "start"], depth_header(_CONTIGS, ["S"], "20260101"), path)
    return spark.read.text(path).filter(~F.col("value").startswith("#")).select(F.col("value").alias("line"))


@register(
    "depth_read_back",
    with_cte('SELECT contig, start, stop AS "end", CAST(floor(abs(cov)) AS DOUBLE) AS cov, mapq FROM depth', "depth"),
)
def depth_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth windows from such a compressed file."""
    path = f"{new_table(spark)}/depth.vcf.gz"
    rows = _whole_depth(spark, sf_dir).withColumnRenamed("mapq", "mean_mapq")
    vcf.write_variants(rows, vcf.depth_line(False, False), ["contig", "start"], depth_header(_CONTIGS, ["S"], "20260101"), path)
    return vcf.depth_rows(vcf.read_variants(spark, path)).select("contig", "start", "end", "cov", "mapq")


@register(
    "depth_summary_lines",
    with_cte(
        """, m AS (SELECT contig AS name, quantile_cont(floor(abs(cov)), 0.5) AS m FROM depth GROUP BY contig
          UNION ALL SELECT 'autosomes', quantile_cont(floor(abs(cov)), 0.5) FROM depth WHERE contig IN ('F', 'O'))
        SELECT name || chr(9) || CASE WHEN m = floor(m) THEN CAST(CAST(m AS BIGINT) AS VARCHAR) ELSE CAST(m AS VARCHAR) END AS line FROM m""",
        "depth",
    ).replace(") , m AS", "), m AS"),
)
def depth_summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the depth summary: medians of the contigs and of the autosomes."""
    medians = dp.depth_medians(_whole_depth(spark, sf_dir), ["F", "O"], ["P"]).collect()
    lines = spark.createDataFrame([(r["name"], f"{r['name']}\t{plain_number(r['median'])}") for r in medians], "name string, line string")
    path = f"{new_table(spark)}/summary.tsv"
    write_lines(lines, F.col("line"), ["name"], ["CHROM\tS"], path)
    return spark.read.text(path).filter(~F.col("value").startswith("CHROM")).select(F.col("value").alias("line"))


@register("bed_regions", with_cte('SELECT contig, start, stop AS "end" FROM blocked', "blocked"))
def bed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions written to a BED file and read back, with all contigs checked."""
    path = f"{new_table(spark)}/regions.bed"
    line = F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"))
    write_lines(bind.blocked(spark, sf_dir), line, ["contig", "start"], [], path)
    return read_bed(spark, path, bind.CONTIGS)
