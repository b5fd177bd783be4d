"""Genomics-shaped views over generic relational tables, for checks and benchmarks.

Each view is a projection written once in SQL that Spark and the checking engine both understand.
Coordinates grow with the order key, so density stays the same at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.config import Config
from riftspan.operators.skew import dealt_out
from riftspan.plans.library import LibraryProperties

CONTIGS = ["F", "O", "P"]

#: Thresholds used with the views: smaller than the defaults, to fit their read lengths.
LIBRARY = LibraryProperties(max_rlen=70, median_isize=300.0, std_dev_isize=100.0, max_normal_isize=500)
CONFIG = Config(sliding_window_size=5_000, lib_estimation_sample_size=4_000)

_CONTIG_OF_TID = "CASE {0} WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END"
_TID = "(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)"
_MTID = f"(({_TID} + CASE WHEN l_partkey % 10 = 0 THEN 1 ELSE 0 END) % 3)"
_POS = "(l_orderkey * 8 + l_partkey % 200)"
_MATCHED = "(20 + CAST(l_quantity AS BIGINT))"
_HARD = "(l_partkey % 29 = 0 OR l_suppkey % 3 = 0)"
_LEFT = "(l_suppkey % 40)"
_RIGHT = "(l_partkey % 40)"
_FLAG = (
    "CAST(1 + 2 * (l_partkey % 2) + CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END"
    " + 32 * (CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END) + 64 * (l_linenumber % 2)"
    " + CASE WHEN l_partkey % 29 = 0 THEN 256 ELSE 0 END + CASE WHEN l_suppkey % 17 = 0 THEN 1024 ELSE 0 END"
    " + CASE WHEN l_partkey % 13 = 0 THEN 2048 ELSE 0 END AS INTEGER)"
)

#: Alignment-shaped rows; ``ord`` orders them up to indistinguishable ones.
READS = f"""
SELECT l_orderkey AS qname, {_TID} AS tid, {_CONTIG_OF_TID.format(_TID)} AS contig, {_POS} AS pos,
       {_POS} + {_MATCHED} AS stop, CAST(l_linenumber * 10 AS INTEGER) AS mapq, {_FLAG} AS flag,
       {_MTID} AS mtid, {_CONTIG_OF_TID.format(_MTID)} AS mcontig, l_orderkey * 8 + l_suppkey % 300 AS mpos,
       l_partkey % 1200 - 400 AS tlen, CAST({_LEFT} + {_MATCHED} + {_RIGHT} AS INTEGER) AS seq_len,
       {_LEFT} AS clip_left, {_RIGHT} AS clip_right, {_HARD} AS hard,
       CASE WHEN {_HARD} THEN {_LEFT} ELSE 0 END AS left_hard, CASE WHEN {_HARD} THEN 0 ELSE {_LEFT} END AS left_soft,
       CASE WHEN {_HARD} THEN {_RIGHT} ELSE 0 END AS right_hard, CASE WHEN {_HARD} THEN 0 ELSE {_RIGHT} END AS right_soft,
       CASE WHEN {_LEFT} > 0 THEN CAST({_LEFT} AS VARCHAR(20)) || CASE WHEN {_HARD} THEN 'H' ELSE 'S' END ELSE '' END
         || CAST({_MATCHED} AS VARCHAR(20)) || 'M'
         || CASE WHEN {_RIGHT} > 0 THEN CAST({_RIGHT} AS VARCHAR(20)) || CASE WHEN {_HARD} THEN 'H' ELSE 'S' END ELSE '' END
         AS cigar,
       (({_POS} * 10000 + l_partkey % 10000) * 1000 + l_suppkey % 1000) * 10 + l_linenumber AS ord
FROM lineitem
"""

#: Variant-shaped rows.
SVS = """
SELECT o_orderkey AS row_id, o_orderstatus AS chrom, o_orderkey * 8 + o_custkey % 40 AS pos,
       o_orderstatus AS chrom2, o_orderkey * 8 + o_custkey % 40 + 100 + o_custkey % 400 AS end2,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'DEL' WHEN '2' THEN 'DUP' WHEN '3' THEN 'INV'
         WHEN '4' THEN 'BND' ELSE 'CNV' END AS sv_type,
       CASE o_orderkey % 4 WHEN 0 THEN '+-' WHEN 1 THEN '-+' WHEN 2 THEN '++' ELSE '--' END AS strands,
       100 + o_custkey % 400 AS sv_len, 'S' || CAST(o_custkey % 8 AS VARCHAR(20)) AS sample
FROM orders
"""

#: Depth windows that tile each contig.
DEPTH = """
SELECT CASE event_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS contig,
       event_id * 12 AS start, event_id * 12 + 36 AS stop, value AS cov,
       CAST(CASE WHEN user_id % 4 = 0 THEN 20 ELSE 60 END AS DOUBLE) AS mapq
FROM events
"""

#: Single-base variants of one sample with allele depths.
SNVS = """
SELECT CASE p_partkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS contig, p_partkey * 60 + p_size AS pos,
       p_partkey AS ord, CASE WHEN p_partkey % 11 = 0 THEN 'CT' ELSE 'C' END AS alt,
       CASE p_size % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE './1' END AS gt,
       p_size % 23 AS a0, p_partkey % 29 AS a1
FROM part
"""

#: Regions to leave out.
BLOCKED = """
SELECT CASE n_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS contig,
       CAST(n_nationkey AS BIGINT) * 4000 AS start, CAST(n_nationkey AS BIGINT) * 4000 + 700 AS stop
FROM nation
"""

_SOURCES = {"lineitem": READS, "orders": SVS, "events": DEPTH, "part": SNVS, "nation": BLOCKED}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    query = _SOURCES[source].replace(f"FROM {source}", "FROM {given}")
    given = table(spark, sf_dir, source)
    if source == "lineitem":
        given = dealt_out(given, "l_orderkey")
    return spark.sql(query, given=given)


def _computed_once(rows: DataFrame) -> DataFrame:
    """Keep the optimizer from copying the formulas of a view into every predicate on its columns.

    A real table stores these columns. Here each copy of a formula bloats the generated code until
    the JVM no longer compiles it. Predicates are not pushed below a generator, columns still are.
    """
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("_r")).select("_r.*")


def reads(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Alignment-shaped rows: the named columns, or all but the CIGAR text."""
    rows = _view(spark, sf_dir, "lineitem")
    return _computed_once(rows.select(*columns) if columns else rows.drop("cigar"))


def svs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant-shaped rows with the calls of their one sample."""
    rows = _computed_once(_view(spark, sf_dir, "orders"))
    call = F.struct(
        F.col("sample"),
        F.when(F.col("row_id") % 3 == 0, "1-1").otherwise("0-1").alias("gt"),
        F.array(F.lit("delly")).alias("called_by"),
    )
    caller = F.when(F.col("row_id") % 2 == 0, "delly").otherwise("manta")
    return rows.withColumn("calls", F.array(call)).withColumn("algorithms", F.array(caller)).withColumn(
        "alt", F.concat(F.lit("<"), F.col("sv_type"), F.lit(">"))
    )


def depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth windows."""
    return _view(spark, sf_dir, "events").withColumnRenamed("stop", "end")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-base variants in the layout of a variant file."""
    fields = F.create_map(
        F.lit("GT"), F.col("gt"), F.lit("AD"), F.concat_ws(",", F.col("a0").cast("string"), F.col("a1").cast("string"))
    )
    return _view(spark, sf_dir, "part").select(
        "ord",
        F.col("contig").alias("chrom"),
        "pos",
        F.lit("A").alias("ref"),
        F.array("alt").alias("alts"),
        F.array(F.struct(F.lit("S0").alias("sample"), fields.alias("fields"))).alias("calls"),
    )


def blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions to leave out."""
    return _view(spark, sf_dir, "nation").withColumnRenamed("stop", "end")


def with_cte(sql: str, *views: str) -> str:
    """A query for the checking engine over the named views."""
    texts = {"reads": READS, "svs": SVS, "depth": DEPTH, "snvs": SNVS, "blocked": BLOCKED}
    return "WITH " + ", ".join(f"{v} AS ({texts[v]})" for v in views) + " " + sql
