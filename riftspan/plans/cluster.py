"""Clustering of standardized variants across files and collapse of each cluster to one record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riftspan.config import ClusterSettings
from riftspan.functions.calls import ones
from riftspan.functions.interval import sv_interval
from riftspan.operators.ordered import global_row_number
from riftspan.operators.quantiles import integer_median
from riftspan.operators.similar_intervals import cluster_similar
from riftspan.session import reliable_checkpoint
from riftspan.sources.vcf import name_list

# The types that take part when types must match.
CLUSTERED_TYPES = ["DEL", "DUP", "INV", "BND"]


def assign_clusters(svs: DataFrame, settings: ClusterSettings) -> DataFrame:
    """Add ``cluster`` (the least ``row_id`` of the cluster) to variants.

    ``row_id`` (bigint) must be unique and follow the input order. Variants of other types than the
    clustered ones have no cluster, and no row, when types must match.
    """
    start, end = sv_interval(F.col("pos"), F.col("end2"), F.col("sv_type"))
    rows = svs.withColumn("_start", start).withColumn("_end", end)
    by = ["region_ord", "chrom"] if "region_ord" in svs.columns else ["chrom"]
    if settings.match_sv_type:
        rows = rows.filter(F.col("sv_type").isin(CLUSTERED_TYPES))
        by.append("sv_type")
    if settings.match_strands:
        by.append("strands")
    names = None
    if settings.sample_overlap is not None:
        names = "_samples"
        rows = rows.withColumn(names, F.col("calls.sample"))
    clustered = cluster_similar(
        rows,
        "row_id",
        by,
        ("_start", "_end"),
        settings.reciprocal_overlap,
        settings.max_bp_distance,
        names,
        settings.sample_overlap,
    )
    return clustered.drop("_start", "_end", "_samples")


def merged_calls(clustered: DataFrame) -> DataFrame:
    """Per cluster the merged genotype and callers of each sample: ``cluster``, ``calls``.

    A sample seen once keeps its genotype text; otherwise the most alternative alleles win.
    """
    single = clustered.select("cluster", "row_id", F.explode("calls").alias("_c")).select(
        "cluster", "row_id", "_c.sample", "_c.gt", "_c.called_by"
    )
    count = F.max(ones(F.col("gt")))
    merged = F.when(count == 0, "0/0").when(count == 1, "0/1").otherwise("1/1")
    per_sample = single.groupBy("cluster", "sample").agg(
        F.when(F.count(F.lit(1)) == 1, F.min("gt")).otherwise(merged).alias("gt"),
        F.min("row_id").alias("_seen"),
    )
    callers = (
        single.select("cluster", "sample", F.explode("called_by").alias("_by"))
        .groupBy("cluster", "sample")
        .agg(F.array_sort(F.collect_set("_by")).alias("called_by"))
    )
    complete = per_sample.join(callers, ["cluster", "sample"], "left").withColumn(
        "called_by", F.coalesce("called_by", F.array().cast("array<string>"))
    )
    in_order = F.array_sort(F.collect_list(F.struct("_seen", "sample", "gt", "called_by")))
    return complete.groupBy("cluster").agg(
        F.transform(in_order, lambda c: F.struct(c["sample"].alias("sample"), c["gt"].alias("gt"), c["called_by"].alias("called_by"))).alias("calls")
    )


def consensus_positions(clustered: DataFrame) -> DataFrame:
    """Whole-number medians of both ends per cluster: ``cluster``, ``pos``, ``end2``."""
    ends = clustered.select(
        "cluster",
        F.explode(F.array(F.struct(F.lit("pos").alias("e"), F.col("pos").alias("x")), F.struct(F.lit("end2").alias("e"), F.col("end2").alias("x")))).alias("_p"),
    ).select("cluster", "_p.e", "_p.x")
    medians = integer_median(ends, ["cluster", "e"], "x", "m")
    return medians.groupBy("cluster").agg(
        F.max(F.when(F.col("e") == "pos", F.col("m"))).alias("pos"), F.max(F.when(F.col("e") == "end2", F.col("m"))).alias("end2")
    )


def collapse_clusters(clustered: DataFrame, settings: ClusterSettings) -> DataFrame:
    """One record per cluster; descriptive columns come from its first row."""
    # Several aggregations follow; storing the rows keeps each from repeating the clustering.
    clustered = reliable_checkpoint(clustered)
    lead_columns = [c for c in ("region_ord", "chrom", "alt", "chrom2", "sv_type", "strands") if c in clustered.columns]
    heads = clustered.filter("row_id = cluster").select("cluster", *lead_columns)
    algorithms = (
        clustered.select("cluster", F.explode("algorithms").alias("_a"))
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_set("_a")).alias("algorithms"))
    )
    joined = (
        heads.join(consensus_positions(clustered), "cluster")
        .join(algorithms, "cluster")
        .join(merged_calls(clustered), "cluster")
    )
    single_type = settings.sv_type_out
    breakend = (F.col("sv_type") == "BND") if settings.match_sv_type else F.lit(False)
    end2 = F.when(breakend, F.col("pos") + 1).otherwise(F.col("end2"))
    return joined.select(
        "cluster",
        *[c for c in ("region_ord",) if c in lead_columns],
        "chrom",
        "pos",
        F.lit("N").alias("reference"),
        (F.lit(f"<{single_type}>") if single_type else F.col("alt")).alias("alt"),
        "chrom2",
        end2.alias("end2"),
        (F.lit(single_type) if single_type else F.col("sv_type")).alias("sv_type"),
        "strands",
        F.when(breakend, F.lit(-1).cast("bigint")).otherwise(end2 - F.col("pos")).alias("sv_len"),
        "algorithms",
        "calls",
    )


def number_clusters(records: DataFrame) -> DataFrame:
    """Give records their ids, running over regions in the order of position, end and type."""
    order = ["region_ord", "pos", "end2", "sv_type", "cluster"]
    numbered = global_row_number(records, order, "number")
    return numbered.withColumn("sv_id", F.format_string("SV%08d", "number"))


def cluster_variants(svs: DataFrame, settings: ClusterSettings, keep_other_types: bool = True) -> DataFrame:
    """Cluster, collapse and number variants of all input files.

    When types must match, variants of other types than the clustered ones stay on their own, or go.
    """
    clustered = assign_clusters(svs, settings)
    if settings.match_sv_type and keep_other_types:
        alone = svs.filter(~F.coalesce(F.col("sv_type").isin(CLUSTERED_TYPES), F.lit(False)))
        clustered = clustered.unionByName(alone.withColumn("cluster", F.col("row_id")))
    return number_clusters(collapse_clusters(clustered, settings))


def sample_matrix(records: DataFrame, row_key: list[str], samples: list[str]) -> DataFrame:
    """Spread the calls of each record over all samples, as an array ``cells``: missing ones get ``./.`` and no caller."""
    found = F.map_from_entries(F.transform("calls", lambda c: F.struct(c["sample"], F.struct(c["gt"], c["called_by"]))))
    nothing = F.struct(F.lit("./.").alias("gt"), F.array().cast("array<string>").alias("called_by"))
    cells = F.transform(name_list(samples), lambda name: F.coalesce(F.try_element_at(found, name), nothing))
    return records.select(*row_key, cells.alias("cells"))

