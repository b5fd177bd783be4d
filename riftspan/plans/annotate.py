"""Annotation of structural variants with read, depth and small-variant evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.config import Config
from riftspan.functions.calls import allele_index
from riftspan.functions.interval import centre_crop, clamp_sub
from riftspan.operators.blocked import drop_blocked
from riftspan.operators.pair_support import count_supported
from riftspan.operators.prefix import RangeCount, count_in_ranges
from riftspan.operators.range_quantile import REACH, overlap_medians
from riftspan.operators.range_text import with_joined

CNV_TYPES = ["DEL", "DUP", "CNV"]
#: Windows with at least this mean mapping quality are preferred for depth.
GOOD_MAPQ = 55.0

_WINDOW = "struct<pair:tinyint,side:tinyint,contig:string,lo:bigint,hi:bigint,strand:string>"


def search_windows(max_dist: int, slack: int, compat: bool = False) -> Column:
    """Stranded windows around both ends in which supporting reads are sought.

    Sides 1 and 2 of the same ``pair`` must both be hit by a read; they follow each other. Each window reaches ``max_dist`` to
    the side its reads come from and ``slack`` beyond the breakpoint. Types and strands without a
    rule have no windows, or raise an error if ``compat``.
    """
    length = max_dist + slack
    pos, end2 = F.col("pos"), F.col("end2")

    def window(pair: int, side: int, start: Column, strand: str) -> Column:
        contig = F.col("chrom") if side == 1 else F.col("chrom2")
        return F.struct(F.lit(pair), F.lit(side), contig, start, start + length, F.lit(strand)).cast(_WINDOW)

    ahead = {"pos": clamp_sub(pos, max_dist), "end2": clamp_sub(end2, max_dist)}
    left_forward = window(1, 1, ahead["pos"], "Forward")
    left_reverse = window(1, 1, pos - slack, "Reverse")
    right_reverse = window(1, 2, end2 - slack, "Reverse")
    deletion = F.array(left_forward, right_reverse)
    duplication = F.array(left_reverse, window(1, 2, end2 - max_dist, "Forward"))
    inversion = F.array(
        left_forward,
        window(1, 2, ahead["end2"], "Forward"),
        window(2, 1, pos - slack, "Reverse"),
        window(2, 2, ahead["end2"], "Reverse"),
    )
    same_side = F.array(left_reverse, right_reverse)
    inward = F.array(left_reverse, window(1, 2, ahead["end2"], "Reverse"))
    sv_type, strands = F.col("sv_type"), F.col("strands")
    unknown = F.raise_error(F.concat(F.lit("no search rule for "), sv_type, F.lit("/"), strands)) if compat else F.lit(None)
    breakend = sv_type == "BND"
    return (
        F.when(sv_type == "DEL", deletion)
        .when(sv_type == "DUP", duplication)
        .when(sv_type == "INV", inversion)
        .when(breakend & strands.isin("--", "++"), same_side)
        .when(breakend & (strands == "-+"), inward)
        .when(breakend & (strands == "+-"), deletion)
        .otherwise(unknown.cast(f"array<{_WINDOW}>"))
    )


def drop_blocked_evidence(evidence: DataFrame, regions: DataFrame) -> DataFrame:
    """Remove evidence lying in a blocked region, with its alignment or with the mate's position."""
    return drop_blocked(
        evidence,
        [
            (F.col("contig"), F.col("start"), F.col("end")),
            (F.col("contig2"), F.col("start2"), F.col("start2") + 1),
        ],
        regions,
    )


def facing_evidence(evidence: DataFrame) -> DataFrame:
    """Evidence by the strand of windows it supports, a row per strand; copies are kept.

    Pairs count by the strand of the read; a read clipped at the right supports forward windows, at
    the left reverse ones, at both ends either.
    """
    sides = F.col("clipped_sides")
    strands = (
        F.when(F.col("kind") == "PairedRead", F.array("strand1"))
        .when(sides == "Both", F.array(F.lit("Forward"), F.lit("Reverse")))
        .when(sides == "Right", F.array(F.lit("Forward")))
        .when(sides == "Left", F.array(F.lit("Reverse")))
    )
    # One small number for kind and mate keeps the many hit rows narrow: 0 pair, 1 and 2 split reads.
    signal = F.when(F.col("kind") == "PairedRead", 0).when(F.col("is_first"), 1).otherwise(2).cast("byte")
    return evidence.select(
        "read_id", signal.alias("signal"), "contig", "start", "end", F.explode(strands).alias("strand")
    )


def evidence_counts(
    svs: DataFrame, evidence: DataFrame, max_dist: int, slack: int, compat: bool = False
) -> DataFrame:
    """``row_id``, ``pe_count``, ``sr_count`` for variants with support: templates seen on both sides.

    Copies of a variant are searched once.
    """
    place = ["chrom", "pos", "chrom2", "end2", "sv_type", "strands"]
    sites = svs.groupBy(*place).agg(F.min("row_id").alias("site"))
    per_site = count_supported(facing_evidence(evidence), sites, search_windows(max_dist, slack, compat), max_dist + slack)
    counted = sites.join(per_site, "site").drop("site")
    return svs.select("row_id", *place).join(counted, place).select("row_id", "pe_count", "sr_count")


def _cnv_sites(svs: DataFrame, limit: int | None, types: Sequence[str] = CNV_TYPES) -> tuple[DataFrame, DataFrame]:
    """(CNV rows with ``lo``/``hi``, one row per distinct interval with its ``site``); cropped to ``limit`` if there is one."""
    lo, hi = (F.col("pos"), F.col("end2")) if limit is None else centre_crop(F.col("pos"), F.col("end2"), limit)
    cnvs = svs.filter(F.col("sv_type").isin(list(types))).select("row_id", "sv_type", F.col("chrom").alias("contig"), lo.alias("lo"), hi.alias("hi"))
    sites = cnvs.groupBy("contig", "lo", "hi").agg(F.min("row_id").alias("site"))
    return cnvs, sites


def depth_ratio(
    svs: DataFrame, windows: DataFrame, autosome_median: float | Column, limit: int | None, min_bins: int, reach: int = REACH
) -> DataFrame:
    """``row_id``, ``norm_cov`` of copy-number variants that have depth windows.

    ``windows`` has ``contig``, ``start``, ``end``, ``cov``, ``mapq``. Only well-mapped windows are
    used if there are at least ``min_bins`` of them. Medians are taken without listing the windows of a variant.
    """
    cnvs, sites = _cnv_sites(svs, limit)
    good = F.when(F.col("mapq").cast("double") >= GOOD_MAPQ, F.array(F.lit("all"), F.lit("good"))).otherwise(F.array(F.lit("all")))
    items = windows.select("contig", F.explode(good).alias("series"), "start", "end", F.col("cov").cast("double").alias("value"))
    found = overlap_medians(sites.select("contig", "lo", "hi"), items, "contig", reach)
    well_mapped = F.col("series") == "good"
    median = F.lit(autosome_median) if isinstance(autosome_median, (int, float)) else autosome_median
    per_site = found.groupBy("contig", "lo", "hi").agg(
        F.coalesce(F.max(F.when(well_mapped, F.col("n"))), F.lit(0)).alias("_good"),
        F.max(F.when(well_mapped, F.col("median"))).alias("_of_good"),
        F.max(F.when(~well_mapped, F.col("median"))).alias("_of_all"),
    )
    ratio = per_site.select(
        "contig",
        "lo",
        "hi",
        F.try_divide(F.when(F.col("_good") >= min_bins, F.col("_of_good")).otherwise(F.col("_of_all")), median).alias("norm_cov"),
    )
    return cnvs.join(ratio, ["contig", "lo", "hi"]).select("row_id", "norm_cov")


def het_snvs(variants: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Heterozygous biallelic single-base variants of the first sample, with the allele fraction ``baf``."""
    fields = F.get("calls", F.lit(0))["fields"]
    gt = F.coalesce(F.try_element_at(fields, F.lit("GT")), F.lit("./."))
    depths = F.split(F.try_element_at(fields, F.lit("AD")), ",")
    g0, g1 = allele_index(gt, 0), allele_index(gt, 1)
    a0 = F.try_to_number(F.get(depths, g0), F.lit("999999999")).cast("double")
    a1 = F.try_to_number(F.get(depths, g1), F.lit("999999999")).cast("double")
    alt = F.get("alts", F.lit(0))
    single = (F.size("alts") == 1) & (F.length("ref") == 1) & (F.length(alt) == 1)
    return variants.filter(single & (g0 != g1)).select(
        *carry, F.col("chrom").alias("contig"), "pos", allele_fraction(a0, a1).alias("baf")
    )


def allele_fraction(a0: Column, a1: Column) -> Column:
    """Share of the second allele; not a number where nothing was read."""
    return F.coalesce(F.try_divide(a1, a0 + a1), F.lit(float("nan")))


def snv_counts(svs: DataFrame, snvs: DataFrame, limit: int | None, compat: bool = False) -> DataFrame:
    """``row_id``, ``snvs_left``, ``snvs_within``, ``snvs_right`` of copy-number variants.

    Flanks are as long as the variant, cropped to ``limit`` if there is one. ``compat`` counts the left flank twice, as the
    original does.
    """
    cnvs, sites = _cnv_sites(svs, limit)
    lo, hi = F.col("lo"), F.col("hi")
    length = hi - lo
    left = (F.greatest(lo - length, F.lit(0)), lo)
    right = left if compat else (hi, hi + length)
    counts = count_in_ranges(
        sites,
        ["contig", "lo", "hi"],
        "contig",
        snvs.select("contig", F.lit("snv").alias("series"), "pos"),
        "pos",
        [
            RangeCount("snvs_left", "snv", *left),
            RangeCount("snvs_within", "snv", lo, hi),
            RangeCount("snvs_right", "snv", *right),
        ],
    )
    return cnvs.join(counts, ["contig", "lo", "hi"]).select(
        "row_id", "snvs_left", "snvs_within", "snvs_right"
    )


def baf_lists(svs: DataFrame, snvs: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """``row_id``, ``bafs``: allele fractions inside duplications and CNVs, by position, joined by ``;``.

    A list is one text by the format of the file. It is made in the row it belongs to and not moved after.
    """
    cnvs, _ = _cnv_sites(svs, limit, ["DUP", "CNV"])
    fraction = F.format_string("%.5f", F.col("baf"))
    listed = with_joined(cnvs.drop("sv_type"), snvs, "contig", "pos", order, fraction, "bafs")
    return listed.select("row_id", F.coalesce("bafs", F.lit("")).alias("bafs"))


def homozygosity_run(sv_len: Column, left: Column, within: Column, right: Column) -> Column:
    """True where the variant and one of its flanks have fewer SNVs than its length lets expect."""
    least = F.when(sv_len >= 100_000, F.lit(50).cast("bigint")).otherwise(5 * F.expr("sv_len div 10000"))
    return ((right < least) | (left < least)) & (within < least)


def annotate(
    svs: DataFrame,
    config: Config,
    evidence: DataFrame | None = None,
    windows: DataFrame | None = None,
    autosome_median: float | Column | None = None,
    snvs: DataFrame | None = None,
    compat: bool = False,
) -> DataFrame:
    """Variants with the evidence columns ``PR SR RD VL VM VR ROH``; NULL where nothing is to be written.

    Columns exist only for the kinds of evidence that are given.
    """
    result = svs
    crop = config.annotation_doc_baf_limit if compat else None
    if evidence is not None:
        counts = evidence_counts(
            svs, evidence, config.annotate_read_evidence_max_dist, config.annotate_read_evidence_slack, compat
        )
        result = result.join(counts, "row_id", "left").select(
            *result.columns,
            F.coalesce("pe_count", F.lit(0)).cast("float").alias("PR"),
            F.coalesce("sr_count", F.lit(0)).cast("float").alias("SR"),
        )
    if windows is not None:
        ratio = depth_ratio(
            svs, windows, autosome_median, crop, config.doc_annotation_min_bins
        )
        result = result.join(ratio, "row_id", "left").withColumn("RD", F.col("norm_cov").cast("float")).drop("norm_cov")
    if snvs is not None:
        counts = snv_counts(svs, snvs, crop, compat)
        deletion = F.col("sv_type") == "DEL"
        roh = homozygosity_run(F.col("sv_len"), F.col("snvs_left"), F.col("snvs_within"), F.col("snvs_right"))
        result = (
            result.join(counts, "row_id", "left")
            .withColumn("VL", F.when(deletion, F.col("snvs_left")))
            .withColumn("VM", F.when(deletion, F.col("snvs_within")))
            .withColumn("VR", F.when(deletion, F.col("snvs_right")))
            .withColumn("ROH", F.when(roh, 1))
            .drop("snvs_left", "snvs_within", "snvs_right")
        )
    return result
