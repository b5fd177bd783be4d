"""The seven file-to-file tools: each reads files, runs a plan and writes files."""

from __future__ import annotations

import datetime
import logging
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from riftspan.config import Config
from riftspan.errors import InconsistentInput, UnknownClusterSetting
from riftspan.functions.cigar import operation_count
from riftspan.functions.text import plain_number
from riftspan.plans import annotate as an
from riftspan.plans import cluster as cu
from riftspan.plans import depth as dp
from riftspan.plans import evidence as ev
from riftspan.plans import scan as sc
from riftspan.plans import standardize as st
from riftspan.plans import unique as un
from riftspan.plans.library import LibraryProperties, estimate_library, library_from_header
from riftspan.session import reliable_checkpoint
from riftspan.sources import headers as hd
from riftspan.sources import sam, staged, vcf
from riftspan.sources.evidence_file import read_evidence, write_evidence
from riftspan.sources.fasta import reference_windows
from riftspan.sources.regions import Region, fetch_regions, read_bed, region_table, whole_contigs
from riftspan.sources.textio import BLOCK, ORDER, guard_output, write_lines


log = logging.getLogger(__name__)


def _alignment_regions(contigs: list[hd.Contig], regions: list[Region] | None) -> list[Region]:
    return regions if regions is not None else whole_contigs([(c.name, c.length) for c in contigs])


def _variant_regions(contigs: list[hd.Contig], regions: list[Region] | None) -> list[Region]:
    return regions if regions is not None else whole_contigs([(c.name, None) for c in contigs])


def scan(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    config: Config = Config(),
    regions: list[Region] | None = None,
    library: LibraryProperties | None = None,
    overwrite: bool = False,
    single_file: bool = False,
    compat: bool = False,
) -> None:
    """Write reads that show evidence, and their mates.

    ``compat`` writes them with the repetitions of a windowed two-pass scan and tests blocked
    regions with the number of CIGAR operations as alignment length.
    """
    guard_output(spark, path_out, overwrite)
    header = sam.alignment_header(spark, path_in)
    contigs = hd.alignment_contigs(header)
    rows = sam.read_alignments(spark, path_in)
    if library is None:
        library = estimate_library(rows, config, compat)
    blocked = None
    if config.blocked_regions_bed:
        blocked = read_bed(spark, config.blocked_regions_bed, [c.name for c in contigs])
    blocked_end = F.col("pos") + operation_count() if compat else F.col("end")
    table = region_table(spark, _alignment_regions(contigs, regions))
    rows = sam.read_alignments(spark, path_in, regions=regions)
    kept = sc.scan_reads(rows, table, library, config, ORDER, blocked, blocked_end, compat)
    order = ["region_ord", "window_no", "pass", *ORDER] if compat else ["region_ord", *ORDER]
    new_header = hd.scan_header(header, library.median_isize, library.std_dev_isize, library.max_rlen)
    sam.write_alignments(kept, F.col("raw"), order, new_header, path_out, overwrite, single_file)


def stage(spark: SparkSession, path_in: str, path_out: str, overwrite: bool = False) -> None:
    """Write an alignment or variant file as a table in the order of position, which the other tools read by region."""
    if path_in.endswith((".sam", ".bam")):
        rows, header = sam.read_alignments(spark, path_in), sam.alignment_header(spark, path_in)
        staged.stage(rows, path_out, "contig", F.col("pos"), F.greatest(F.col("end"), F.col("pos") + 1), header, overwrite)
    else:
        rows, header = vcf.read_variants(spark, path_in), vcf.variant_header(spark, path_in)
        staged.stage(rows, path_out, "chrom", F.col("pos"), F.greatest(vcf.variant_end(), F.col("pos") + 1), header, overwrite)


def unique(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    config: Config = Config(),
    overwrite: bool = False,
    single_file: bool = False,
) -> None:
    """Write a file grouped by name without repeated alignments, each with its read id in tag ``xI``."""
    guard_output(spark, path_out, overwrite)
    header = sam.alignment_header(spark, path_in)
    kept = un.unique_reads(sam.read_alignments(spark, path_in), BLOCK, ["seq"])
    line = F.concat(F.col("raw"), F.lit("\txI:i:"), F.col("read_id").cast("string"))
    sam.write_alignments(kept, line, ORDER, header, path_out, overwrite, single_file)


def collect_evidence(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    config: Config = Config(),
    regions: list[Region] | None = None,
    library: LibraryProperties | None = None,
    overwrite: bool = False,
    single_file: bool = False,
    compat: bool = False,
) -> None:
    """Write the evidence of reads that carry a read id."""
    guard_output(spark, path_out, overwrite)
    header = sam.alignment_header(spark, path_in)
    rows = sam.read_alignments(spark, path_in)
    library = library or library_from_header(header, config, compat) or estimate_library(rows, config, compat)
    tag = F.try_element_at(F.col("tags"), F.lit("xI")).cast("bigint")
    rows = sam.read_alignments(spark, path_in, regions=regions)
    marked = rows.withColumn("read_id", F.coalesce(tag, F.raise_error(F.lit("read without tag xI")).cast("bigint")))
    table = region_table(spark, _alignment_regions(hd.alignment_contigs(header), regions))
    inside = fetch_regions(marked, table, "contig", F.col("pos"), F.greatest(F.col("end"), F.col("pos") + 1))
    found = ev.extract_evidence(
        inside,
        library.max_normal_isize,
        config.min_clipped_bases,
        config.supplementary_masked_as_secondary,
        ("region_ord", "tid", *ORDER),
    )
    write_evidence(found, ["region_ord", "start", *ORDER, "part"], path_out, overwrite, single_file)


def collect_depth(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    config: Config = Config(),
    regions: list[Region] | None = None,
    overwrite: bool = False,
    single_file: bool = False,
    date: str | None = None,
) -> None:
    """Write windowed depth of coverage, with medians per contig in the header."""
    guard_output(spark, path_out, overwrite)
    header = sam.alignment_header(spark, path_in)
    contigs = hd.alignment_contigs(header)
    samples = hd.alignment_samples(header) or ["sample"]
    settings = config.collect_doc_config
    w = settings.window_length
    wanted = [r.contig for r in regions] if regions is not None else [c.name for c in contigs]
    table = hd.contig_table(spark, contigs).filter(F.col("contig").isin(wanted))
    counters = Observation()
    rows = dp.count_rows(sam.read_alignments(spark, path_in).filter(F.col("contig").isin(wanted)), settings, counters)
    windows = dp.depth_windows(rows, table, settings)
    if regions is not None:
        places = region_table(spark, regions)
        windows = fetch_regions(
            windows, places, "contig", F.col("window_id") * w, (F.col("window_id") + 1) * w
        ).dropDuplicates(["contig", "window_id"]).drop("region_ord")
    has_reference = config.path_reference_fasta is not None
    if has_reference:
        windows = dp.with_composition(windows, reference_windows(spark, config.path_reference_fasta, w))
    # Used twice, for the medians in the header and for the rows.
    stored = reliable_checkpoint(windows)
    log.info("%d alignments processed, %d skipped", *(dp.counted_rows(counters) or (0, 0)))
    known = {r["name"]: r["median"] for r in dp.depth_medians(stored, dp.AUTOSOMES, dp.ALLOSOMES).collect()}
    for contig in contigs:
        if contig.name in dp.AUTOSOMES + dp.ALLOSOMES:
            known.setdefault(contig.name, 0.0)
    known.setdefault("autosomes", 0.0)
    placed = stored.join(F.broadcast(hd.contig_table(spark, contigs)), "contig").withColumn(
        "start", F.col("window_id") * w
    )
    placed = placed.withColumn("end", F.least(F.col("start") + w, F.col("length")))
    day = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d")
    line = vcf.depth_line(settings.count_kind == "coverage", has_reference)
    vcf.write_variants(
        placed, line, ["tid", "start"], hd.depth_header(contigs, samples[:1], day, known), path_out, overwrite, single_file
    )


def standardize(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    tool: str,
    config: Config = Config(),
    regions: list[Region] | None = None,
    overwrite: bool = False,
    single_file: bool = False,
    compat: bool = False,
) -> None:
    """Write the variants of one caller in the common layout."""
    guard_output(spark, path_out, overwrite)
    header = vcf.variant_header(spark, path_in)
    contigs, samples = hd.variant_contigs(header), hd.variant_samples(header)
    table = region_table(spark, _variant_regions(contigs, regions))
    rows = fetch_regions(vcf.read_variants(spark, path_in, regions=regions), table, "chrom", F.col("pos"), vcf.variant_end())
    out = st.standardize(rows, tool, config.stdvcf_apply_filters, ("region_ord", *ORDER))
    vcf.write_variants(
        out,
        vcf.standardized_line(),
        ["region_ord", "pos", *ORDER],
        hd.sv_header(contigs, samples, compat),
        path_out,
        overwrite,
        single_file,
    )


def _cluster_settings(name: str, config: Config):
    presets = {
        "per_tool_pesr": config.vcf_cluster_presets_per_tool_pesr,
        "per_tool_doc": config.vcf_cluster_presets_per_tool_doc,
    }
    if name not in presets:
        raise UnknownClusterSetting(name)
    return presets[name]


def check_contigs(contig_lists: list[list[str]]) -> None:
    """All inputs must declare the same contigs."""
    if not contig_lists or any(set(names) != set(contig_lists[0]) for names in contig_lists):
        raise InconsistentInput("input files differ in their contigs")


def _is_text(spark: SparkSession, path: str) -> bool:
    return not path.endswith(".bcf") and not staged.is_staged(spark, path)


def _facts(spark: SparkSession, paths: list[str]) -> list[Row]:
    """Contigs and samples of all inputs in their order; text files by one job, others one by one."""
    text = [i for i, p in enumerate(paths) if _is_text(spark, p)]
    found = {text[f["file_ord"]]: f for f in vcf.header_facts(spark, [paths[i] for i in text])} if text else {}
    out = []
    for i, path in enumerate(paths):
        if i in text:
            own = found.get(i)
            out.append(Row(file_ord=i, contigs=own["contigs"] if own else [], samples=own["samples"] if own else []))
        else:
            header = vcf.variant_header(spark, path)
            out.append(Row(file_ord=i, contigs=sorted({c.name for c in hd.variant_contigs(header)}), samples=hd.variant_samples(header)))
    return out


def _numbered_variants(
    spark: SparkSession, paths: list[str], regions: list[Region], facts: list[Row]
) -> DataFrame:
    """Standardized variants of all files inside the regions, with ``row_id`` in input order.

    All text files are one scan, so neither the plan nor the number of jobs grows with them.
    """
    text = [i for i, p in enumerate(paths) if _is_text(spark, p)]
    read = []
    if text:
        own = [Row(file_ord=k, samples=facts[i]["samples"]) for k, i in enumerate(text)]
        rows = vcf.read_many_variants(spark, [paths[i] for i in text], own)
        if text != list(range(len(text))):
            place = F.array(*[F.lit(i) for i in text])
            rows = rows.withColumn("file_ord", F.get(place, F.col("file_ord")))
        read.append(rows)
    read += [vcf.read_variants(spark, paths[i], i, regions) for i in range(len(paths)) if i not in text]
    table = region_table(spark, regions)
    parsed = [st.parse_standardized(fetch_regions(r, table, "chrom", F.col("pos"), vcf.variant_end()), ("region_ord", *ORDER, "raw")) for r in read]
    together = reduce(lambda a, b: a.unionByName(b), parsed)
    from riftspan.operators.ordered import global_row_number

    return global_row_number(together, ["region_ord", "file_ord", "pos", "block", "seq"], "row_id")


def cluster(
    spark: SparkSession,
    paths_in: list[str],
    path_out: str,
    setting: str = "per_tool_pesr",
    config: Config = Config(),
    regions: list[Region] | None = None,
    overwrite: bool = False,
    single_file: bool = False,
    compat: bool = False,
) -> None:
    """Cluster standardized variants of several files into one file with all samples."""
    guard_output(spark, path_out, overwrite)
    settings = _cluster_settings(setting, config)
    facts = _facts(spark, paths_in)
    check_contigs([f["contigs"] for f in facts])
    contigs = hd.variant_contigs(vcf.variant_header(spark, paths_in[0]))
    samples = list(dict.fromkeys(s for f in facts for s in f["samples"]))
    variants = _numbered_variants(spark, paths_in, _variant_regions(contigs, regions), facts)
    records = cu.cluster_variants(variants.drop("raw"), settings, keep_other_types=not compat)
    kept = ["region_ord", "number", "chrom", "pos", "reference", "alt", "chrom2", "end2", "sv_type", "strands", "sv_len", "sv_id", "algorithms"]
    wide = cu.sample_matrix(records, kept, samples)
    vcf.write_variants(
        wide,
        vcf.clustered_line(),
        ["number"],
        hd.sv_header(contigs, samples, compat),
        path_out,
        overwrite,
        single_file,
    )


def annotate(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    sample: str,
    config: Config = Config(),
    path_pesr_evidence: str | None = None,
    path_doc_evidence: str | None = None,
    path_snv_vcf: str | None = None,
    path_out_doc_summary: str | None = None,
    path_out_baf_snvs: str | None = None,
    regions: list[Region] | None = None,
    overwrite: bool = False,
    single_file: bool = False,
    compat: bool = False,
) -> None:
    """Annotate variants with the kinds of evidence that are given, and write the side outputs asked for."""
    for path in (path_out, path_out_doc_summary, path_out_baf_snvs):
        if path is not None:
            guard_output(spark, path, overwrite)
    header = vcf.variant_header(spark, path_in)
    contigs, samples = hd.variant_contigs(header), hd.variant_samples(header)
    if not compat and sample not in samples:
        raise InconsistentInput(f"sample {sample} is not in {path_in}")
    listed = _variant_regions(contigs, regions)
    svs = _numbered_variants(spark, [path_in], listed, [Row(file_ord=0, samples=samples)])
    blocked = None
    if config.blocked_regions_bed:
        blocked = read_bed(spark, config.blocked_regions_bed, [c.name for c in contigs])

    evidence = None
    if path_pesr_evidence:
        evidence = read_evidence(spark, path_pesr_evidence)
        if compat:
            evidence = fetch_regions(
                evidence, region_table(spark, listed), "file_contig", F.col("file_start"), F.col("file_end")
            ).drop("region_ord")
        if blocked is not None:
            evidence = an.drop_blocked_evidence(evidence, blocked)

    windows, medians = None, None
    if path_doc_evidence:
        windows = vcf.depth_rows(vcf.read_variants(spark, path_doc_evidence))
        medians = {r["name"]: r["median"] for r in dp.depth_medians(windows, dp.AUTOSOMES, dp.ALLOSOMES).collect()}
        medians.setdefault("autosomes", 0.0)
        if path_out_doc_summary:
            names = sorted(n for n in medians if n != "autosomes")
            table = [(i, f"{n}\t{plain_number(medians[n])}") for i, n in enumerate(["autosomes", *names])]
            lines = spark.createDataFrame(table, "i int, line string")
            write_lines(lines, F.col("line"), ["i"], [f"CHROM\t{samples[0]}"], path_out_doc_summary, overwrite, single_file)

    snvs = None
    if path_snv_vcf:
        snvs = an.het_snvs(vcf.read_variants(spark, path_snv_vcf), tuple(ORDER))
        if path_out_baf_snvs:
            lists = an.baf_lists(svs, snvs, ORDER, config.annotation_doc_baf_limit if compat else None)
            named = svs.select("row_id", "sv_id").join(lists, "row_id")
            snv_sample = hd.variant_samples(vcf.variant_header(spark, path_snv_vcf))[0]
            line = F.concat_ws("\t", "sv_id", F.lit(snv_sample), "bafs")
            write_lines(named, line, ["row_id"], ["SVID\tSAMPLE\tBAFS"], path_out_baf_snvs, overwrite, single_file)

    result = an.annotate(
        svs, config, evidence, windows, None if medians is None else medians["autosomes"], snvs, compat
    )
    vcf.write_variants(
        result,
        vcf.annotated_line(result.columns),
        ["row_id"],
        hd.sv_header(contigs, samples, compat),
        path_out,
        overwrite,
        single_file,
    )
