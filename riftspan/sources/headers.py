"""Facts from alignment and variant headers. Headers are small and handled on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Contig:
    """Name and length (None where the header does not give it)."""

    name: str
    length: int | None


def _fields(line: str) -> dict[str, str]:
    return dict(token.split(":", 1) for token in line.split("\t")[1:] if ":" in token)


def alignment_contigs(header: list[str], pattern: str | None = None) -> list[Contig]:
    """Reference sequences in header order, optionally only those whose name matches ``pattern``."""
    found = []
    for line in header:
        if line.startswith("@SQ"):
            fields = _fields(line)
            if pattern is None or re.search(pattern, fields["SN"]):
                found.append(Contig(fields["SN"], int(fields["LN"])))
    return found


def alignment_samples(header: list[str]) -> list[str]:
    """Samples of the read groups that have both an id and a sample, by first appearance."""
    groups = [_fields(line) for line in header if line.startswith("@RG")]
    return list(dict.fromkeys(g["SM"] for g in groups if "ID" in g and "SM" in g))


def scan_header(header: list[str], median: float, deviation: float, read_length: int) -> list[str]:
    """Header of selected reads: unordered, with the library statistics in every read group."""
    from riftspan.functions.text import plain_number

    note = f"\tPI:{plain_number(median)}\tPS:{plain_number(deviation)}\tPR:{read_length}"
    result = []
    for line in header:
        if line.startswith("@HD"):
            result.append("@HD\tVN:1.6\tSO:unordered")
        elif line.startswith("@RG"):
            result.append(line + note)
        else:
            result.append(line)
    return result


def variant_contigs(header: list[str]) -> list[Contig]:
    """Contigs declared in a variant header."""
    found = []
    for line in header:
        if line.startswith("##contig=<"):
            name = re.search(r"[<,]ID=([^,>]+)", line)
            length = re.search(r"[<,]length=(\d+)", line)
            if name:
                found.append(Contig(name.group(1), int(length.group(1)) if length else None))
    return found


def variant_samples(header: list[str]) -> list[str]:
    """Sample names from the column line."""
    for line in header:
        if line.startswith("#CHROM"):
            return line.split("\t")[9:]
    return []


def contig_table(spark: SparkSession, contigs: list[Contig]) -> DataFrame:
    """``(contig, tid, length)`` in header order."""
    rows = [(c.name, i, c.length) for i, c in enumerate(contigs)]
    return spark.createDataFrame(rows, "contig string, tid int, length bigint")


# Declarations of the structural-variant layout.
_ALTS = [("DEL", "Deletion"), ("DUP", "Duplication"), ("INV", "Inversion"), ("CNV", "Copy number variant")]
_INFOS = [
    ("AC", "A", "Integer", "Allele count in genotypes"),
    ("AN", "1", "Integer", "Total number of alleles in called genotypes"),
    ("SVTYPE", "1", "String", "Type of structural variant"),
    ("CHR2", "1", "String", "Chromosome of end coordinate"),
    ("END", "1", "Integer", "End position of linear SV"),
    ("END2", "1", "Integer", "End position of BND"),
    ("STRANDS", "1", "String", "Breakpoint strandedness"),
    ("SVLEN", "1", "Integer", "SV length"),
    ("ALGORITHMS", ".", "String", "Source algorithms"),
]
_FORMATS = [
    ("GT", "1", "String", "Genotype"),
    ("cnmops", "1", "Integer", "Called by cnMOPS"),
    ("delly", "1", "Integer", "Called by Delly"),
    ("manta", "1", "Integer", "Called by Manta"),
    ("PR", "1", "Float", "Paired read evidence"),
    ("SR", "1", "Float", "Split read evidence"),
    ("RD", "1", "Float", "Read depth evidence"),
    ("VL", "1", "Integer", "SNV count left of CNV region"),
    ("VM", "1", "Integer", "SNV count within CNV region"),
    ("VR", "1", "Integer", "SNV count right of CNV region"),
    ("ROH", "1", "Integer", "Run of homozygosity"),
]
# Declarations of the depth layout.
_DEPTH_LINES = [
    '##ALT=<ID=WINDOW,Description="Record describes a window for read or coverage counting">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="Window end">',
    '##INFO=<ID=MAPQ,Number=1,Type=Float,Description="Mean MAPQ value across samples for approximating mapability">',
    '##INFO=<ID=GC,Number=1,Type=Float,Description="Reference GC fraction, if reference FASTA file was given">',
    '##INFO=<ID=GAP,Number=0,Type=Flag,Description="Window overlaps with N in reference (gap)">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=MQ,Number=1,Type=Float,Description="Mean read MAPQ from region">',
    '##FORMAT=<ID=RCV,Number=1,Type=Float,Description="Raw coverage value">',
    '##FORMAT=<ID=RCVSD,Number=1,Type=Float,Description="Raw coverage standard deviation">',
]
_START = ["##fileformat=VCFv4.2", '##FILTER=<ID=PASS,Description="All filters passed">']
_COLUMNS = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def _contig_lines(contigs: list[Contig]) -> list[str]:
    return [f"##contig=<ID={c.name}" + (f",length={c.length}" if c.length is not None else "") + ">" for c in contigs]


def sv_header(contigs: list[Contig], samples: list[str], compat: bool = False) -> list[str]:
    """Header of the structural-variant layout.

    ``compat`` reproduces the original's declarations, which lack quotes and misname the description
    of the alternative alleles.
    """
    quote = "" if compat else '"'
    alt_key = "length" if compat else "Description"
    lines = [*_START, *_contig_lines(contigs)]
    lines += [f"##ALT=<ID={i},{alt_key}={quote}{d}{quote}>" for i, d in _ALTS]
    for kind, entries in (("INFO", _INFOS), ("FORMAT", _FORMATS)):
        lines += [f"##{kind}=<ID={i},Number={n},Type={t},Description={quote}{d}{quote}>" for i, n, t, d in entries]
    return [*lines, "\t".join([*_COLUMNS, *samples])]


def depth_header(
    contigs: list[Contig], samples: list[str], date: str, medians: dict[str, float] | None = None
) -> list[str]:
    """Header of the depth layout; ``medians`` maps contigs and ``autosomes`` to median coverage."""
    from riftspan.functions.text import plain_number

    lines = [*_START, f"##fileDate={date}", *_contig_lines(contigs), *_DEPTH_LINES]
    if medians is not None:
        by_contig = sorted(f"_{k}={plain_number(v)}" for k, v in medians.items() if k != "autosomes")
        values = ",".join([f"ID={samples[0]}", f"autosomes={plain_number(medians.get('autosomes', 0.0))}", *by_contig])
        lines.append(f"##median-coverage=<{values}>")
    return [*lines, "\t".join([*_COLUMNS, *samples])]
