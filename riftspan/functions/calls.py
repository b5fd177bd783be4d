"""Variant-call expressions: breakend notation, strands, genotypes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Connection types of one caller and the breakpoint strands they stand for.
CONNECTION_STRANDS = {"5to3": "-+", "3to5": "+-", "5to5": "--", "3to3": "++"}

# Breakpoint strands implied by the variant type for another caller.
TYPE_STRANDS = {"DEL": "+-", "DUP": "-+", "INS": "+-"}

#: Bases, a bracket, the remote contig and position, the same bracket, bases; bases stand on one side.
BREAKEND_PATTERN = r"^[A-Za-z.*]*(\[|\])(.+):([0-9]+)\1[A-Za-z.*]*$"


def connection_strands(connection: Column, sv_id: Column | None = None) -> Column:
    """Strands for a connection type; an unknown one is an error."""
    table = F.create_map(*[F.lit(x) for pair in CONNECTION_STRANDS.items() for x in pair])
    known = F.try_element_at(table, connection)
    message = F.concat(F.lit("improper strands: "), F.coalesce(connection, F.lit("none")))
    return F.coalesce(known, F.raise_error(message).cast("string"))


def breakend_contig(alt: Column) -> Column:
    """Contig of the remote end; empty if the text is no breakend."""
    return F.regexp_extract(alt, BREAKEND_PATTERN, 2)


def breakend_pos(alt: Column) -> Column:
    """One-based position of the remote end, NULL if the text is no breakend."""
    text = F.regexp_extract(alt, BREAKEND_PATTERN, 3)
    return F.when(text != "", text).cast("long")


def breakend_strands(alt: Column) -> Column:
    """Strands by the bracket at either end of the text, NULL if there is none."""
    return (
        F.when(alt.endswith("["), "+-")
        .when(alt.endswith("]"), "++")
        .when(alt.startswith("]"), "-+")
        .when(alt.startswith("["), "--")
    )


def passes_filters(filters: Column) -> Column:
    """True if no filter other than PASS is set; an empty list passes."""
    return ~F.exists(filters, lambda f: f != "PASS")


def alleles(gt: Column) -> Column:
    """Allele texts of a genotype, ``.`` where missing."""
    return F.split(gt, r"[/|]")


def allele_index(gt: Column, which: int) -> Column:
    """Allele number at a place of the genotype; zero when missing."""
    text = F.get(alleles(gt), F.lit(which))
    return F.coalesce(F.when(text.rlike(r"^\d+$"), text).cast("int"), F.lit(0))


def is_called(gt: Column) -> Column:
    """True if any allele differs from the reference; missing alleles do not count."""
    return F.exists(alleles(gt), lambda a: (a != ".") & (a != "0"))


def clustered_genotype(gt: Column) -> Column:
    """Diploid text written for a sample of a cluster, from the dash-joined allele numbers.

    The first and last character decide, so a haploid ``1`` is written as ``1/1``.
    """
    first = F.when(gt.startswith("1"), "1").otherwise("0")
    last = F.when(gt.endswith("1"), "1").otherwise("0")
    return F.concat(first, F.lit("/"), last)


def ones(gt: Column) -> Column:
    """Number of ``1`` characters in a genotype text."""
    return F.length(gt) - F.length(F.replace(gt, F.lit("1"), F.lit("")))
