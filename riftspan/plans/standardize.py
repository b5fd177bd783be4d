"""Translation of variant-caller dialects into one structural-variant layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.functions.calls import (
    TYPE_STRANDS,
    breakend_contig,
    breakend_pos,
    breakend_strands,
    connection_strands,
    is_called,
    passes_filters,
)

TOOLS = ("cnmops", "delly", "manta")


def _info(name: str) -> Column:
    return F.try_element_at(F.col("info"), F.lit(name))


def _length(sv_type: Column, end2: Column) -> Column:
    return F.when(sv_type == "BND", F.lit(-1).cast("bigint")).otherwise(end2 - F.col("pos"))


def _cnmops(rows: DataFrame) -> DataFrame:
    end2 = _info("END").cast("bigint")
    return rows.select(
        "*",
        F.get("alts", F.lit(0)).alias("alt"),
        F.col("ref").alias("reference"),
        end2.alias("end2"),
        F.col("chrom").alias("chrom2"),
        _info("SVTYPE").alias("sv_type"),
        F.lit(None).cast("string").alias("strands"),
        (end2 - F.col("pos")).alias("sv_len"),
    )


def _delly(rows: DataFrame) -> DataFrame:
    end2 = F.coalesce(_info("END2"), _info("END")).cast("bigint")
    sv_type = _info("SVTYPE")
    return rows.filter(sv_type != "INS").select(
        "*",
        F.get("alts", F.lit(0)).alias("alt"),
        F.col("ref").alias("reference"),
        end2.alias("end2"),
        _info("CHR2").alias("chrom2"),
        sv_type.alias("sv_type"),
        connection_strands(_info("CT")).alias("strands"),
        _length(sv_type, end2).alias("sv_len"),
    )


def _manta(rows: DataFrame) -> DataFrame:
    raw_type = _info("SVTYPE")
    sv_type = F.when(raw_type == "DUP:TANDEM", "DUP").otherwise(raw_type)
    alt = F.get("alts", F.lit(0))
    breakend = sv_type == "BND"
    end2 = F.when(breakend, breakend_pos(alt)).otherwise(_info("END").cast("bigint"))
    by_type = F.create_map(*[F.lit(x) for pair in TYPE_STRANDS.items() for x in pair])
    strands = (
        F.when(breakend, breakend_strands(alt))
        .when(sv_type == "INV", F.when(_info("INV3").isNotNull(), "++").otherwise("--"))
        .otherwise(F.try_element_at(by_type, sv_type))
    )
    return rows.filter(raw_type != "INS").select(
        "*",
        F.when(breakend, alt).otherwise(F.concat(F.lit("<"), sv_type, F.lit(">"))).alias("alt"),
        F.substring("ref", 1, 1).alias("reference"),
        end2.alias("end2"),
        F.when(breakend, breakend_contig(alt)).otherwise(F.col("chrom")).alias("chrom2"),
        sv_type.alias("sv_type"),
        F.coalesce(strands, F.raise_error(F.concat(F.lit("cannot tell strands of "), alt)).cast("string")).alias("strands"),
        _length(sv_type, end2).alias("sv_len"),
    )


_DIALECTS = {"cnmops": _cnmops, "delly": _delly, "manta": _manta}


def standardize(variants: DataFrame, tool: str, apply_filters: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a caller's variant table in the common layout.

    Insertions are left out, and with ``apply_filters`` also rows with a filter other than PASS. The
    row id is not taken over. ``called`` in ``calls`` tells whether any allele differs from the reference.
    """
    rows = variants.filter(passes_filters(F.col("filters"))) if apply_filters else variants
    genotype = F.transform(
        "calls",
        lambda c: F.struct(
            c["sample"].alias("sample"),
            F.coalesce(F.try_element_at(c["fields"], F.lit("GT")), F.lit("./.")).alias("gt"),
            F.coalesce(is_called(F.try_element_at(c["fields"], F.lit("GT"))), F.lit(False)).cast("int").alias("called"),
        ),
    )
    return _DIALECTS[tool](rows).select(
        *carry,
        "chrom",
        "pos",
        "reference",
        "alt",
        "end2",
        "chrom2",
        "sv_type",
        "strands",
        "sv_len",
        F.array(F.lit(tool)).alias("algorithms"),
        genotype.alias("calls"),
    )


def parse_standardized(variants: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Structural-variant rows from a file in the common layout.

    Absent strands become ``.``; alleles are joined by dashes; only the flag of the caller ``delly``
    is read back as the origin of a sample's call.
    """
    def call(c: Column) -> Column:
        gt = F.coalesce(F.try_element_at(c["fields"], F.lit("GT")), F.lit("."))
        flag = F.try_element_at(c["fields"], F.lit("delly"))
        return F.struct(
            c["sample"].alias("sample"),
            F.regexp_replace(gt, r"[/|]", "-").alias("gt"),
            F.when(flag.isNotNull() & (flag != "0"), F.array(F.lit("delly")))
            .otherwise(F.array().cast("array<string>"))
            .alias("called_by"),
        )

    return variants.select(
        *carry,
        "chrom",
        "pos",
        F.col("id").alias("sv_id"),
        F.col("ref").alias("reference"),
        F.get("alts", F.lit(0)).alias("alt"),
        "filters",
        _info("CHR2").alias("chrom2"),
        _info("END2").cast("bigint").alias("end2"),
        _info("SVTYPE").alias("sv_type"),
        F.coalesce(_info("STRANDS"), F.lit(".")).alias("strands"),
        _info("SVLEN").cast("bigint").alias("sv_len"),
        F.split(_info("ALGORITHMS"), ",").alias("algorithms"),
        F.transform("calls", call).alias("calls"),
    )
