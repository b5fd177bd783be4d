"""Predicates on alignment rows: clipping, discordance, and filters for depth and library statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riftspan.functions.flags import (
    DUPLICATE,
    MATE_REVERSE,
    MATE_UNMAPPED,
    PAIRED,
    PROPER_PAIR,
    QC_FAIL,
    REVERSE,
    SECONDARY,
    SUPPLEMENTARY,
    UNMAPPED,
    has_flag,
    lacks_all,
)


def clipped(side: str, min_clipped: int, masked_secondary: bool = True) -> Column:
    """Split-read test for one end, ``left`` or ``right``, by the clip lengths noted at reading.

    Supplementary rows (and secondary ones, when the aligner marks split alignments so) count by
    hard clipping alone, primary rows by either kind.
    """
    hard, soft = F.col(f"{side}_hard"), F.col(f"{side}_soft")
    alternative = has_flag(SUPPLEMENTARY | SECONDARY) if masked_secondary else has_flag(SUPPLEMENTARY)
    primary = lacks_all(SUPPLEMENTARY | SECONDARY)
    return ((alternative | primary) & (hard >= min_clipped)) | (primary & (soft >= min_clipped))


def split_left(min_clipped: int, masked_secondary: bool = True) -> Column:
    """Clipped at the left end."""
    return clipped("left", min_clipped, masked_secondary)


def split_right(min_clipped: int, masked_secondary: bool = True) -> Column:
    """Clipped at the right end."""
    return clipped("right", min_clipped, masked_secondary)


def discordant(max_normal_isize: int | Column, tid: str = "tid", mtid: str = "mtid", tlen: str = "tlen") -> Column:
    """Discordance test.

    Only the contig comparison requires a paired row: insert size and orientation are judged on
    every row, so an unpaired forward row is discordant by orientation.
    """
    t, m = F.col(tid), F.col(mtid)
    limit = F.lit(max_normal_isize) if isinstance(max_normal_isize, int) else max_normal_isize
    return (
        (has_flag(PAIRED) & (t >= 0) & (m >= 0) & (t != m))
        | (F.abs(F.col(tlen)) > limit)
        | (has_flag(REVERSE) == has_flag(MATE_REVERSE))
    )


def usable(masked_secondary: bool = True) -> Column:
    """Rows that may carry evidence at all."""
    bits = QC_FAIL | DUPLICATE | UNMAPPED | MATE_UNMAPPED
    return lacks_all(bits if masked_secondary else bits | SECONDARY)


def interesting(
    max_normal_isize: int, min_clipped: int, masked_secondary: bool = True
) -> Column:
    """Usable rows that are clipped at either end or discordant."""
    return usable(masked_secondary) & (
        discordant(max_normal_isize)
        | split_left(min_clipped, masked_secondary)
        | split_right(min_clipped, masked_secondary)
    )


def library_sample(tid: str = "tid", mtid: str = "mtid", tlen: str = "tlen") -> Column:
    """Rows that inform the insert-size model: the left ends of clean proper pairs."""
    return (
        (F.col("flag").bitwiseAND(F.lit(PAIRED | PROPER_PAIR)) == (PAIRED | PROPER_PAIR))
        & lacks_all(UNMAPPED | MATE_UNMAPPED | SECONDARY | SUPPLEMENTARY | QC_FAIL | DUPLICATE)
        & (F.col(tlen) > 0)
        & (F.col(tid) == F.col(mtid))
    )


def _counted(min_mapq: int | None) -> Column:
    cond = lacks_all(SECONDARY | SUPPLEMENTARY | DUPLICATE | QC_FAIL) & (
        ~has_flag(PAIRED) | has_flag(PROPER_PAIR)
    )
    return cond if min_mapq is None else cond & (F.col("mapq") >= min_mapq)


def coverage_row(min_mapq: int | None) -> Column:
    """Rows that add to base coverage."""
    return lacks_all(UNMAPPED) & _counted(min_mapq)


def fragment_row(min_mapq: int | None, min_unclipped: float | None) -> Column:
    """Rows that stand for one fragment: the leftmost of a proper pair, or an unpaired row."""
    cond = _counted(min_mapq) & (~has_flag(PAIRED) | (F.col("tlen") > 0))
    if min_unclipped is None:
        return cond
    length = F.col("seq_len").cast("double")
    clips = F.col("left_hard") + F.col("left_soft") + F.col("right_hard") + F.col("right_soft")
    ratio = F.try_divide(length - clips, length).cast("float")
    return cond & ~F.coalesce(ratio < F.lit(min_unclipped).cast("float"), F.lit(False))


def fragment_centre(end: Column) -> Column:
    """Middle of the fragment: of the template for pairs, of the alignment for single rows."""
    return F.when(has_flag(PAIRED), F.col("pos") + F.expr("tlen div 2")).otherwise(
        F.floor((F.col("pos") + end) / 2).cast("long")
    )
