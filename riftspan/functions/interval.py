"""Half-open interval arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column | int) -> Column:
    """Whole-number quotient, cut towards zero. It never decreases as ``a`` grows, so it may name bins."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """True where two half-open intervals share a position; touching intervals do not."""
    return (a_start < b_end) & (b_start < a_end)


def overlap_length(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length of the shared part, zero for disjoint intervals."""
    return F.greatest(F.least(a_end, b_end) - F.greatest(a_start, b_start), F.lit(0))


def float_ratio(part: Column, whole: Column) -> Column:
    """Quotient in single precision, NULL for an empty denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double")).cast("float")


def clamp_sub(a: Column, b: Column | int) -> Column:
    """``a - b``, but never below zero."""
    return F.greatest(a - (F.lit(b) if isinstance(b, int) else b), F.lit(0).cast("long"))


def centre_crop(start: Column, end: Column, limit: int) -> tuple[Column, Column]:
    """Cut an interval longer than ``limit`` by the same amount on both sides (whole bases)."""
    surplus = end - start - F.lit(limit)
    shift = F.when(surplus > 0, F.floor(surplus / 2).cast("long")).otherwise(F.lit(0).cast("long"))
    return start + shift, end - shift


def sv_interval(pos: Column, end2: Column, sv_type: Column) -> tuple[Column, Column]:
    """Interval of a variant: one base for a breakend, otherwise the ordered pair of its ends."""
    far = F.when(sv_type == "BND", pos + 1).otherwise(end2)
    return F.least(pos, far), F.greatest(pos, far)
