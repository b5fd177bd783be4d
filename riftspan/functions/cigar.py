"""CIGAR string arithmetic with built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_DIGITS = "0123456789"
_OPERATIONS = "MIDNSHP=X"


def _as_length(text: Column) -> Column:
    """The number a text consists of, zero if it is anything else."""
    return F.coalesce(text.try_cast("int"), F.lit(0))


def leading(op: str, cigar: str = "cigar") -> Column:
    """Length of the clip operation ``H`` or ``S`` at the left end, zero if there is none.

    A soft clip may sit behind a hard clip. Plain string functions are used, since regular
    expressions dominate the cost of a scan.
    """
    text = F.col(cigar)
    before = F.substring_index(text, op, 1)
    number = before if op == "H" else F.substring_index(before, "H", -1)
    return F.when(text.contains(op), _as_length(number)).otherwise(F.lit(0))


def _last_number(text: Column) -> Column:
    return _as_length(F.substring_index(F.translate(text, _OPERATIONS, " " * len(_OPERATIONS)), " ", -1))


def _without_last(text: Column) -> Column:
    return F.substr(text, F.lit(1), F.length(text) - 1)


def trailing(op: str, cigar: str = "cigar") -> Column:
    """Length of the clip operation ``H`` or ``S`` at the right end, zero if there is none."""
    text = F.col(cigar)
    if op == "S":
        # Take off a hard clip behind the soft clip.
        text = F.when(text.endswith("H"), F.rtrim(_without_last(text), F.lit(_DIGITS))).otherwise(text)
    return F.when(text.endswith(op), _last_number(_without_last(text))).otherwise(F.lit(0))


def reference_length(cigar: str = "cigar") -> Column:
    """Number of reference bases consumed."""
    pieces = F.regexp_extract_all(F.col(cigar), F.lit(r"(\d+)[MDN=X]"), 1)
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def end_position(pos: str = "pos", cigar: str = "cigar") -> Column:
    """Zero-based exclusive end of the alignment on the reference."""
    return F.col(pos) + reference_length(cigar)


def operation_count(cigar: str = "cigar") -> Column:
    """Number of CIGAR operations."""
    return F.length(F.regexp_replace(F.col(cigar), r"[\d*]", "")).cast("long")


def clip_columns(cigar: str = "cigar") -> dict[str, Column]:
    """Clip lengths by column name. Readers note them once, so that predicates compare plain numbers."""
    return {
        "left_hard": leading("H", cigar),
        "left_soft": leading("S", cigar),
        "right_hard": trailing("H", cigar),
        "right_soft": trailing("S", cigar),
    }
