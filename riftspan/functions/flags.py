"""SAM FLAG bits as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the SAM format.
PAIRED = 1
PROPER_PAIR = 2
UNMAPPED = 4
MATE_UNMAPPED = 8
REVERSE = 16
MATE_REVERSE = 32
FIRST = 64
LAST = 128
SECONDARY = 256
QC_FAIL = 512
DUPLICATE = 1024
SUPPLEMENTARY = 2048


def has_flag(bit: int, flag: str = "flag") -> Column:
    """True where the bit is set."""
    return F.col(flag).bitwiseAND(F.lit(bit)) != 0


def lacks_all(bits: int, flag: str = "flag") -> Column:
    """True where none of the bits is set (one test for several flags)."""
    return F.col(flag).bitwiseAND(F.lit(bits)) == 0
