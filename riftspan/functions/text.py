"""Number formatting for text sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_float(x: Column, digits: int = 6) -> Column:
    """Up to ``digits`` significant digits without trailing zeros, as usual in VCF files."""
    value = x.cast("double")
    size = F.when(value == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(value))).cast("int"))
    scale = F.pow(F.lit(10.0), (F.lit(digits - 1) - size).cast("double"))
    rounded = F.rint(value * scale) / scale
    plain = F.regexp_replace(F.format_string(f"%.{digits + 6}f", rounded), r"\.?0+$", "")
    return (
        F.when(value.isNull(), ".")
        .when(F.isnan(value), "nan")
        .when((size < -4) | (size >= digits), F.format_string(f"%.{digits - 1}e", value))
        .otherwise(F.when(plain == "", "0").otherwise(plain))
    )


def plain_number(x: float) -> str:
    """Shortest text of a number on the driver; whole numbers without a decimal point."""
    return str(int(x)) if float(x).is_integer() else repr(float(x))
