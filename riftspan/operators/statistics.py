"""Descriptive statistics of a numeric column per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riftspan.operators.quantiles import exact_quantiles, exact_sum

# Fixed value: makes the median absolute deviation comparable to a standard deviation.
MAD_SCALE = 1.4826


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; not a number for a zero whole."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(float("nan")))


def moments(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Smallest and largest number (NaN left out) and sample deviation, zero for a single value."""
    x = F.col(value)
    number = F.when(~F.isnan(x), x)
    nan = F.lit(float("nan"))
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.coalesce(F.min(number), nan).alias("min"),
        F.coalesce(F.max(number), nan).alias("max"),
        F.coalesce(F.var_samp(x), F.lit(0.0)).alias("var"),
        F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("std_dev"),
    )


def median_abs_dev(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per group ``median``, ``median_abs_dev`` (scaled) and ``median_abs_dev_pct``."""
    medians = exact_quantiles(df, by, value, {"median": 0.5})
    distinct = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_times"))
    spread = distinct.join(medians, by).select(
        *by, F.abs(F.col(value) - F.col("median")).alias("_dev"), "_times"
    )
    deviations = exact_quantiles(spread, by, "_dev", {"_mad": 0.5}, "_times")
    scaled = F.col("_mad") * MAD_SCALE
    return medians.join(deviations, by).select(
        *by, "median", scaled.alias("median_abs_dev"), percent_of(scaled, F.col("median")).alias("median_abs_dev_pct")
    )


def summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """All statistics per group. The sum is exact, whatever the order of rows."""
    data = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias(value))
    quartiles = exact_quantiles(data, by, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    parts = [moments(data, by, value), exact_sum(data, by, value, "sum"), quartiles, median_abs_dev(data, by, value)]
    joined = reduce(lambda a, b: a.join(b, by), parts)
    mean = F.col("sum") / F.col("n")
    return joined.select(
        *by,
        "sum",
        "min",
        "max",
        mean.alias("mean"),
        "median",
        "var",
        "std_dev",
        percent_of(F.col("std_dev"), mean).alias("std_dev_pct"),
        "median_abs_dev",
        "median_abs_dev_pct",
        F.struct("q1", "q2", "q3").alias("quartiles"),
        (F.col("q3") - F.col("q1")).alias("iqr"),
    )


def winsorize(df: DataFrame, by: list[str], value: str, pct: float) -> DataFrame:
    """``df`` with ``value`` pulled in to the percentiles ``pct`` and ``100 - pct`` of its group."""
    limits = exact_quantiles(df, by, value, {"_lo": pct / 100, "_hi": 1 - pct / 100})
    x = F.col(value)
    pulled = F.when(x > F.col("_hi"), F.col("_hi")).when(x < F.col("_lo"), F.col("_lo")).otherwise(x)
    return df.join(limits, by).withColumn(value, pulled).drop("_lo", "_hi")
