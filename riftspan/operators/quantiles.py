"""Exact quantiles and sums of groups that may hold any share of the rows.

The built-in exact percentile keeps all distinct values of a group in one task. Here values are
reduced to (value, count), a histogram over order-preserving keys finds the one key each wanted rank
falls into, and only the rows of those keys are ranked. A key spans a relative width of 1/4096.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

_MANTISSA_STEPS = 4096
_EXPONENT_SHIFT = 1100


def _exponent(magnitude: Column) -> Column:
    return F.floor(F.log2(magnitude)).cast("int")


def order_key(value: Column) -> Column:
    """Integer that never decreases as ``value`` grows: sign, binary exponent, leading mantissa bits."""
    x = value.cast("double")
    size = F.abs(x)
    exponent = _exponent(size)
    mantissa = F.floor((size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * _MANTISSA_STEPS).cast("long")
    key = (exponent + _EXPONENT_SHIFT).cast("long") * (4 * _MANTISSA_STEPS) + mantissa
    return F.when(F.isnan(x), F.lit(2**60)).when(x == 0, F.lit(0).cast("long")).when(x > 0, key).otherwise(-key)


def values_at_ranks(
    df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Column], weight: str | None = None
) -> DataFrame:
    """Per group, the values at zero-based ranks of the sorted non-null values.

    ``ranks`` maps output names to rank expressions over the group size ``_n`` (bigint). The result
    has the columns ``by``, ``_n`` and one column per rank. A row stands for ``weight`` equal values.
    """
    by = list(by)
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    per_value = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(amount.alias("_c"))
        .withColumn("_k", order_key(F.col("_v")))
    )
    histogram = per_value.groupBy(*by, "_k").agg(F.sum("_c").alias("_c"))
    order = W.partitionBy(*by).orderBy("_k")
    total = F.sum("_c").over(W.partitionBy(*by))
    ranked = histogram.select(
        *by,
        "_k",
        total.alias("_n"),
        "_c",
        F.coalesce(F.sum("_c").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    wanted = ranked.withColumn(
        "_w",
        F.filter(
            F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items()]),
            lambda w: (w["rank"] >= F.col("_base")) & (w["rank"] < F.col("_base") + F.col("_c")),
        ),
    ).filter(F.size("_w") > 0)
    inside = per_value.join(wanted.select(*by, "_k", "_n", "_base", "_w"), [*by, "_k"])
    in_key = W.partitionBy(*by, "_k").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    placed = inside.withColumn("_at", F.col("_base") + F.coalesce(F.sum("_c").over(in_key), F.lit(0)))

    def is_at(name: str) -> Column:
        return F.exists(
            "_w",
            lambda w: (w["name"] == name) & (w["rank"] >= F.col("_at")) & (w["rank"] < F.col("_at") + F.col("_c")),
        )

    found = [F.max(F.when(is_at(name), F.col("_v"))).alias(name) for name in ranks]
    if by:
        return placed.groupBy(*by).agg(F.max("_n").alias("_n"), *found)
    return placed.agg(F.max("_n").alias("_n"), *found)


def leading_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """All of the first ``n`` rows by the numeric column ``order``, and not many more.

    A sort with a limit would gather ``n`` rows of every partition in one task. Here a histogram of
    the column tells up to which key rows can be among the first; later ones are filtered away.
    """
    histogram = df.groupBy(order_key(F.col(order)).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(W.orderBy("_k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = histogram.withColumn("_before", before).filter(F.col("_before") < n).agg(F.max("_k")).scalar()
    return df.filter(order_key(F.col(order)) <= cut)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Per group, linearly interpolated quantiles: column name to probability between 0 and 1."""
    ranks: dict[str, Column] = {}
    last = F.col("_n") - 1
    for name, p in probs.items():
        low = F.floor(last * F.lit(float(p))).cast("long")
        ranks[f"_lo_{name}"] = low
        ranks[f"_hi_{name}"] = F.least(low + 1, last)
    at = values_at_ranks(df, by, value, ranks, weight)
    exprs = []
    for name, p in probs.items():
        position = last * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        exprs.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return at.select(*by, *exprs)


def integer_median(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Per group, the middle of sorted whole numbers; of two middle ones the mean without its fraction."""
    at = values_at_ranks(
        df, by, value, {"_lo": F.expr("(_n - 1) div 2"), "_hi": F.expr("_n div 2")}
    )
    return at.select(*by, F.expr("cast((_lo + _hi) div 2 as bigint)").alias(name))


@F.pandas_udf(T.DoubleType())
def _combine(parts: pd.Series) -> pd.Series:
    """Round the exact sum of integer multiples of powers of two once, at the end."""

    def total(entries) -> float:
        exact = sum((Fraction(int(e["m"])) * Fraction(2) ** int(e["e"]) for e in entries), Fraction(0))
        return float(exact)

    return parts.map(total)


def exact_sum(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Per group, the correctly rounded sum of doubles, whatever the order of rows.

    Each value is a whole number times a power of two. The whole numbers are added as decimals per
    power, so partial sums are combined before the shuffle, and the at most 2,100 powers of a group
    are added exactly. Values that are not finite make the result what plain addition gives.
    """
    by = list(by)
    x = F.col(value).cast("double")
    exponent = F.greatest(_exponent(F.abs(x)) - 52, F.lit(-1074))
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    typed = df.select(*by, x.alias("_x"), F.when(odd, x).alias("_odd"), F.when(~odd & (x != 0), exponent).alias("_e"))
    mantissa = F.when(
        F.col("_e").isNotNull(),
        # Two exact steps, since 2^1074 is no double.
        F.col("_x") * F.pow(F.lit(2.0), F.floor(-F.col("_e") / 2).cast("double")) * F.pow(F.lit(2.0), (-F.col("_e") - F.floor(-F.col("_e") / 2)).cast("double")),
    ).otherwise(F.lit(0.0))
    per_power = (
        typed.withColumn("_m", mantissa.cast("decimal(20,0)"))
        .groupBy(*by, "_e")
        .agg(F.sum("_m").alias("_m"), F.sum("_odd").alias("_odd"))
    )
    gathered = per_power.groupBy(*by).agg(
        F.collect_list(F.struct(F.coalesce("_e", F.lit(0)).alias("e"), F.col("_m").cast("string").alias("m"))).alias("_parts"),
        F.sum("_odd").alias("_odd"),
    )
    return gathered.select(*by, F.coalesce(F.col("_odd"), _combine("_parts")).alias(name))
