"""Joins that stay balanced when one key holds a large share of the rows.

Spark's adaptive execution splits heavy join partitions by itself, and most joins here leave it to
that. Explicit salting is used where the row counts per key are known anyway.

Salting only routes rows; it never drops or caps any. A key is heavy from a row count that at most
``MAX_HOT_KEYS`` keys can reach, which bounds what is broadcast: any other key holds less than
``1 / MAX_HOT_KEYS`` of the rows, so it cannot dominate a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows one join task should get from a single key before the key is split.
ROWS_PER_SALT = 500_000
#: Upper bound of the broadcast list of heavy keys.
MAX_HOT_KEYS = 100_000


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Keys whose row count ``n`` calls for splitting, with the number of parts ``_parts``."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).scalar()
    least = F.greatest(F.lit(rows_per_salt).cast("long"), F.call_function("div", total, F.lit(MAX_HOT_KEYS)))
    return (
        counts.filter(F.col(n) > least)
        .select(*keys, F.expr(f"cast({n} div {rows_per_salt} + 1 as int)").alias("_parts"))
    )


def salted_join(
    heavy: DataFrame,
    light: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    residual: Column | None = None,
    counts: DataFrame | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Equi-join on ``keys`` with an optional residual condition, splitting heavy keys of ``heavy``.

    ``spread_by`` names columns of ``heavy`` that together tell its rows apart; they decide the
    part a row goes to, so a retried task sends every row to the same place. ``counts`` may give the
    row counts per key (``keys`` and ``_n``) if they are known already. ``how`` may be ``inner``,
    ``left``, ``left_semi`` or ``left_anti``. Columns of ``light`` other than the keys must have
    names of their own.
    """
    if counts is None:
        counts = heavy.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(counts, keys, "_n", rows_per_salt)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = (
        heavy.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
        .drop("_parts")
    )
    right = (
        light.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    on = [*keys, "_salt"]
    if residual is None:
        return left.join(right, on, how).drop("_salt")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = residual
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    joined = left.join(renamed, condition, how)
    return joined.drop("_salt", *[f"_r_{c}" for c in on])


def dealt_out(df: DataFrame, *keys: str) -> DataFrame:
    """A source that cannot be split over all cores, spread by ``keys``; any other source as it is.

    A compressed text file or a file with a single row group is read by one task. Unless its rows
    are spread first, that task also does all the work that follows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if 2 * df.rdd.getNumPartitions() <= cores else df
