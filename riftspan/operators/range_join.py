"""Overlap join of two interval tables by genomic bins.

Spark turns an overlap condition with only a contig key into a join that is quadratic per contig.
Here both sides are laid out on bins of fixed width, so the join is an equi-join on (contig, bin).
A pair that shares several bins is kept only in the first of them, which makes it appear once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riftspan.functions.interval import int_div
from riftspan.session import reliable_checkpoint

#: Pairs of one bin that one task may have to look at.
PAIRS_PER_TASK = 20_000_000


def with_bins(df: DataFrame, start: str, end: str, width: int, name: str = "_bin") -> DataFrame:
    """One row per bin that the half-open interval touches; empty intervals get none."""
    first = int_div(F.col(start), width)
    last = int_div(F.col(end) - 1, width)
    return df.filter(F.col(end) > F.col(start)).withColumn(name, F.explode(F.sequence(first, last)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """All pairs with equal ``on`` columns whose half-open spans overlap, each pair once.

    Apart from ``on``, the two tables must not share column names. Choose ``width`` near the usual
    interval length: an interval of length ``L`` is laid out on about ``L / width + 1`` bins. Copies of
    intervals should be made distinct before.

    The work of a bin is the product of its rows on both sides, which adaptive execution does not see. A bin with more than
    ``pairs_per_task`` pairs is dealt over several tasks: each left row goes to one of them, the right rows to all.
    """
    ls, le = left_span
    rs, re = right_span
    first_shared = int_div(F.greatest(F.col(ls), F.col(rs)), width)
    overlapping = (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le)) & (first_shared == F.col("_bin"))
    # Laying out intervals multiplies rows in a way the planner does not foresee, so that it would
    # take either side for small and broadcast it.
    keys = [*on, "_bin"]
    binned_left, binned_right = with_bins(left, ls, le, width), with_bins(right, rs, re, width)
    counts = binned_left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl")).join(
        binned_right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr")), keys
    )
    parts = F.least(F.ceil(F.col("_nl") * F.col("_nr") / F.lit(pairs_per_task)), F.col("_nl")).cast("int")
    hot = reliable_checkpoint(counts.filter(F.col("_nl") * F.col("_nr") > pairs_per_task).select(*keys, parts.alias("_parts")))
    if hot.isEmpty():
        pairs = binned_left.hint("merge").join(binned_right, keys)
    else:
        split = F.coalesce("_parts", F.lit(1))
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns if not isinstance(left.schema[c].dataType, T.MapType)]), split)
        dealt = binned_left.join(hot, keys, "left").withColumn("_part", spread.cast("int")).drop("_parts")
        copied = binned_right.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), split - 1))).drop("_parts")
        pairs = dealt.hint("merge").join(copied, [*keys, "_part"]).drop("_part")
    return pairs.filter(overlapping).drop("_bin")
