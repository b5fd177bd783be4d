"""Mates found with the help of a filter, against plain membership."""

import random

import pytest
from pyspark.sql import functions as F

from riftspan.plans import scan


@pytest.mark.parametrize("few,most,bits", [(0, 10**9, 26), (0, 10**9, 10), (0, 0, 26), (10**9, 10**9, 26)])
def test_mates_equal_membership(spark, monkeypatch, few, most, bits):
    monkeypatch.setattr(scan, "FEW_NAMES", few)
    monkeypatch.setattr(scan, "MOST_NAMES", most)
    monkeypatch.setattr(scan, "FILTER_BITS", bits)
    rng = random.Random(bits)
    rows = [(i, rng.choice([None, "hot", *[f"n{k}" for k in range(900)]]), rng.random() < 0.2) for i in range(2_000)]
    df = spark.createDataFrame(rows, "i int, qname string, good boolean")
    names = {q for _, q, good in rows if good and q is not None}
    got = sorted(r["i"] for r in scan.with_mates(df, F.col("good")).collect())
    assert got == [i for i, q, _ in rows if q in names]
    assert scan.with_mates(df, F.lit(False)).count() == 0


def test_filter_passes_little_more_than_is_kept(spark):
    df = spark.range(200_000).select(F.concat(F.lit("t"), F.col("id") % 100_000).alias("qname"))
    names = spark.range(3_000).select(F.concat(F.lit("t"), F.col("id") * 33).alias("qname"))
    passed = scan.might_have_name(df, names, 3_000)
    assert 6_000 <= passed.count() <= 6_000 + 194_000 / 7
    assert "SortMergeJoin" not in passed._jdf.queryExecution().executedPlan().toString()
