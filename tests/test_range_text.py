"""Joined texts of ranges against plain joining, and the number of fragments that ranges take."""

import random
import re

import pytest
from pyspark.sql import functions as F

from riftspan.operators import range_text
from riftspan.operators.range_text import joined_in_ranges, pieces, range_pieces, with_joined
from riftspan.plans.annotate import baf_lists


@pytest.mark.parametrize("top", [5, 1, 0])
def test_lists_equal_plain_joining(spark, monkeypatch, top):
    monkeypatch.setattr(range_text, "TOP_LEVEL", top)
    rng = random.Random(top)
    items = [(rng.choice("aab"), rng.choice([7, rng.randrange(-9, 900)]), i, rng.choice([None, f"t{i}", f"t{i}", ""])) for i in range(700)]
    items += [(None, 1, 701, "x"), ("a", None, 702, "x")]
    ranges = list({(rng.choice("abc"), s, s + rng.choice([0, 1, 9, 70, 2000])) for s in (rng.randrange(-20, 900) for _ in range(200))})
    a = spark.createDataFrame(ranges, "contig string, lo bigint, hi bigint")
    b = spark.createDataFrame(items, "contig string, pos bigint, ord int, text string")
    got = {(r["contig"], r["lo"], r["hi"]): r["list"] for r in joined_in_ranges(a, b, "contig", "pos", ["ord"], F.col("text"), "list").collect()}
    expected = {}
    for g, lo, hi in ranges:
        own = sorted((p, o, t) for c, p, o, t in items if c == g and p is not None and lo <= p < hi)
        if own:
            expected[g, lo, hi] = ";".join(t for *_, t in own if t is not None)
    assert got == expected
    assert joined_in_ranges(a, b.limit(0), "contig", "pos", ["ord"], F.col("text"), "list").collect() == []


def test_pieces_make_up_any_stretch(spark):
    rng = random.Random(1)
    stretches = [(a, a + rng.choice([0, 1, 7, 8, 9, 64, 513, 5000])) for a in (rng.randrange(6000) for _ in range(400))]
    rows = spark.createDataFrame(stretches, "a bigint, b bigint").select("a", "b", pieces(F.col("a"), F.col("b"), 3).alias("p")).collect()
    for r in rows:
        numbers = [n for p in r["p"] for n in range(p["_at"], p["_at"] + 8 ** p["_level"])]
        assert sorted(numbers) == list(range(r["a"], r["b"])) and all(p["_at"] == p["_block"] * 8 ** p["_level"] for p in r["p"])


def test_ten_thousand_nested_ranges_take_few_fragments(spark):
    numbered = spark.range(100_000).select(F.lit("a").alias("contig"), (F.col("id") * 3).alias("pos"), F.col("id").alias("_number"))
    ranges = spark.range(10_000).select(F.lit("a").alias("contig"), F.col("id").alias("lo"), (300_000 - F.col("id")).alias("hi"))
    taken = range_pieces(ranges, numbered, "contig", "pos", 5).groupBy("lo").count().agg(F.sum("count"), F.max("count")).first()
    assert taken[1] <= 2 * 7 * 5 + 100_000 // 8**5 and taken[0] <= 10_000 * 60  # listing pairs would be 900 million rows


@pytest.mark.parametrize("bits", [(12, 15), (2, 4), (0, 3)])
def test_rows_of_all_lengths_get_their_lists(spark, monkeypatch, bits):
    monkeypatch.setattr(range_text, "BLOCK_BITS", bits)
    rng = random.Random(3)
    items = [(rng.choice("ab"), rng.randrange(400), i, rng.choice([None, f"t{i}"])) for i in range(300)]
    ranges = [(rng.choice("abc"), s, s + rng.choice([0, 1, 3, 20, 90, 500])) for s in (rng.randrange(-20, 420) for _ in range(120))]
    ranges += ranges[:30] + [(None, 1, 5), ("a", None, 5), ("a", 1, None)]
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "id int, contig string, lo bigint, hi bigint")
    b = spark.createDataFrame(items, "contig string, pos bigint, ord int, text string")
    got = {r["id"]: r["list"] for r in with_joined(a, b, "contig", "pos", ["ord"], F.col("text"), "list").collect()}
    expected = {}
    for i, (g, lo, hi) in enumerate(ranges):
        own = [] if None in (g, lo, hi) else sorted((p, o, t or "") for c, p, o, t in items if c == g and lo <= p < hi)
        expected[i] = ";".join(t for *_, t in own if t) if own else None
    assert got == expected


def test_lists_are_not_shuffled(spark):
    rows = spark.range(60).selectExpr("id AS row_id", "'DUP' AS sv_type", "'a' AS chrom", "id AS pos", "id + 50 AS end2")
    snvs = spark.range(100).selectExpr("'a' AS contig", "id AS pos", "id AS ord", "double(id) / 100 AS baf")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lists = baf_lists(rows, snvs, ["ord"], None)
        plan = lists._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert moved and not any(c.startswith("bafs#") for columns in moved for c in columns.split(", "))
        assert lists.count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
