"""Links at a large distance where one bucket holds thousands of fingerprints."""

import numpy as np
import pytest

pytest.importorskip("riftspan.llm")

from pyspark.sql import functions as F  # noqa: E402

from riftspan.llm import simhash  # noqa: E402
from riftspan.llm.common import stored  # noqa: E402
from riftspan.operators.components import connected_components  # noqa: E402


def classes(spark, values, **options):
    distinct = stored(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint"))
    nodes = connected_components(simhash.links(distinct, 11, **options))
    named = distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("c")).collect()
    groups = {}
    for r in named:
        groups.setdefault(r["c"], set()).add(r["fp"] & (1 << 64) - 1)
    return {frozenset(g) for g in groups.values()}


def brute(values, distance=11):
    label = np.arange(len(values))
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values) <= distance)
    label = simhash.forest(label, a, b)
    return {frozenset(values[label == c].tolist()) for c in np.unique(label)}


def flipped(rng, base, n, bits):
    flips = np.zeros(n, np.uint64)
    for _ in range(bits):
        flips |= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    return np.unique(base ^ flips)


def test_all_values_of_eleven_bits(spark):
    assert classes(spark, np.arange(2048, dtype=np.uint64)) == {frozenset(range(2048))}


def test_twenty_thousand_near_copies(spark):
    values = flipped(np.random.default_rng(1), np.uint64(0x0123456789ABCDEF), 20_500, 4)
    assert len(values) > 20_000
    assert classes(spark, values) == {frozenset(values.tolist())}


@pytest.mark.parametrize("bucket", [10, 60])
def test_links_beyond_the_centre_equal_brute_force(spark, bucket):
    rng = np.random.default_rng(bucket)
    groups = []
    base = np.uint64(0xF0F0123400000000)
    for step in range(4):  # chains of groups, so that few are near the centre of their bucket
        groups.append(flipped(rng, base, 120, 5))
        base ^= np.uint64(0x1F) << np.uint64(9 * step)
    groups.append(rng.integers(0, 2**63, 150, dtype=np.uint64))
    values = np.unique(np.concatenate(groups))
    expected = brute(values)
    assert len(expected) > 20 and classes(spark, values, bucket=bucket) == expected


def broadcast_columns(plan):
    """Names of the columns on the broadcast side of each broadcast join of a plan."""
    children = [plan.children().apply(i) for i in range(plan.children().length())]
    found = [names for child in children for names in broadcast_columns(child)]
    if plan.nodeName().startswith("Broadcast") and plan.nodeName().endswith("HashJoin"):
        output = children[plan.buildSide().toString() == "BuildRight"].output()
        found.append({output.apply(i).name() for i in range(output.length())})
    return found


@pytest.mark.parametrize("bucket", [20, 1_000])
def test_fingerprints_are_never_broadcast_by_bucket(spark, monkeypatch, bucket):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 2**63, 3_000, dtype=np.uint64), flipped(rng, np.uint64(0x0123456789ABCDEF), 300, 9)])
    distinct = stored(spark.createDataFrame([(int(v),) for v in np.unique(values).view(np.int64)], "fp bigint"))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) >= 1 << 20
    planned = []

    def seen(df):
        planned.append(df._jdf.queryExecution().sparkPlan())
        return stored(df)

    monkeypatch.setattr(simhash, "stored", seen)
    seen(simhash.links(distinct, 11, bucket))
    assert planned and not [names for plan in planned for names in broadcast_columns(plan) if "fp" in names]
