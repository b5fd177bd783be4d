"""Medians over ranges against a plain listing of the overlapping items."""

import math
import random
import statistics

import numpy as np
import pytest

from riftspan.operators import range_quantile
from riftspan.operators.range_quantile import overlap_medians, ranked_difference


def test_ranks_in_a_difference_of_sequences():
    rng = np.random.default_rng(1)
    start = rng.integers(0, 50, 300)
    end = start + rng.integers(1, 20, 300)
    code = rng.integers(0, 37, 300)
    by_start, by_end = code[np.argsort(start, kind="stable")], code[np.argsort(end, kind="stable")]
    lo, hi = np.array([0, 3, 10, 30, 49]), np.array([70, 4, 40, 31, 50])
    started, ended = (start[:, None] < hi).sum(0), (end[:, None] <= lo).sum(0)
    for part in (0.0, 0.3, 0.999):
        rank = ((started - ended) * part).astype(np.int64)
        own = [sorted(code[(start < h) & (end > l)])[r] for l, h, r in zip(lo, hi, rank)]
        assert ranked_difference(by_start, by_end, started, ended, rank).tolist() == own


def some_items(rng, n, span):
    items = []
    for _ in range(n):
        s = rng.randrange(-20, span)
        value = rng.choice([None, 0.0, -0.0, 1.5, float("nan"), rng.gauss(0, 1e3), rng.gauss(0, 1e-9)])
        for series in rng.choice([["all"], ["all", "good"]]):
            items.append((rng.choice(["a", "a", "b"]), series, s, s + rng.choice([0, 1, 7, 36, 400]), value))
    return items


def listed(ranges, items):
    out = {}
    for g, lo, hi in ranges:
        for series in ("all", "good"):
            own = [i for i in items if i[0] == g and i[1] == series and i[2] < i[3] and lo < hi and i[2] < hi and i[3] > lo]
            values = sorted((v for *_, v in own if v is not None), key=lambda v: (math.isnan(v), v))
            if own:
                k = len(values)
                low, high = (values[(k - 1) // 2], values[k // 2]) if k else (None, None)
                out[g, lo, hi, series] = (len(own), low if low == high else 0.5 * low + 0.5 * high)
    return out


@pytest.mark.parametrize("reach,most", [(64, 10**6), (64, 3), (100_000, 10**6), (1, 10**6)])
def test_medians_equal_a_listing(spark, monkeypatch, reach, most):
    monkeypatch.setattr(range_quantile, "RANGES_PER_TASK", most)
    rng = random.Random(reach)
    items = some_items(rng, 500, 2000)
    ranges = list({(rng.choice("aabc"), s, s + rng.choice([0, 1, 10, 64, 65, 900, 5000])) for s in (rng.randrange(-50, 2500) for _ in range(150))})
    a = spark.createDataFrame(ranges, "contig string, lo bigint, hi bigint")
    b = spark.createDataFrame(items, "contig string, series string, start bigint, end bigint, value double")
    got = {(r["contig"], r["lo"], r["hi"], r["series"]): (r["n"], r["median"]) for r in overlap_medians(a, b, "contig", reach).collect()}
    expected = listed(ranges, items)
    assert got.keys() == expected.keys()
    for key, (n, median) in expected.items():
        assert got[key][0] == n
        assert got[key][1] == median or (median is not None and math.isnan(median) and math.isnan(got[key][1]))
    assert overlap_medians(a.limit(0), b, "contig", reach).collect() == [] and overlap_medians(a, b.limit(0), "contig", reach).collect() == []


def test_rows_moved_do_not_grow_with_the_length_of_ranges(spark, monkeypatch):
    seen = []
    kept = range_quantile.reliable_checkpoint
    monkeypatch.setattr(range_quantile, "reliable_checkpoint", lambda df: seen.append(kept(df)) or seen[-1])
    items = spark.range(20_000).selectExpr("'a' as contig", "'all' as series", "id * 10 as start", "id * 10 + 10 as end", "cast(id * 7919 % 1000 as double) as value")

    def rows(length):
        seen.clear()
        ranges = spark.range(50).selectExpr("'a' as contig", "id * 10 as lo", f"id * 10 + {length} as hi")
        (median,) = {r["median"] for r in overlap_medians(ranges, items, "contig", 100).filter("lo = 0").collect()}
        own = [i * 7919 % 1000 for i in range(length // 10)]
        assert median == statistics.median(own)
        return [t.count() for t in seen]

    short, long = rows(1_000), rows(100_000)
    assert len(short) == len(long) and all(b <= 2 * a for a, b in zip(short, long))


def test_ranges_of_a_few_blocks_need_no_rounds(spark, monkeypatch):
    rng = random.Random(3)
    items = [i for i in some_items(rng, 400, 2000) if i[4] is not None]
    ranges = list({("a", s, s + rng.choice([60, 65, 300, 512])) for s in (rng.randrange(0, 2000) for _ in range(80))})
    a = spark.createDataFrame(ranges, "contig string, lo bigint, hi bigint")
    b = spark.createDataFrame(items, "contig string, series string, start bigint, end bigint, value double")
    expected = {k: n for k, (n, _) in listed(ranges, items).items()}

    def counts():
        return {(r["contig"], r["lo"], r["hi"], r["series"]): r["n"] for r in overlap_medians(a, b, "contig", 64).collect()}

    rounds, in_rounds = range_quantile._long, []
    monkeypatch.setattr(range_quantile, "_long", lambda ranges, items: in_rounds.append(ranges.count()) or rounds(ranges, items))
    assert counts() == expected and in_rounds == []
    monkeypatch.setattr(range_quantile, "ITEMS_PER_BLOCK", 40)  # now some blocks hold too much for a task
    assert counts() == expected and 0 < in_rounds[0] < len(ranges)
