"""Operators against brute force on random data, with heavy keys and copies."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftspan.functions.interval import int_div
from riftspan.operators import components as cc
from riftspan.operators.blocked import drop_blocked, region_index
from riftspan.operators.ordered import consecutive_runs, global_row_number, running_total
from riftspan.operators.prefix import count_overlaps
from riftspan.operators.quantiles import exact_quantiles, exact_sum, integer_median, order_key
from riftspan.operators.range_join import overlap_join
from riftspan.operators.similar_intervals import cluster_similar, with_prefixes
from riftspan.operators.skew import salted_join
from riftspan.operators.statistics import summary, winsorize
from riftspan.operators import windows
from riftspan.operators.windows import depth_by_window, window_spine


def intervals(rng, n, hot_share=0.35, span=3000, longest=80):
    rows = []
    for i in range(n):
        if rng.random() < hot_share:
            rows.append((i, "a", 500, 560))  # copies of one interval
        else:
            start = rng.randrange(-20, span)
            rows.append((i, rng.choice("ab"), start, start + rng.randrange(0, longest)))
    return rows


def overlap(a, b):
    return a[1] == b[1] and a[2] < b[3] and b[2] < a[3] and a[2] < a[3] and b[2] < b[3]


@pytest.mark.parametrize("pairs_per_task", [20_000_000, 5])
@pytest.mark.parametrize("width", [7, 64, 1000])
def test_overlap_join_equals_theta_join(spark, width, pairs_per_task):
    rng = random.Random(width)
    left, right = intervals(rng, 150), intervals(rng, 120)
    a = spark.createDataFrame(left, "i int, c string, s bigint, e bigint")
    b = spark.createDataFrame(right, "j int, c string, t bigint, f bigint")
    pairs = [(r["i"], r["j"]) for r in overlap_join(a, b, ["c"], ("s", "e"), ("t", "f"), width, pairs_per_task).collect()]
    assert sorted(pairs) == sorted((x[0], y[0]) for x in left for y in right if overlap(x, y))


def test_a_bin_with_half_of_all_rows_is_shared_by_tasks(spark):
    rows = [(i, "a", 100 + i % 7, 120 + i) for i in range(400)] + [(400 + i, "a", 1_000 * i, 1_000 * i + 5) for i in range(1, 400)]
    a = spark.createDataFrame(rows, "i int, c string, s bigint, e bigint")
    b = spark.createDataFrame([(i, "a", 110, 130) for i in range(50)], "j int, c string, t bigint, f bigint").distinct()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        found = overlap_join(a, b, ["c"], ("s", "e"), ("t", "f"), 1_000, pairs_per_task=1_000)
        per_task = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(per_task) == 400 * 50
    assert len(per_task) >= 4 and max(per_task) < 0.6 * sum(per_task)


def test_overlap_counts_equal_theta_join(spark):
    rng = random.Random(1)
    left = [x for x in intervals(rng, 150) if x[2] < x[3]]
    right = intervals(rng, 200)
    a = spark.createDataFrame(left, "i int, c string, s bigint, e bigint")
    b = spark.createDataFrame(right, "j int, c string, t bigint, f bigint")
    got = {r["i"]: r["n_overlaps"] for r in count_overlaps(a, ["i"], "c", (F.col("s"), F.col("e")), b, ("t", "f"), width=64).collect()}
    assert got == {x[0]: sum(overlap(x, y) for y in right) for x in left}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_drop_blocked(spark, threshold):
    rng = random.Random(2)
    rows = [*intervals(rng, 200, longest=400), (900, "a", 515, 515), (901, "a", 510, 510), (902, "b", 0, 1 << 30), (903, "a", 700, 701), (904, "c", 5, 9)]
    regions = [("a", 510, 520), ("b", 100, 300), ("b", 250, 260), ("a", 2000, 2900), ("a", 700, 700), ("c", 7, 7), ("a", 0, 3)]
    a = spark.createDataFrame(rows, "i int, contig string, s bigint, e bigint")
    b = spark.createDataFrame(regions, "contig string, start bigint, end bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        kept = drop_blocked(a, [(F.col("contig"), F.col("s"), F.col("e"))], b, width=50).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["i"] for r in kept) == sorted(
        x[0] for x in rows if not any(x[1] == c and x[2] < e and s < x[3] for c, s, e in regions)
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(3)
    heavy = spark.createDataFrame([(i, 0 if i % 3 else rng.randrange(20)) for i in range(600)], "i int, k int")
    light = spark.createDataFrame([(k, k * 10) for k in range(0, 20, 2)], "k int, v int")
    expected = heavy.join(light, "k", how).collect()
    got = salted_join(heavy, light, ["k"], ["i"], how, rows_per_salt=50)
    assert sorted(map(str, got.select(*heavy.join(light, "k", how).columns).collect())) == sorted(map(str, expected))


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("limit,nodes", [(1_000_000, 1_000_000), (0, 1_000_000), (1_000_000, 3), (10, 3), (3, 10), (0, 3)])
def test_connected_components(spark, limit, nodes):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1080)]
    hub = [(2000, 2001 + i) for i in range(100)]
    scattered = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges = [e for e in chain + hub + scattered if e[0] != e[1]]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(6)
    rows = cc.connected_components(df, single_task_edges=limit, nodes_in_memory=nodes).collect()
    got = {r["node"]: r["component"] for r in rows}
    assert len(rows) == len(got)
    assert got == brute_components(edges)


def test_contraction_in_small_memory():
    import pandas as pd

    edges = [(i, i + 1) for i in range(50)]
    batches = [pd.DataFrame(edges[i : i + 5], columns=["a", "b"]) for i in range(0, 50, 5)]
    stars = [tuple(r) for part in cc.contracting(3)(iter(batches)) for r in part.itertuples(index=False)]
    assert brute_components(stars) == brute_components(edges)


def similar(x, y, overlap_share, shift):
    shared = max(min(x[3], y[3]) - max(x[2], y[2]), 0)
    longest = max(x[3] - x[2], y[3] - y[2])
    if np.float32(shared / longest) < np.float32(overlap_share):
        return False
    return shift is None or (abs(x[2] - y[2]) <= shift and abs(x[3] - y[3]) <= shift)


@pytest.mark.parametrize("share,shift", [(0.5, None), (0.8, None), (0.1, 30), (0.0, 12), (0.9, 5)])
@pytest.mark.parametrize("compared", [4_096, 0])
def test_clusters_equal_pairwise_linkage(spark, share, shift, compared):
    rng = random.Random(5)
    rows = [x for x in intervals(rng, 260, hot_share=0.3, span=1500, longest=300) if x[2] < x[3]]
    df = spark.createDataFrame(rows, "i bigint, c string, s bigint, e bigint")
    got = {r["i"]: r["cluster"] for r in cluster_similar(df, "i", ["c"], ("s", "e"), share, shift, compared=compared).collect()}
    edges = [
        (x[0], y[0]) for x in rows for y in rows
        if x[1] == y[1] and similar(x, y, share, shift) and (share > 0 or (x[2] - shift < y[3] and y[2] - shift < x[3]))
    ]
    assert got == brute_components(edges)


@pytest.mark.parametrize("least", [0.5, 0.7, 1.0, 0.01, 0.0])
def test_clusters_of_similar_sets_equal_pairwise_linkage(spark, least):
    rng = random.Random(9)
    names = [f"s{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    rows = []
    for i, c, s, e in intervals(rng, 200, hot_share=0.4, span=600, longest=200):
        own = rng.choice([None, [], sorted(set(rng.choices(names, weights, k=rng.randrange(1, 20))))])
        rows.append((i, c, s, max(e, s + 1), own * rng.choice([1, 2]) if own else own))
    df = spark.createDataFrame(rows, "i bigint, c string, s bigint, e bigint, names array<string>")
    found = cluster_similar(df, "i", ["c"], ("s", "e"), 0.6, None, "names", least).collect()

    def enough(a, b):
        a, b = set(a or ()), set(b or ())
        larger = max(len(a), len(b))
        return not larger or np.float32(len(a & b) / larger) >= np.float32(least)

    edges = [(x[0], y[0]) for x in rows for y in rows if x[1] == y[1] and similar(x, y, 0.6, None) and enough(x[4], y[4])]
    assert {r["i"]: r["cluster"] for r in found} == brute_components(edges)


def test_sets_meet_by_their_rarest_elements(spark):
    rng = random.Random(4)
    sets = {tuple(sorted(rng.sample(range(40), rng.randrange(0, 12)))) for _ in range(300)}
    for least in (0.3, 0.5, 0.9):
        df = spark.createDataFrame([(list(s),) for s in sets], "_set array<int>")
        prefix = {tuple(r["_set"]): {p["_element"] for p in r["_prefix"]} for r in with_prefixes(df, least).collect()}
        assert prefix.keys() == sets
        for a in sets:
            for b in sets:
                if a and b and len(set(a) & set(b)) >= least * max(len(a), len(b)):
                    assert prefix[a] & prefix[b]
        assert sum(map(len, prefix.values())) < sum(map(len, sets)) or least < 0.5


def test_runs_and_totals_over_blocks(spark):
    rng = random.Random(6)
    values = [rng.choice("xy") for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("b", int_div(F.col("i"), 7))
    got = {r["i"]: (r["run_id"], r["n"]) for r in running_total(
        consecutive_runs(df, "v", ["b"], ["i"]).withColumn("one", F.lit(1)), "one", ["b"], ["i"], "n").collect()}
    run, expected = 0, {}
    for i, v in enumerate(values):
        run += i > 0 and v != values[i - 1]
        expected[i] = (run, i)
    assert got == expected


def test_global_row_number(spark):
    rng = random.Random(7)
    rows = [(i, 5 if rng.random() < 0.4 else rng.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, k int").repartition(5)
    got = {r["i"]: r["n"] for r in global_row_number(df, ["k", "i"], "n").collect()}
    assert got == {i: n for n, (k, i) in enumerate(sorted((k, i) for i, k in rows), 1)}


def test_quantiles_and_sums(spark):
    rng = random.Random(8)
    groups = {
        "wide": [rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 9) for _ in range(501)],
        "ties": [float(rng.randrange(5)) for _ in range(400)],
        "powers": [s * 2.0**k for k in range(-30, 30) for s in (1, -1)] + [0.0],
        "one": [3.5],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for r in exact_quantiles(df, ["g"], "v", probs).collect():
        for name, p in probs.items():
            assert r[name] == pytest.approx(float(np.quantile(groups[r["g"]], p)), rel=1e-12, abs=1e-300)
    for r in exact_sum(df, ["g"], "v", "s").collect():
        assert r["s"] == math.fsum(groups[r["g"]])
    keys = df.select("v", order_key(F.col("v")).alias("k")).collect()
    in_order = sorted(keys, key=lambda r: r["v"])
    assert all(a["k"] <= b["k"] for a, b in zip(in_order, in_order[1:]))


def test_exact_sum_beats_plain_addition(spark):
    values = [0.5, 3.2321, 1.5678, 1e30, 1.2, -1e30, 0.1, 1e-300]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    assert exact_sum(df, ["g"], "v", "s").first()["s"] == math.fsum(values)


def test_integer_median_cuts_fractions(spark):
    groups = {1: [5], 2: [1, 4], 3: [7, 7, 9, 2], 4: [-3, -2], 5: [10, 3, 8]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v bigint")
    got = {r["g"]: r["m"] for r in integer_median(df, ["g"], "v", "m").collect()}
    assert got == {1: 5, 2: 2, 3: 7, 4: -2, 5: 8}


VECTORS = [
    ([958, 924], dict(sum=1882, mean=941, median=941, var=578, std_dev=24.0416305603, std_dev_pct=2.5549022912,
                      median_abs_dev=25.2042, median_abs_dev_pct=2.6784484591, q1=932.5, q3=949.5, iqr=17)),
    ([505, 497, 1591, 887, 1026, 136, 1580, 940, 754, 1433],
     dict(sum=9349, mean=934.9, median=913.5, var=239208.9888888889, std_dev=489.0899599142, std_dev_pct=52.3146817750,
          median_abs_dev=611.5725, median_abs_dev_pct=66.9482758621, q1=567.25, q3=1331.25, iqr=764)),
]


@pytest.mark.parametrize("values,expected", VECTORS)
def test_summary(spark, values, expected):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    row = summary(df, ["g"], "v").select("*", "quartiles.*").first()
    assert (row["min"], row["max"]) == (min(values), max(values))
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=1e-6), name


def test_summary_of_single_and_nan_values(spark):
    df = spark.createDataFrame([("one", 4.0), *[("nan", v) for v in (1.0, 2.0, float("nan"), 3.0, 4.0)]], "g string, v double")
    rows = {r["g"]: r for r in summary(df, ["g"], "v").collect()}
    assert rows["one"]["var"] == 0.0 and rows["one"]["median"] == 4.0
    assert (rows["nan"]["min"], rows["nan"]["max"]) == (1.0, 4.0)


def test_winsorize(spark):
    values = [float(v) for v in range(100)]
    df = spark.createDataFrame([(i, "g", v) for i, v in enumerate(values)], "i int, g string, v double")
    got = sorted(r["v"] for r in winsorize(df, ["g"], "v", 10.0).collect())
    lo, hi = np.quantile(values, 0.1), np.quantile(values, 0.9)
    assert got == pytest.approx(sorted(np.clip(values, lo, hi)))


def test_depth_equals_count_per_base(spark):
    rng = random.Random(9)
    rows = [(c, s, e, rng.randrange(61)) for _, c, s, e in intervals(rng, 200, span=900) if 0 <= s < e]
    df = spark.createDataFrame(rows, "contig string, start bigint, end bigint, mapq int")
    depth, quality = defaultdict(int), defaultdict(int)
    for c, s, e, q in rows:
        for p in range(s, e):
            depth[c, p] += 1
            quality[c, p] += q
    expected = defaultdict(lambda: [0, 0, 0])
    for (c, p), d in depth.items():
        cell = expected[c, p // 50]
        cell[0] += d
        cell[1] += d * d
        cell[2] += quality[c, p]
    got = {(r["contig"], r["window_id"]): [r["depth_sum"], r["depth_sq_sum"], r["mapq_sum"]] for r in depth_by_window(df, ["contig"], 50).collect()}
    assert got == dict(expected)


def test_spine_covers_contigs(spark, monkeypatch):
    monkeypatch.setattr("riftspan.operators.windows.SPINE_CHUNK", 4)
    df = spark.createDataFrame([("a", 1000), ("b", 950), ("c", 1), ("d", 0)], "contig string, length bigint")
    got = sorted((r["contig"], r["window_id"]) for r in window_spine(df, ["contig"], "length", 100).collect())
    assert got == [("a", i) for i in range(10)] + [("b", i) for i in range(10)] + [("c", 0)]


def test_blocked_regions_of_any_length_and_depth(spark):
    rng = random.Random(8)
    regions = [(rng.choice("ab"), s, s + rng.choice([0, 1, 5, 60, 900])) for s in (rng.randrange(-5, 3000) for _ in range(60))]
    rows = [(i, rng.choice(["a", "b", "c", None]), s, s + rng.choice([0, 1, 3, 40, 2500])) for i, s in enumerate(rng.randrange(-60, 5000) for _ in range(900))]
    rows += [(1000, "a", None, 5), (1001, "a", 5, None)]
    a = spark.createDataFrame(rows, "i int, contig string, s bigint, e bigint")
    b = spark.createDataFrame([*regions, ("a", 9, 3), (None, 1, 2)], "contig string, start bigint, end bigint")
    kept = drop_blocked(a, [(F.col("contig"), F.col("s"), F.col("e"))], b, width=64)
    expected = [i for i, c, s, e in rows if None in (s, e) or not any(c == g and s < f and t < e for g, t, f in regions)]
    assert sorted(r["i"] for r in kept.collect()) == expected
    assert drop_blocked(a, [(F.col("contig"), F.col("s"), F.col("e"))], b.limit(0)).count() == len(rows)


def test_index_of_regions_does_not_grow_with_their_length(spark):
    def rows(longest):
        nested = [("a", i * 10, i * 10 + longest) for i in range(500)]
        b = spark.createDataFrame([*nested, ("a", 1_000_000, 1_000_001)], "contig string, start bigint, end bigint")
        return region_index(b, 100).count()

    assert rows(1) == rows(900_000) == 10_001


def test_rows_of_depth_do_not_grow_with_the_length_of_reads(spark):
    def widest(length):
        reads = spark.range(2_000).selectExpr("'a' as contig", "id * 50 as start", f"id * 50 + {length} as end", "cast(30 as int) as mapq")
        found = depth_by_window(reads, ["contig"], 100)
        depth = {r["window_id"]: r["depth_sum"] for r in found.collect()}
        span = range(max(depth) + 1)
        expected = [sum(max(0, min(100 * w + 100, 50 * i + length) - max(100 * w, 50 * i)) for i in range(2_000)) for w in (*span[:3], *span[-3:])]
        assert [depth.get(w, 0) for w in (*span[:3], *span[-3:])] == expected
        plan = found._jdf.queryExecution().executedPlan()
        text = plan.toString()
        return text.count("Exchange hashpartitioning"), text.count("Generate explode")

    assert widest(90) == widest(60_000)


@pytest.mark.parametrize("chunk", [1, 3, 8192])
def test_depth_is_carried_over_windows_and_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(windows, "SPINE_CHUNK", chunk)
    rng = random.Random(chunk)
    reads = [(rng.choice("ab"), s, s + rng.choice([0, 1, 9, 10, 30, 400]), rng.randrange(60)) for s in (rng.randrange(0, 700) for _ in range(60))]
    reads += [(None, 1, 5, 3), ("c", 100_000, 100_005, 1), ("c", 0, 20, 1)]
    df = spark.createDataFrame(reads, "contig string, start bigint, end bigint, mapq int")
    got = {(r["contig"], r["window_id"]): (r["depth_sum"], r["depth_sq_sum"], r["mapq_sum"]) for r in depth_by_window(df, ["contig"], 10).collect()}
    depth, quality = defaultdict(int), defaultdict(int)
    for c, s, e, q in reads:
        for p in range(s, e) if c else ():
            depth[c, p] += 1
            quality[c, p] += q
    expected = defaultdict(lambda: (0, 0, 0))
    for (c, p), d in depth.items():
        a, b, m = expected[c, p // 10]
        expected[c, p // 10] = (a + d, b + d * d, m + quality[c, p])
    assert got == expected


def test_pairs_of_tiles_are_sought_from_one_side(spark, monkeypatch):
    from riftspan.operators import similar_intervals

    laid_out, joined = [], similar_intervals.salted_join

    def counted(heavy, light, *args, **kwargs):
        if "_other" in light.columns:
            laid_out.append(light.count())
        return joined(heavy, light, *args, **kwargs)

    monkeypatch.setattr(similar_intervals, "salted_join", counted)
    rows = spark.range(100).selectExpr("id", "'a' as contig", "id * 150 as s", "id * 150 + 200 + id % 2 * 200 as e")
    clusters = cluster_similar(rows, "id", ["contig"], ("s", "e"), 0.5, None)
    assert clusters.count() == 100 and laid_out[0] <= 600


@pytest.mark.parametrize("crowd", [0, 12, 512])
@pytest.mark.parametrize("share,shift", [(0.4, None), (0.0, 15)])
def test_similar_sets_in_crowded_places_equal_pairwise_linkage(spark, monkeypatch, crowd, share, shift):
    from riftspan.operators import similar_intervals

    monkeypatch.setattr(similar_intervals, "CROWD", crowd)
    rng = random.Random(crowd)
    rows = []
    for i, c, s, e in intervals(rng, 200, hot_share=0.3, span=4000, longest=300):
        s, e = s - 1000, max(e, s + 1) - 1000  # on both sides of zero
        rows.append((i, rng.choice([c, c, None]), s, e, sorted(rng.sample("abcdefghij", rng.randrange(6)))))
    df = spark.createDataFrame(rows, "i bigint, c string, s bigint, e bigint, names array<string>")
    found = cluster_similar(df, "i", ["c"], ("s", "e"), share, shift, "names", 0.5).collect()

    def linked(x, y):
        a, b = set(x[4]), set(y[4])
        near = x[1] is not None and x[1] == y[1] and similar(x, y, share, shift)
        return near and (not (a or b) or len(a & b) / max(len(a), len(b)) >= 0.5)

    expected = brute_components([(x[0], y[0]) for x in rows for y in rows if linked(x, y)])
    assert {r["i"]: r["cluster"] for r in found} == {**{x[0]: x[0] for x in rows}, **expected}


def test_sets_where_tiles_are_few_are_laid_out_once_a_place(spark, monkeypatch):
    from riftspan.operators import similar_intervals

    laid_out, joined = [], similar_intervals.salted_join

    def counted(heavy, light, *args, **kwargs):
        if "_other" in light.columns:
            laid_out.append(heavy.count() + light.count())
        return joined(heavy, light, *args, **kwargs)

    monkeypatch.setattr(similar_intervals, "salted_join", counted)
    rows = spark.range(100).selectExpr("id", "'a' as contig", "id * 150 as s", "id * 150 + 200 as e", "transform(sequence(0, 9), k -> (k + id) % 40) as names")
    clusters = cluster_similar(rows, "id", ["contig"], ("s", "e"), 0.5, None, "names", 0.5)
    assert clusters.count() == 100 and laid_out[0] <= 400
