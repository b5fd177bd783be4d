"""Staged tables: the same rows as the files, with less read."""

import random

import pytest
import samples as s
from pyspark.sql import functions as F

from riftspan import cli, tools
from riftspan.config import Config
from riftspan.errors import OutputExists
from riftspan.plans.library import LibraryProperties
from riftspan.sources.regions import Region, fetch_regions, region_table
from riftspan.sources.staged import is_staged, read_staged, spans, stage, staged_header


def body(path):
    return [x for x in open(path).read().splitlines() if x[0] not in "@#"]


def some_rows(spark, n=4000):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "b", "c"]), p, p + rng.choice([1, 50, 50, 50, 5000])) for i, p in enumerate(rng.randrange(0, 200_000) for _ in range(n))]
    rows += [(n, None, None, None), (n + 1, "b", 7, 190_000)]
    return spark.createDataFrame(rows, "i int, contig string, pos bigint, stop bigint")


def files_and_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(df.inputFiles()), plan


@pytest.mark.parametrize("regions", [[Region("a", 1000, 3000)], [Region("b", 100, None), Region("c", 5, 6), Region("c", 4, 900)], [Region("x", 0, None)], []])
def test_rows_of_regions(spark, tmp_path, regions):
    rows, path = some_rows(spark).repartition(4), str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        stage(rows, path, "contig", F.col("pos"), F.col("stop"), ["@HD", "@CO x"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert is_staged(spark, path) and not is_staged(spark, str(tmp_path)) and staged_header(spark, path) == ["@HD", "@CO x"]
    place = ("contig", F.col("pos"), F.col("stop"))
    near = read_staged(spark, path, regions)
    table = region_table(spark, regions)
    assert near.columns == rows.columns
    assert sorted(fetch_regions(near, table, *place).collect()) == sorted(fetch_regions(rows, table, *place).collect())
    every, few = read_staged(spark, path), files_and_plan(near)
    assert every.count() == rows.count()
    if regions and regions[0].contig != "x":
        assert "PushedFilters: [" in few[1] and "GreaterThan(_end" in few[1] and len(few[0]) < len(files_and_plan(every)[0])
    with pytest.raises(OutputExists):
        stage(rows, path, *place)


def test_spans():
    given = [Region("a", 5, 9), Region("b", 1, 2), Region("a", 7, 20), Region("a", 20, 21), Region("a", 30, None), Region("a", 99, 100)]
    assert spans(given) == [Region("a", 5, 21), Region("a", 30, None), Region("b", 1, 2)]


def test_many_regions_are_read_by_their_hulls(spark, tmp_path):
    rows, path = some_rows(spark), str(tmp_path / "t")
    stage(rows, path, "contig", F.col("pos"), F.col("stop"))
    regions = [Region("a", i * 900, i * 900 + 10) for i in range(200)]
    place = ("contig", F.col("pos"), F.col("stop"))
    table = region_table(spark, regions)
    assert fetch_regions(read_staged(spark, path, regions), table, *place).count() == fetch_regions(rows, table, *place).count()


def test_tools_read_staged_files(spark, write, tmp_path):
    lines = [x for rows, _ in s.CASES.values() for x in rows] + s.CALM
    lines.sort(key=lambda x: (x.split("\t")[2], int(x.split("\t")[3])))
    sam, table = write("in.sam", [*s.sam_header(), *lines]), str(tmp_path / "staged")
    cli.run(spark, ["stage", sam, table])
    library = LibraryProperties(max_rlen=90, median_isize=250.0, std_dev_isize=12.0, max_normal_isize=s.LONGEST_INSERT)
    for regions in (None, [Region("alpha", 5_000, 70_000)]):
        out = []
        for n, path in enumerate((sam, table)):
            out.append(str(tmp_path / f"out-{n}.sam"))
            tools.scan(spark, path, out[-1], Config(), regions, library, single_file=True, overwrite=True)
        assert sorted(body(out[0])) == sorted(body(out[1])) and body(out[0])
        assert [x for x in open(out[0]) if x[0] == "@"] == [x for x in open(out[1]) if x[0] == "@"]
