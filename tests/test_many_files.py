"""Many callsets in one scan."""

import samples as s
from test_variants import std

from riftspan import tools
from riftspan.sources import vcf


def callsets(write, n):
    paths = []
    for i in range(n):
        names = [f"p{i}", f"q{i}"]
        rows = [s.row("1", 1_000 + k * 5_000 + i, f"v{i}_{k}", "N", "<DEL>", 0, ".", std(1_900 + k * 5_000 + i, "1", "DEL", "+-", 900, "delly"), "GT:delly", "0/1:1", "0/0:0") for k in range(3)]
        paths.append(write(f"calls {i}+a.vcf", [*s.vcf_header(names, ["1", "2"]), *rows]))
    return paths


def jobs_and_plan(spark, paths):
    group = f"many-{len(paths)}"
    spark.sparkContext.setJobGroup(group, group)
    facts = vcf.header_facts(spark, paths)
    rows = vcf.read_many_variants(spark, paths, facts)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    n = rows.count()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext._jsc.clearJobGroup()
    return facts, n, jobs, plan.count("\n")


def test_plan_and_jobs_do_not_grow_with_the_files(spark, write):
    paths = callsets(write, 120)
    few, many = (jobs_and_plan(spark, p) for p in (paths[:40], paths))  # beyond 32 paths Spark lists them by a job
    assert few[1:] == (120, *many[2:]) and many[1] == 360
    assert [(f["file_ord"], f["contigs"], f["samples"]) for f in many[0]] == [(i, ["1", "2"], [f"p{i}", f"q{i}"]) for i in range(120)]


def test_rows_carry_their_file_and_its_samples(spark, write):
    paths = callsets(write, 5)
    rows = vcf.read_many_variants(spark, paths, vcf.header_facts(spark, paths)).collect()
    assert {(r["file_ord"], r["id"], *(c["sample"] for c in r["calls"])) for r in rows} == {(i, f"v{i}_{k}", f"p{i}", f"q{i}") for i in range(5) for k in range(3)}


def test_clusters_over_many_files(spark, write, tmp_path):
    out, staged = str(tmp_path / "out.vcf"), str(tmp_path / "staged")
    paths = callsets(write, 12)
    tools.cluster(spark, paths, out, single_file=True)
    lines = open(out).read().splitlines()
    assert lines[-4].split("\t")[9:] == [n for i in range(12) for n in (f"p{i}", f"q{i}")]
    assert len([x for x in lines if x[0] != "#"]) == 3
    tools.stage(spark, paths[1], staged)  # a staged file among the others
    again = str(tmp_path / "again.vcf")
    tools.cluster(spark, [paths[0], staged, *paths[2:]], again, single_file=True)
    assert open(again).read() == open(out).read()
