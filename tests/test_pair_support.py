"""Templates on both sides of variants against a plain search, with copies, heavy templates and windows far apart."""

import random

import pytest
from pyspark.sql import functions as F

from riftspan.operators import pair_support
from riftspan.plans.annotate import evidence_counts, search_windows

KINDS = [("DEL", "+-"), ("DUP", "-+"), ("INV", "++"), ("BND", "++"), ("BND", "-+"), ("CNV", "+-")]
EVIDENCE = "kind string, read_id bigint, is_first boolean, contig string, start bigint, end bigint, strand1 string, clipped_sides string"
SVS = "row_id bigint, chrom string, pos bigint, chrom2 string, end2 bigint, sv_type string, strands string"


def _evidence(rng, n, axis):
    rows = []
    for _ in range(n):
        start = rng.randrange(axis)
        length = rng.choice([0, 1, 20, 37, 64, 700])
        place = (rng.choice(["a", "a", "b", None]), start, start + length)
        if rng.random() < 0.5:
            rows.append(("PairedRead", rng.choice([None, 1, rng.randrange(40)]), None, *place, rng.choice(["Forward", "Reverse"]), None))
        else:
            rows.append(("SplitRead", rng.choice([None, 1, rng.randrange(40)]), rng.choice([True, False]), *place, None, rng.choice(["Both", "Left", "Right"])))
    return rows + rows[: n // 5]


def _svs(rng, n, axis):
    rows = []
    for i in range(n):
        pos, kind = rng.randrange(axis), rng.choice(KINDS)
        end2 = rng.choice([pos + rng.randrange(60), rng.randrange(axis), None if i % 17 == 0 else pos])
        rows.append((i, rng.choice(["a", "b"]), pos, rng.choice(["a", "a", "b"]), end2, *kind))
    return rows + [(n + i, *r[1:]) for i, r in enumerate(rows[:20])]


@pytest.mark.parametrize(
    "windows, most_reads, work, at_once",
    [(1024, 250_000, 2_000_000_000, 4_000_000), (8, 250_000, 2_000_000_000, 30), (16, 40, 500, 100), (1024, 250_000, 3_000, 1)],
)
def test_counts_equal_plain_search(spark, monkeypatch, windows, most_reads, work, at_once):
    for name, value in (("WINDOWS_PER_BLOCK", windows), ("READS_PER_BLOCK", most_reads), ("WORK_PER_TASK", work), ("HITS_AT_ONCE", at_once)):
        monkeypatch.setattr(pair_support, name, value)
    rng = random.Random(windows + at_once)
    evidence, svs = _evidence(rng, 400, 1500), _svs(rng, 120, 1500)
    frame, calls = spark.createDataFrame(evidence, EVIDENCE), spark.createDataFrame(svs, SVS)
    got = {r[0]: (r[1], r[2]) for r in evidence_counts(calls, frame, 50, 10).collect()}
    expected = {}
    for row_id, all_windows in calls.select("row_id", search_windows(50, 10)).filter("chrom2 is not null and end2 is not null").collect():
        hit = {}
        for w in all_windows or []:
            for kind, read_id, first, contig, start, end, strand, sides in evidence:
                faces = strand == w["strand"] if kind == "PairedRead" else sides == "Both" or (sides == "Right") == (w["strand"] == "Forward")
                if contig == w["contig"] and faces and end > start and start < w["hi"] and w["lo"] < end:
                    hit.setdefault((w["pair"], kind, read_id, kind == "SplitRead" and first), set()).add(w["side"])
        both = [k[1] for k, s in hit.items() if len(s) == 2]
        if both:
            expected[row_id] = (both.count("PairedRead"), both.count("SplitRead"))
    assert got == expected and len(got) > 20


def test_hits_of_near_windows_are_not_grouped(spark, monkeypatch):
    """Thousands of reads at both ends of each variant: only reads and counts may be moved."""
    monkeypatch.setattr(pair_support, "_by_bins", lambda *_: pytest.fail("hits were moved"), raising=False)
    reads = spark.range(3000).select(
        F.lit("PairedRead").alias("kind"), F.col("id").alias("read_id"), F.lit(True).alias("is_first"), F.lit("a").alias("contig"),
        (F.col("id") % 40).alias("start"), (F.col("id") % 40 + 200).alias("end"), F.lit("Reverse").alias("strand1"), F.lit(None).cast("string").alias("clipped_sides"),
    )
    svs = spark.range(500).selectExpr("id AS row_id", "'a' AS chrom", "100 + id % 50 AS pos", "'a' AS chrom2", "120 + id AS end2", "'BND' AS sv_type", "'++' AS strands")
    counts = evidence_counts(svs, reads, 50, 10)
    assert {(r["row_id"], r["pe_count"], r["sr_count"]) for r in counts.filter("row_id < 90").collect()} == {(i, 3000, 0) for i in range(90)}
    assert "bit_or" not in counts._jdf.queryExecution().toString()
