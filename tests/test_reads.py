"""Scan, duplicate removal and evidence extraction on small files."""

import json

import pytest
import samples as s

from riftspan import tools
from riftspan.config import Config
from riftspan.errors import OutputExists
from riftspan.plans.library import LibraryProperties, library_from_header

LIBRARY = LibraryProperties(max_rlen=s.READ, median_isize=250.0, std_dev_isize=12.0, max_normal_isize=s.LONGEST_INSERT)


def body(path, mark="@"):
    with open(path) as handle:
        return [line for line in handle.read().splitlines() if not line.startswith(mark)]


def case_file(write, case, tag=""):
    rows = s.in_file_order([*s.CALM, *s.CASES[case][0]])
    return write("in.sam", [*s.sam_header(), *[r + tag for r in rows]]), rows


@pytest.mark.parametrize("case", sorted(s.CASES))
def test_rule_agrees_with_the_cases(case):
    rows, telling = s.CASES[case]
    assert {i for i, r in enumerate(rows) if s.shows_evidence(r)} == telling
    assert not any(map(s.shows_evidence, s.CALM))


@pytest.mark.parametrize("case", sorted(s.CASES))
def test_scan_repeats_rows_per_window_and_pass(spark, write, tmp_path, case):
    path, rows = case_file(write, case)
    out = str(tmp_path / "out.sam")
    tools.scan(spark, path, out, library=LIBRARY, single_file=True, compat=True)
    assert body(out) == s.scanned_twice(rows)


@pytest.mark.parametrize("case", sorted(s.CASES))
def test_scan_writes_each_row_once_by_default(spark, write, tmp_path, case):
    path, _ = case_file(write, case)
    out = str(tmp_path / "out.sam")
    tools.scan(spark, path, out, library=LIBRARY, single_file=True)
    rows, telling = s.CASES[case]
    assert sorted(body(out)) == sorted(rows if telling else [])


@pytest.mark.parametrize("regions,left", [(["alpha\t5000\t5150"], 0), (["beta\t76990\t77000"], 0), (["alpha\t5189\t9000", "beta\t77089\t77090"], 2), (["beta\t0\t76000"], 2)])
def test_scan_leaves_out_blocked_reads(spark, write, tmp_path, regions, left):
    # Without compat, a read is tested with its whole alignment and its mate with the first base.
    path, _ = case_file(write, "across-contigs")
    out = str(tmp_path / "out.sam")
    tools.scan(spark, path, out, config=Config(blocked_regions_bed=write("blocked.bed", regions)), library=LIBRARY, single_file=True)
    blocked = {tuple(r.split("\t")) for r in regions}

    def hit(contig, start, end):
        return any(c == contig and start < int(b) and int(a) < end for c, a, b in blocked)

    rows = s.CASES["across-contigs"][0]
    spans = [("alpha", 5_099, 5_189), ("beta", 76_999, 77_089)]
    kept = [r for r, own, mate in zip(rows, spans, spans[::-1]) if not hit(*own) and not hit(mate[0], mate[1], mate[1] + 1)]
    assert sorted(body(out)) == sorted(kept)
    assert left in (0, 2) and (len(kept) == left or regions[0].startswith("alpha\t5189") or regions[0].startswith("beta\t76990"))


def test_scan_header_gets_library_statistics(spark, write, tmp_path):
    path = write("in.sam", [*s.sam_header(extra=["@RG\tID:g1\tSM:tumor", "@CO\tmade up"]), *s.CALM])
    out = str(tmp_path / "out.sam")
    tools.scan(spark, path, out, library=LIBRARY, single_file=True)
    with open(out) as handle:
        header = handle.read().splitlines()
    assert header == [
        "@HD\tVN:1.6\tSO:unordered", "@SQ\tSN:alpha\tLN:700000", "@SQ\tSN:beta\tLN:350000",
        "@RG\tID:g1\tSM:tumor\tPI:250\tPS:12\tPR:90", "@CO\tmade up",
    ]
    assert library_from_header(header, Config()) == LibraryProperties(90, 250.0, 12.0, 286)
    assert library_from_header(header, Config(), compat=True) == LibraryProperties(250, 250.0, 12.0, 265)
    with pytest.raises(OutputExists):
        tools.scan(spark, path, out, library=LIBRARY)


def split(first, contig, start, end, sides):
    return contig, start, end, {"SplitRead": dict(read_id=4, is_first=first, contig=contig, start=start, end=end, clipped_sides=sides)}


def pair(first, contig, start, end, strand, mate, mate_start, mate_strand, tlen):
    fields = dict(read_id=4, is_first1=first, contig1=contig, start1=start, end1=end, strand1=strand, contig2=mate, start2=mate_start, strand2=mate_strand, tlen=tlen)
    return contig, start, end, {"PairedRead": fields}


F, R = "Forward", "Reverse"
#: Evidence of the cases, worked out by hand; starts are zero-based.
EVIDENCE = {
    "both-forward": [pair(True, "alpha", 12_499, 12_589, F, "alpha", 12_679, F, 270), pair(False, "alpha", 12_679, 12_769, F, "alpha", 12_499, F, None)],
    "both-reverse": [pair(True, "beta", 899, 989, R, "beta", 1_049, R, 240), pair(False, "beta", 1_049, 1_139, R, "beta", 899, R, None)],
    "stretched": [pair(True, "alpha", 22_999, 23_089, F, "alpha", 23_809, R, 900), pair(False, "alpha", 23_809, 23_899, R, "alpha", 22_999, F, None)],
    "longest-normal": [],
    "across-contigs": [pair(True, "alpha", 5_099, 5_189, F, "beta", 76_999, R, 0), pair(False, "beta", 76_999, 77_089, R, "alpha", 5_099, F, 0)],
    "clipped-left": [split(True, "alpha", 60_999, 61_064, "Left")],
    "clipped-both": [split(False, "alpha", 80_999, 81_045, "Both")],
    "clip-too-short": [],
    "chimera": [split(True, "alpha", 90_009, 90_069, "Right"), split(True, "beta", 2_999, 3_029, "Left"), pair(True, "beta", 2_999, 3_029, F, "alpha", 90_169, R, 0)],
    "end-of-contig": [split(False, "alpha", 699_930, 700_000, "Right")],
}


@pytest.mark.parametrize("case", sorted(EVIDENCE))
def test_evidence(spark, write, tmp_path, case):
    path, _ = case_file(write, case, "\txI:i:4")
    out = str(tmp_path / "out.tsv")
    tools.collect_evidence(spark, path, out, library=LIBRARY, single_file=True)
    with open(out) as handle:
        head, *lines = handle.read().splitlines()
    assert head == "#contig\tstart\tend\tsignal"
    found = [line.split("\t", 3) for line in lines]
    assert [(c, int(a), int(b), json.loads(signal)) for c, a, b, signal in found] == EVIDENCE[case]
    assert all(json.dumps(json.loads(signal), separators=(",", ":")) == signal for *_, signal in found)


#: Positions of the rows of each run of a name; a run keeps the first row of each position.
RUNS = {
    "one-run": [("k", [500, 900, 500, 1_200, 900, 900])],
    "two-names": [("k", [700, 700]), ("m", [700, 30])],
    "name-comes-again": [("k", [8, 8, 9]), ("m", [8]), ("k", [9, 8, 9])],
    "single-rows": [("a", [1]), ("b", [1]), ("c", [1])],
}


@pytest.mark.parametrize("case", sorted(RUNS))
def test_unique_keeps_first_rows_and_numbers_runs(spark, write, tmp_path, case):
    lines, expected = [], []
    for number, (name, positions) in enumerate(RUNS[case]):
        for i, pos in enumerate(positions):
            line = s.read(name, 64, "beta", pos, "90M", "=", pos + 150, 240)
            lines.append(line)
            if pos not in positions[:i]:
                expected.append(f"{line}\txI:i:{number}")
    path = write("in.sam", [*s.sam_header("queryname"), *lines])
    out = str(tmp_path / "out.sam")
    tools.unique(spark, path, out, single_file=True)
    assert body(out) == expected


def test_runs_continue_across_file_splits(spark, write, tmp_path):
    import random

    rng = random.Random(3)
    lines, expected, last, run, seen = [], [], None, -1, set()
    for i in range(3000):
        name = f"t{rng.randrange(3)}"
        pos = rng.randrange(1, 4)
        line = s.read(name, 64, "alpha", pos, "10M", bases=10)
        if name != last:
            run, seen, last = run + 1, set(), name
        if pos not in seen:
            seen.add(pos)
            expected.append(f"{line}\txI:i:{run}")
        lines.append(line)
    path = write("in.sam", [*s.sam_header(), *lines])
    out = str(tmp_path / "out.sam")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        tools.unique(spark, path, out, single_file=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert body(out) == expected
