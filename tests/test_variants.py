"""Standardizing, clustering and annotating small variant files."""

import json

import pytest
import samples as s

from riftspan import tools
from riftspan.config import ClusterSettings, Config
from riftspan.errors import InconsistentInput, UnknownClusterSetting


def body(path):
    with open(path) as handle:
        return [line for line in handle.read().splitlines() if not line.startswith("##")]


def info(**fields):
    return ";".join(k if v is True else f"{k}={v}" for k, v in fields.items())


def std(end2, chrom2, kind, strands, length, tool):
    strands = f";STRANDS={strands}" if strands else ""
    return f"END2={end2};CHR2={chrom2};SVTYPE={kind}{strands};SVLEN={length};ALGORITHMS={tool}"


#: Made-up calls: contig, position, bases, alternative, filter, fields, genotype; and what the common layout makes of them.
DELLY = [
    (("2", 501, "T", "<DEL>", "PASS", dict(SVTYPE="DEL", CHR2="2", END=1_500, CT="3to5"), "1/1"), ("T", "<DEL>", (1_500, "2", "DEL", "+-", 1_000), "1/1:1")),
    (("2", 7_300, "G", "<INV>", "PASS", dict(SVTYPE="INV", CHR2="2", END=9_299, CT="5to5"), "0/1"), ("G", "<INV>", (9_299, "2", "INV", "--", 2_000), "0/1:1")),
    (("2", 8_000, "C", "<INS>", "PASS", dict(SVTYPE="INS", CHR2="2", END=8_001, CT="NtoN"), "0/1"), None),
    (("2", 8_700, "C", "<INV>", "LowMapQ", dict(SVTYPE="INV", CHR2="2", END=8_700, CT="3to3"), "./1"), ("C", "<INV>", (8_700, "2", "INV", "++", 1), "./1:1")),
    (("3", 44, "A", "<DUP>", "LowQual", dict(SVTYPE="DUP", CHR2="3", END=143, CT="5to3"), "0/0"), ("A", "<DUP>", (143, "3", "DUP", "-+", 100), "0/0:0")),
    (("3", 2_000, "G", "[1:777[G", "PASS", dict(SVTYPE="BND", CHR2="1", END=777, CT="5to5"), "./."), ("G", "[1:777[G", (777, "1", "BND", "--", -1), "./.:0")),
    (("3", 2_500, "T", "T]2:31]", "PASS", dict(SVTYPE="BND", CHR2="2", END=31, CT="3to3"), "0|1"), ("T", "T]2:31]", (31, "2", "BND", "++", -1), "0|1:1")),
]
MANTA = [
    (("1", 900, "CAGTAGTA", "C", "PASS", dict(END=907, SVTYPE="DEL", SVLEN=-7), "0/1"), ("C", "<DEL>", (907, "1", "DEL", "+-", 8), "0/1:1")),
    (("1", 2_001, "C", "<INV>", "PASS", dict(END=2_600, SVTYPE="INV", INV3=True), "1/1"), ("C", "<INV>", (2_600, "1", "INV", "++", 600), "1/1:1")),
    (("1", 2_003, "C", "<INV>", "MinGQ", dict(END=2_602, SVTYPE="INV", INV5=True), "0/1"), ("C", "<INV>", (2_602, "1", "INV", "--", 600), "0/1:1")),
    (("2", 31, "T", "T]3:2500]", "MinGQ", dict(SVTYPE="BND"), "0/1"), ("T", "T]3:2500]", (2_500, "3", "BND", "++", -1), "0/1:1")),
    (("2", 60, "A", "[1:90[A", "PASS", dict(SVTYPE="BND"), "0/0"), ("A", "[1:90[A", (90, "1", "BND", "--", -1), "0/0:0")),
    (("2", 80, "G", "G[HLA-A*01:02:300[", "PASS", dict(SVTYPE="BND"), "0/1"), ("G", "G[HLA-A*01:02:300[", (300, "HLA-A*01:02", "BND", "+-", -1), "0/1:1")),
    (("3", 100, "G", "<INS>", "PASS", dict(END=101, SVTYPE="INS"), "0/1"), None),
    (("3", 4_000, "T", "<DUP:TANDEM>", "PASS", dict(END=4_999, SVTYPE="DUP:TANDEM"), "0/1"), ("T", "<DUP>", (4_999, "3", "DUP", "-+", 1_000), "0/1:1")),
]
CNMOPS = [
    (("1", 5_001, "N", "<CNV>", "PASS", dict(END=9_000, SVTYPE="DUP"), "1"), ("N", "<CNV>", (9_000, "1", "DUP", None, 4_000), "1:1")),
    (("2", 1, "N", "<CNV>", "weak", dict(END=500, SVTYPE="DEL"), "0"), ("N", "<CNV>", (500, "2", "DEL", None, 500), "0:0")),
    (("3", 700, "N", "<CNV>", "PASS", dict(END=700, SVTYPE="DEL"), "."), ("N", "<CNV>", (700, "3", "DEL", None, 1), ".:0")),
]
DIALECTS = {"delly": DELLY, "manta": MANTA, "cnmops": CNMOPS}


@pytest.mark.parametrize("tool", sorted(DIALECTS))
@pytest.mark.parametrize("filtered", [True, False])
def test_standardize(spark, write, tmp_path, tool, filtered):
    cases = DIALECTS[tool]
    lines = [s.row(c, p, f"call{p}", ref, alt, 17, flt, info(**fields), "GT:CN", f"{gt}:2") for (c, p, ref, alt, flt, fields, gt), _ in cases]
    path = write("in.vcf", [*s.vcf_header(["patient"]), *lines])
    out = str(tmp_path / "out.vcf")
    tools.standardize(spark, path, out, tool, Config(stdvcf_apply_filters=filtered), single_file=True)
    expected = [(given, made) for given, made in cases if made is not None and (not filtered or given[4] == "PASS")]
    assert body(out)[1:] == [
        s.row(given[0], given[1], ".", ref, alt, 0, ".", std(*fields, tool), f"GT:{tool}", cell) for given, (ref, alt, fields, cell) in expected
    ]


def sv_file(write, name, sample, tool, rows):
    lines = [
        s.row("2", pos, ".", "G", f"<{alt}>", 0, ".", std(end2, "2", kind, strands, end2 - pos + 1, tool), f"GT:{tool}", cell)
        for pos, end2, alt, kind, strands, cell in rows
    ]
    return write(name, [*s.vcf_header([sample]), *lines])


def cluster_line(number, pos, end2, alt, kind, strands, tool, cells):
    fields = std(end2, "2", kind, strands, end2 - pos + 1, tool)
    return s.row("2", pos, f"SV{number:08d}", "N", f"<{alt}>", 0, ".", fields, f"GT:{tool}", *cells)


def test_three_samples_cluster_by_type_strands_and_distance(spark, write, tmp_path):
    # Pairwise: ends at most 300 apart, same type and strands. Of the deletions near 6,000 the first and
    # last are 380 apart, but the middle one ties them. The medians of odd counts are members.
    paths = [
        sv_file(write, "a.vcf", "s1", "delly", [(6_000, 9_000, "DEL", "DEL", "+-", "0/1:1"), (50_000, 52_000, "DUP", "DUP", "-+", "1/1:1")]),
        sv_file(write, "b.vcf", "s2", "delly", [(6_190, 9_190, "DEL", "DEL", "+-", "0/1:1"), (50_000, 52_000, "INV", "INV", "--", "0/1:1")]),
        sv_file(write, "c.vcf", "s3", "delly", [(6_380, 9_380, "DEL", "DEL", "+-", "1/1:1"), (6_380, 9_700, "DEL", "DEL", "+-", "0/1:1"), (50_000, 52_000, "INV", "INV", "++", "0/1:1")]),
    ]
    out = str(tmp_path / "out.vcf")
    tools.cluster(spark, paths, out, single_file=True)
    none = "./.:0"
    head, *lines = body(out)
    assert head == s.vcf_header(["s1", "s2", "s3"])[-1]
    assert lines == [
        cluster_line(1, 6_190, 9_190, "DEL", "DEL", "+-", "delly", ["0/1:1", "0/1:1", "1/1:1"]),
        cluster_line(2, 6_380, 9_700, "DEL", "DEL", "+-", "delly", [none, none, "0/1:1"]),
        cluster_line(3, 50_000, 52_000, "DUP", "DUP", "-+", "delly", ["1/1:1", none, none]),
        cluster_line(4, 50_000, 52_000, "INV", "INV", "--", "delly", [none, "0/1:1", none]),
        cluster_line(5, 50_000, 52_000, "INV", "INV", "++", "delly", [none, none, "0/1:1"]),
    ]


def test_depth_calls_cluster_by_overlap_alone(spark, write, tmp_path):
    # Reciprocal overlap: 8,000 of 9,000 bases, and 1,000 of 9,000.
    paths = [
        sv_file(write, "a.vcf", "s1", "cnmops", [(1_001, 10_000, "CNV", "DEL", None, "1:1"), (30_001, 39_000, "CNV", "DUP", None, "1:1")]),
        sv_file(write, "b.vcf", "s2", "cnmops", [(2_001, 11_000, "CNV", "DUP", None, "1:1"), (38_001, 47_000, "CNV", "DUP", None, "1:1")]),
    ]
    out = str(tmp_path / "out.vcf")
    tools.cluster(spark, paths, out, "per_tool_doc", single_file=True)
    ends = [tuple(line.split("\t")[1:2]) + (line.split("END2=")[1].split(";")[0],) for line in body(out)[1:]]
    assert ends == [("1501", "10500"), ("30001", "39000"), ("38001", "47000")]
    assert all("SVTYPE=CNV" in line and "<CNV>" in line for line in body(out)[1:])


def test_cluster_needs_known_setting_and_equal_contigs(spark, write, tmp_path):
    first = sv_file(write, "a.vcf", "s1", "delly", [(77, 99, "DEL", "DEL", "+-", "0/1:1")])
    other = write("b.vcf", s.vcf_header(["s2"], ["X", "Y"]))
    with pytest.raises(UnknownClusterSetting):
        tools.cluster(spark, [first], str(tmp_path / "x"), "no_such_setting")
    with pytest.raises(InconsistentInput):
        tools.cluster(spark, [first, other], str(tmp_path / "x"))


def test_sample_overlap_can_be_required(spark, write, tmp_path):
    near = (70_000, 71_000, "DUP", "DUP", "-+", "0/1:1")
    paths = [sv_file(write, f"{n}.vcf", n, "delly", [near, (70_005, 71_000, *near[2:])][: 2 if n == "s1" else 1]) for n in ("s1", "s2", "s3")]
    for share, clusters in ((None, 1), (0.5, 3)):
        preset = ClusterSettings(sample_overlap=share)
        out = str(tmp_path / f"out-{share}.vcf")
        tools.cluster(spark, paths, out, config=Config(vcf_cluster_presets_per_tool_pesr=preset), single_file=True)
        assert len(body(out)) == 1 + clusters


HEADER = s.vcf_header(["patient"], ["3", "X"])
#: A deletion of 3,000 bases and a duplication of 4,000.
SVS = [
    s.row("3", 5_001, "del", "A", "<DEL>", 0, ".", std(8_000, "3", "DEL", "+-", 3_000, "delly"), "GT:delly", "0/1:1"),
    s.row("X", 12_001, "dup", "C", "<DUP>", 0, ".", std(16_000, "X", "DUP", "-+", 4_000, "delly"), "GT:delly", "1/1:1"),
]


def evidence_line(kind, place, begin, stop, **fields):
    return "\t".join([place, str(begin), str(stop), json.dumps({kind: fields}, separators=(",", ":"))])


def template(read_id, contig, left, right, strands):
    """Both reads of a pair, each with its mate."""
    sides = [(left, strands[0], right, strands[1], True, 500), (right, strands[1], left, strands[0], False, None)]
    return [
        evidence_line("PairedRead", contig, a, a + 90, read_id=read_id, is_first1=first, contig1=contig, start1=a, end1=a + 90, strand1=x,
                      contig2=contig, start2=b, strand2=y, tlen=size)
        for a, x, b, y, first, size in sides
    ]


def halves(read_id, contig, left, right, sides):
    """Two alignments of one split read."""
    return [
        evidence_line("SplitRead", contig, a, a + 45, read_id=read_id, is_first=True, contig=contig, start=a, end=a + 45, clipped_sides=side)
        for a, side in ((left, sides[0]), (right, sides[1]))
    ]


EVIDENCE = [
    "#contig\tstart\tend\tsignal",
    *template(1, "3", 4_500, 8_300, ("Forward", "Reverse")),
    *template(2, "3", 4_910, 8_020, ("Forward", "Reverse")),
    *template(3, "3", 4_600, 9_600, ("Forward", "Reverse")),  # too far at the right
    *template(4, "3", 4_700, 8_300, ("Reverse", "Forward")),  # facing away
    *halves(5, "3", 4_950, 8_000, ("Right", "Left")),
    *halves(6, "3", 4_950, 8_000, ("Left", "Right")),
    *template(7, "X", 12_020, 15_800, ("Reverse", "Forward")),
]


def depth_rows():
    """Windows of 100 bases: level 24, but 12 within the deletion and 48 within the duplication."""
    inside = {"3": (5_000, 8_000, 12.0), "X": (12_000, 16_000, 48.0)}
    rows = []
    for c, (lo, hi, level) in inside.items():
        for start in range(0, 20_000, 100):
            cov = level if lo <= start < hi else 24.0
            rows.append(s.row(c, start + 1, ".", "N", "<WINDOW>", 0, ".", f"END={start + 100};MAPQ=60", "GT:RCV:RCVSD:MQ", f"./.:{cov}:0.5:60"))
    return rows


def snv_rows():
    """Two variants left of the deletion, three within, four right; two in the duplication, and some that do not count."""
    heterozygous = {"3": {2_500: "8,8", 4_999: "9,3", 5_001: "5,5", 6_000: "6,2", 8_000: "2,6", 8_001: "4,4", 9_000: "4,4", 10_000: "4,4", 11_000: "4,4", 11_001: "4,4"},
                    "X": {12_001: "30,10", 15_999: "7,7"}}
    rows = [s.row(c, p, ".", "G", "T", 0, ".", ".", "GT:AD", f"0/1:{ad}") for c, own in heterozygous.items() for p, ad in own.items()]
    rows += [s.row("3", 6_500, ".", "G", "T", 0, ".", ".", "GT:AD", "1/1:0,9"), s.row("X", 13_000, ".", "G", "TA", 0, ".", ".", "GT:AD", "0/1:5,5")]
    return sorted(rows, key=lambda r: (r.split("\t")[0], int(r.split("\t")[1])))


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("blocked", [False, True])
def test_annotate(spark, write, tmp_path, blocked, compat):
    config = Config(blocked_regions_bed=write("b.bed", ["3\t4400\t4560", "X\t1\t2"]) if blocked else None)
    out, doc, baf = (str(tmp_path / n) for n in ("out.vcf", "doc.tsv", "baf.tsv"))
    tools.annotate(
        spark, write("svs.vcf", [*HEADER, *SVS]), out, "patient", config,
        path_pesr_evidence=write("e.tsv", EVIDENCE),
        path_doc_evidence=write("d.vcf", [*HEADER, *depth_rows()]),
        path_snv_vcf=write("s.vcf", [*HEADER, *snv_rows()]),
        path_out_doc_summary=doc, path_out_baf_snvs=baf, single_file=True, compat=compat,
    )
    pairs = 1 if blocked else 2
    right = 2 if compat else 4  # the compatible mode counts the left flank twice
    assert body(out)[1:] == [
        SVS[0].replace("GT:delly", "GT:delly:PR:SR:RD:VL:VM:VR") + f":{pairs}:1:0.5:2:3:{right}",
        SVS[1].replace("GT:delly", "GT:delly:PR:SR:RD") + ":1:0:2",
    ]
    assert body(doc) == ["CHROM\tpatient", "autosomes\t24", "3\t24", "X\t24"]
    assert body(baf) == ["SVID\tSAMPLE\tBAFS", "dup\tpatient\t0.25000;0.50000"]


def test_long_variants_are_cropped_only_in_the_compatible_mode(spark, write, tmp_path):
    # Cropped to the zero-based [6,000, 7,000), with a flank [5,000, 6,000) that is counted twice.
    for compat, counts in ((False, "2:3:4"), (True, "2:0:2")):
        out = str(tmp_path / f"{compat}.vcf")
        config = Config(annotation_doc_baf_limit=1_000)
        tools.annotate(spark, write("svs.vcf", [*HEADER, *SVS]), out, "patient", config, path_snv_vcf=write("s.vcf", [*HEADER, *snv_rows()]), single_file=True, compat=compat)
        assert body(out)[1].endswith(f"GT:delly:VL:VM:VR\t0/1:1:{counts}")


def test_plan_does_not_grow_with_the_cohort(spark, write, tmp_path):
    names = [f"s{i}" for i in range(3_000)]
    cells = ["0/1:1" if i in (7, 2_999) else "0/0:0" for i in range(3_000)]
    line = s.row("2", 500, ".", "G", "<DEL>", 0, ".", std(900, "2", "DEL", "+-", 401, "delly"), "GT:delly", *cells)
    out = str(tmp_path / "out.vcf")
    tools.cluster(spark, [write("wide.vcf", [*s.vcf_header(names), line])], out, single_file=True)
    head, only = body(out)
    assert head.split("\t")[9:] == names
    assert only.split("\t")[9:] == cells


def test_types_that_are_not_clustered_stay_on_their_own(spark, write, tmp_path):
    paths = [sv_file(write, f"{n}.vcf", n, "delly", [(500, 900, "CNV", "CNV", "+-", "0/1:1")]) for n in ("s1", "s2")]
    for compat, rows in ((False, 2), (True, 0)):
        out = str(tmp_path / f"{compat}.vcf")
        tools.cluster(spark, paths, out, single_file=True, compat=compat)
        assert len(body(out)) == 1 + rows
