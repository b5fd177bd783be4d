"""Depth tool, reference files, regions, library model, configuration and command line."""

import math
import random

import pytest
import samples as s

from riftspan import cli, session, tools
from riftspan.config import ClusterSettings, Config, DepthSettings, config_from_dict, load_config
from riftspan.errors import InvalidBedFile, InvalidRegion, OutputExists
from riftspan.plans.library import estimate_library
from riftspan.sources import headers as hd
from riftspan.sources import sam
from riftspan.sources.fasta import _fragments, read_fasta, reference_windows
from riftspan.sources.multijoin import multijoin
from riftspan.sources.regions import Region, parse_region, parse_regions, read_bed
from riftspan.sources.textio import in_part_order

SHORT = {"one": 870, "two": 430}
GROUP = "@RG\tID:sample\tSM:sample"


#: Pairs of 80-base reads; three fifths of the first read of the second pair are aligned, which is just enough.
PAIRS = [("p", "80M", "80M"), ("q", "48M32S", "47M33S"), ("r", "47M33S", "80M")]
LEFT, RIGHT, INSERT = 131, 431, 380


def depth_sam(write):
    rows = []
    for name, left, right in PAIRS:
        rows.append(s.read(name, 99, "one", LEFT, left, "=", RIGHT, INSERT, mapq=60, bases=80, tags=("RG:Z:sample",)))
        rows.append(s.read(name, 147, "one", RIGHT, right, "=", LEFT, -INSERT, mapq=60, bases=80, tags=("RG:Z:sample",)))
    rows.sort(key=lambda r: int(r.split("\t")[3]))
    return write("d.sam", [*s.sam_header(lengths=SHORT, extra=[GROUP]), *rows])


def expected_depth(kind):
    """Values of the windows that have any, base by base."""
    if kind == "fragments":
        return {(LEFT - 1 + INSERT // 2) // 100 * 100 + 1: "2:60"}
    depth = [0] * SHORT["one"]
    for _, left, right in PAIRS:
        for pos, cigar in ((LEFT, left), (RIGHT, right)):
            for k in range(int(cigar.split("M")[0])):
                depth[pos - 1 + k] += 1
    values = {}
    for start in range(0, len(depth), 100):
        own = depth[start : start + 100]
        if any(own):
            mean = sum(own) / 100
            deviation = math.sqrt((sum(x * x for x in own) - sum(own) * mean) / 99)
            values[start + 1] = f"{mean:.6g}:{deviation:.6g}:60"
    return values


def body(path):
    with open(path) as handle:
        return [line for line in handle.read().splitlines() if not line.startswith("##")]


@pytest.mark.parametrize("kind", ["coverage", "fragments"])
def test_depth(spark, write, tmp_path, kind):
    out = str(tmp_path / "out.vcf")
    config = Config(collect_doc_config=DepthSettings(count_kind=kind))
    tools.collect_depth(spark, depth_sam(write), out, config, single_file=True, date="20311230")
    special = expected_depth(kind)
    nothing = {"coverage": "0:0:0", "fragments": "0:0"}[kind]
    form = {"coverage": "GT:RCV:RCVSD:MQ", "fragments": "GT:RCV:MQ"}[kind]
    expected = []
    for contig, length in SHORT.items():
        for start in range(1, length + 1, 100):
            values = special.get(start, nothing) if contig == "one" else nothing
            end = min(start + 99, length)
            quality = values.split(":")[-1]
            expected.append(s.row(contig, start, f"{contig}:{start}-{end}", "N", "<WINDOW>", 0, ".", f"END={end};MAPQ={quality}", form, f"./.:{values}"))
    assert body(out)[1:] == expected
    with open(out) as handle:
        header = [line for line in handle.read().splitlines() if line.startswith("##")]
    assert header[:5] == [
        "##fileformat=VCFv4.2", '##FILTER=<ID=PASS,Description="All filters passed">', "##fileDate=20311230",
        "##contig=<ID=one,length=870>", "##contig=<ID=two,length=430>",
    ]
    assert header[-1] == "##median-coverage=<ID=sample,autosomes=0,_one=0,_two=0>"


def fasta(write):
    rng = random.Random(1)
    seqs = {name: "".join(rng.choice("ACGTacgtNn" if name == "one" else "ACGTRR") for _ in range(k)) for name, k in SHORT.items()}
    seqs["two"] = "N" * 100 + seqs["two"][100:]
    lines = []
    for name, seq in seqs.items():
        lines.append(f">{name} some text")
        lines += [seq[i : i + 60] for i in range(0, len(seq), 60)]
    return write("ref.fa", lines), seqs


def test_reference_windows(spark, write):
    path, seqs = fasta(write)
    lines = read_fasta(spark, path).collect()
    for name, seq in seqs.items():
        assert "".join(r["bases"] for r in sorted((r for r in lines if r["contig"] == name), key=lambda r: r["offset"])) == seq
    got = {(r["contig"], r["window_id"]): (r["gc"], r["has_gap"]) for r in reference_windows(spark, path, 100).collect()}
    for name, seq in seqs.items():
        for i in range(0, len(seq), 100):
            piece = seq[i : i + 100].upper()
            gc, known = sum(piece.count(x) for x in "GC"), sum(piece.count(x) for x in "ACGT")
            ratio, gap = got.pop((name, i // 100))
            assert gap == ("N" in piece)
            assert ratio is None if known == 0 else ratio == pytest.approx(gc / known, rel=1e-6)
    assert not got


def test_reference_windows_of_a_contig_on_one_line(spark, write):
    rng = random.Random(11)
    seq = "".join(rng.choice("ACGTN" if i % 9_000 < 300 else "ACGT") for i in range(50_123))
    path = write("long.fa", [">c", seq])
    got = {r["window_id"]: (r["gc"], r["has_gap"]) for r in reference_windows(spark, path, 100).collect()}
    assert sorted(got) == list(range(502))
    for i, (gc, gap) in got.items():
        piece = seq[i * 100 : i * 100 + 100]
        assert gap == ("N" in piece)
        assert gc == pytest.approx(sum(map(piece.count, "GC")) / sum(map(piece.count, "ACGT")), rel=1e-6)


@pytest.mark.parametrize("end", ["", "\n", "TGCA", "TGCA\n", "\r\n", "T"])
def test_a_contig_on_one_line_is_read_by_several_tasks(spark, tmp_path, end):
    rng = random.Random(12)
    seqs = {"a": "TGCA" + "".join(rng.choices("ACGT", k=40_000)), "xTGCA>y": "TGCA>"[:4] * 50 + "N" * 300, "c": "".join(rng.choices("ACGTacgt", k=9_000)) + "TGTGCA"}
    text = ">a with TGCA twice: TGCA\n" + seqs["a"] + "\n\n>xTGCA>y\r\n" + seqs["xTGCA>y"] + "\n>empty\n>c\n" + seqs["c"]
    path = tmp_path / "r.fa"
    path.write_bytes((text + end).encode())
    seqs["c"] += end.strip()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_fasta(spark, str(path)).collect()
        starts = _fragments(spark, str(path), "TGCA").filter("text <> ''").select("block.start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, seq in seqs.items():
        assert "".join(r["bases"] for r in sorted((r for r in rows if r["contig"] == name), key=lambda r: r["offset"])) == seq
    assert {r["contig"] for r in rows} == set(seqs)
    assert starts > 8 and max(len(r["bases"]) for r in rows if r["contig"] == "a") < 4_000  # small letters hold no cut
    with pytest.raises(ValueError):
        read_fasta(spark, str(path), "TT")


@pytest.mark.parametrize("kind", ["coverage", "fragments"])
def test_windows_end_with_the_contig(spark, write, tmp_path, kind):
    rows = [s.read("t", 99, "alpha", pos, "90M", "=", pos + 200, 290, mapq=60, tags=("RG:Z:sample",)) for pos in (1, 930, 980)]
    path = write("d.sam", [*s.sam_header(lengths={"alpha": 1_000, "beta": 50}, extra=[GROUP]), *rows])
    out = str(tmp_path / "out.vcf")
    tools.collect_depth(spark, path, out, Config(collect_doc_config=DepthSettings(count_kind=kind, window_length=100)), single_file=True)
    places = [tuple(line.split("\t")[:2]) for line in body(out)[1:]]
    assert places == [("alpha", str(100 * i + 1)) for i in range(10)] + [("beta", "1")]


def test_depth_with_reference_and_regions(spark, write, tmp_path):
    path, _ = fasta(write)
    out = str(tmp_path / "out.vcf")
    tools.collect_depth(
        spark, depth_sam(write), out, Config(path_reference_fasta=path), regions=[Region("two", 0, 250)], single_file=True
    )
    lines = body(out)[1:]
    assert [line.split("\t")[1] for line in lines] == ["1", "101", "201"]
    assert lines[0].split("\t")[7] == "END=100;GAP;MAPQ=0"
    assert "GC=" in lines[1].split("\t")[7]


def test_regions():
    assert parse_region("chr_1:1001-2000") == Region("chr_1", 1000, 2000)
    assert parse_region("chr_1:1001-2000", compat=True) == Region("1", 1001, 2000)
    assert parse_regions("a:1-5,b:2-9") == [Region("a", 0, 5), Region("b", 1, 9)]
    with pytest.raises(InvalidRegion):
        parse_region("chr1")


def test_bed_is_checked(spark, write):
    good = read_bed(spark, write("a.bed", ["one\t7\t8", "two\t0\t500\tname"]), ["one", "two"])
    assert [tuple(r) for r in good.collect()] == [("one", 7, 8), ("two", 0, 500)]
    for bad in ("one\t49", "three\t1\t2"):
        with pytest.raises(InvalidBedFile):
            read_bed(spark, write("b.bed", [bad]), ["one", "two"])


def test_headers():
    lines = s.sam_header(extra=["@RG\tID:a\tSM:x", "@RG\tID:b\tSM:x", "@RG\tID:c", "@RG\tID:d\tSM:y"])
    assert hd.alignment_samples(lines) == ["x", "y"]
    assert hd.alignment_contigs(lines, "^b") == [hd.Contig("beta", 350_000)]
    vcf = s.vcf_header(["s1", "s2"])
    assert hd.variant_samples(vcf) == ["s1", "s2"] and [c.name for c in hd.variant_contigs(vcf)] == ["1", "2", "3"]
    assert '##ALT=<ID=DEL,Description="Deletion">' in hd.sv_header([], ["s"])
    assert "##ALT=<ID=DEL,length=Deletion>" in hd.sv_header([], ["s"], compat=True)


def test_library_model(spark, write):
    rng = random.Random(2)
    sizes = [int(rng.gauss(300, 20)) for _ in range(300)] + [5000, 6000]
    rows = [s.read(f"t{i}", 99, "alpha", 100 + i, "90M", "=", 400 + i, size) for i, size in enumerate(sizes)]
    rows.insert(0, s.read("dup", 99 | 1024, "alpha", 50, "90M", "=", 300, 99999))
    path = write("l.sam", [*s.sam_header(), *rows])
    for cap in (100_000, 100):
        used = sorted(sizes[: cap + 1])
        median = used[len(used) // 2]
        kept = [x for x in used if 0.3 * median <= x <= 1.7 * median]
        deviation = math.sqrt(sum((x - median) ** 2 for x in kept) / len(kept))
        model = estimate_library(sam.read_alignments(spark, path), Config(lib_estimation_sample_size=cap), compat=True)
        assert (model.median_isize, model.max_rlen) == (median, 150)
        assert model.std_dev_isize == pytest.approx(deviation)
        assert model.max_normal_isize == math.ceil(median + 3 * deviation)
        if cap > len(sizes):
            assert estimate_library(sam.read_alignments(spark, path), Config(lib_estimation_sample_size=10)) == model


def test_parts_are_in_numerical_order():
    names = [f"/x/part-{n:05d}-a.txt" for n in (0, 9, 99_999, 100_000, 100_001)]
    assert in_part_order([names[3], names[1], names[4], names[2], names[0]]) == names
    assert in_part_order(["/x/b.txt", "/x/a.txt"]) == ["/x/a.txt", "/x/b.txt"]


def test_long_and_many_tags_come_back_whole(spark, write):
    tags = [f"{a}{b}:i:{k}" for k, (a, b) in enumerate((a, b) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefgh" for b in "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")]
    path = write("t.sam", [*s.sam_header(), s.read("t", 99, "alpha", 5, "90M", "=", 300, 395, tags=[*tags, "zz:Z:" + "x" * 1_500_000])])
    found = sam.read_alignments(spark, path).select("tags").first()["tags"]
    assert len(found) == len(tags) + 1 > 1_200
    assert len(found["zz"]) == 1_500_000


def test_config(tmp_path):
    assert load_config(None) == Config()
    path = tmp_path / "c.toml"
    path.write_text(
        'min_clipped_bases = 5\nunknown = 1\n[vcf_cluster_presets_per_tool_pesr]\nmax_bp_distance = 7\n[collect_doc_config]\ncount_kind = "fragments"\n'
    )
    config = load_config(str(path))
    assert config.min_clipped_bases == 5
    assert config.vcf_cluster_presets_per_tool_pesr == ClusterSettings(0.8, 7, True, True, None, 0.5)
    assert config.collect_doc_config == DepthSettings(count_kind="fragments")
    assert config_from_dict({}).vcf_cluster_presets_per_tool_doc.sv_type_out == "CNV"


def test_command_line(spark, write, tmp_path):
    before = session.checkpoints_written()
    rows, _ = s.CASES["across-contigs"]
    path = write("in.sam", [*s.sam_header(), rows[0], *s.CALM, *[r.replace("x\t", "y\t", 1) for r in s.CASES["clip-too-short"][0]], rows[1]])
    out = str(tmp_path / "folder.sam")
    cli.run(spark, ["scan", path, out])
    parts = sorted((tmp_path / "folder.sam").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text.startswith("@HD\tVN:1.6\tSO:unordered\n") and text.endswith(rows[-1] + "\n")
    # A folder of parts is valid input as well.
    again = str(tmp_path / "again.sam")
    cli.run(spark, ["unique", out, again, "--single-file"])
    with open(again) as handle:
        assert handle.read().splitlines()[-2:] == [f"{r}\txI:i:0" for r in rows]
    with pytest.raises(OutputExists):
        cli.run(spark, ["scan", path, out])
    assert session.checkpoints_written() == before
    cli.run(spark, ["scan", path, out, "--overwrite", "-r", "beta:1-80000"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "folder.sam").glob("part-*"))).endswith(rows[-1] + "\n")


def test_compressed_variants_are_read_and_written(spark, write, tmp_path):
    rows = [s.row("1", 100 + i, ".", "A", "<DEL>", 0, "PASS", f"SVTYPE=DEL;CHR2=1;END={500 + i};CT=3to5", "GT", "0/1") for i in range(20)]
    path = write("in.vcf", [*s.vcf_header(["smp"]), *rows])
    packed, again = str(tmp_path / "a.vcf.gz"), str(tmp_path / "b.vcf")
    cli.run(spark, ["standardize", "-t", "delly", path, packed, "--single-file"])
    cli.run(spark, ["cluster", packed, again, "--single-file"])
    assert len(body(again)) > 1


def test_standard_input_and_output(spark, write, monkeypatch, capsysbinary):
    import io
    import sys

    rows, _ = s.CASES["across-contigs"]
    text = "\n".join([*s.sam_header("queryname"), *rows, *rows]) + "\n"
    monkeypatch.setattr(sys, "stdin", io.TextIOWrapper(io.BufferedReader(io.BytesIO(text.encode()))))
    cli.run(spark, ["unique", "-", "-"])
    assert capsysbinary.readouterr().out.decode().splitlines()[-2:] == [f"{r}\txI:i:0" for r in rows]


def test_multijoin(spark):
    tables = [spark.createDataFrame([(k, f"{n}{k}") for k in ks], f"key int, {n} string") for n, ks in (("a", [1, 2, 3]), ("b", [2, 3]), ("c", [3, 4]))]
    assert [tuple(r) for r in multijoin(tables, "key").collect()] == [(3, "a3", "b3", "c3")]
