"""BCF codec and data source."""

import struct

import samples as s

from riftspan import tools
from riftspan.sources import headers as hd
from riftspan.sources.bcf import bcf_header, decode_record, encode_line, header_names
from riftspan.sources.vcf import read_variants

HEADER = hd.sv_header([hd.Contig(c, 1_000_000) for c in ("1", "2")], ["a", "b"])
LINES = [
    s.row("1", 100, "x1", "A", "<DEL>", 0, ".", "END2=40000;CHR2=1;SVTYPE=DEL;STRANDS=+-;SVLEN=300;ALGORITHMS=delly,manta", "GT:delly:PR", "0/1:1:0.5", "./.:0:."),
    s.row("2", 7, ".", "C", "]1:5]C,<DUP>", ".", "PASS", ".", "GT:PR", "1|2:2.25", "1:100"),
    s.row("2", 9, "n" * 40, "N" * 300, ".", 12.5, ".", "SVLEN=-1;AC=1,2,.", "GT:VL", "0/0:70000", ".:."),
]


def test_records_survive_encoding():
    names = header_names(HEADER)
    for line in LINES:
        data = encode_line(line, names)
        n_shared, n_single = struct.unpack("<II", data[:8])
        assert len(data) == 8 + n_shared + n_single
        assert decode_record(data[8 : 8 + n_shared], data[8 + n_shared :], names) == line


def test_dictionary_positions_may_be_given():
    names = header_names(['##FILTER=<ID=PASS,Description="x",IDX=0>', "##INFO=<ID=B,Number=1,Type=Integer,IDX=2>", "##INFO=<ID=A,Number=0,Type=Flag,IDX=1>"])
    assert names.strings == ["PASS", "A", "B"] and names.types["INFO", "A"] == "Flag"


def test_tools_read_and_write_bcf(spark, write, tmp_path):
    rows = [
        s.row("1", 1000 * (i + 1), ".", "A", "<DEL>", 0, "PASS", f"SVTYPE=DEL;CHR2=1;END={1000 * (i + 1) + 500};CT=3to5", "GT", "0/1") for i in range(20)
    ]
    source = write("in.vcf", [*s.vcf_header(["smp"]), *rows])
    binary, text, back = (str(tmp_path / n) for n in ("a.bcf", "a.vcf", "b.vcf"))
    tools.standardize(spark, source, binary, "delly", single_file=True)
    tools.standardize(spark, source, text, "delly", single_file=True)
    with open(text) as handle:
        lines = handle.read().splitlines()
    assert bcf_header(binary) == [line for line in lines if line.startswith("#")]
    got = [r["raw"] for r in read_variants(spark, binary).orderBy("seq").collect()]
    assert got == [line for line in lines if not line.startswith("#")]
    tools.cluster(spark, [binary], back, single_file=True)
    with open(back) as handle:
        assert sum(not line.startswith("#") for line in handle) == 20
