"""BAM codec and data source."""

import struct

import samples as s

from riftspan import tools
from riftspan.plans.library import LibraryProperties
from riftspan.sources.bam import bam_header, decode_record, encode_line, read_bam_lines
from riftspan.sources.bgzf import BlockStream, blocks

LIBRARY = LibraryProperties(max_rlen=100, median_isize=300.0, std_dev_isize=10.0, max_normal_isize=330)
HEADER = s.sam_header(extra=["@RG\tID:a\tSM:x"])


def many_reads(n=3000):
    tags = ("xI:i:7", "RG:Z:a", "ZZ:B:S,1,2,3", "AA:A:q", "ff:f:0.5")
    return [s.read(f"t{i // 2}", 99 if i % 2 == 0 else 147, "alpha", 100 + i, "20S79M1I", "=", 300, 300, mapq=i % 60, bases=100, tags=tags) for i in range(n)]


def test_records_survive_encoding():
    odd = s.read("u", 4, "*", 0, "*", bases=5).replace("A" * 5, "ACGTN")
    for line in [*many_reads(3), odd, s.CASES["chimera"][0][2]]:
        data = encode_line(line, {"alpha": 0, "beta": 1})
        assert struct.unpack("<i", data[:4])[0] == len(data) - 4
        assert decode_record(data[4:], ["alpha", "beta"]) == line


def test_block_stream_resumes_at_virtual_offsets(tmp_path):
    payload = bytes(i * 7 % 251 for i in range(200_000))
    path = tmp_path / "x.gz"
    path.write_bytes(b"".join(blocks(iter([payload]))))
    with open(path, "rb") as handle:
        stream = BlockStream(handle)
        stream.read(150_001)
        place = stream.place
        assert BlockStream(handle, place).read(100) == payload[150_001:150_101]


def write_index(path, offsets):
    """An index with one bin whose chunks start at the given offsets."""
    chunks = b"".join(struct.pack("<QQ", o, o) for o in offsets)
    (path.parent / (path.name + ".bai")).write_bytes(
        b"BAI\1" + struct.pack("<i", 1) + struct.pack("<i", 1) + struct.pack("<Ii", 4681, len(offsets)) + chunks + struct.pack("<i", 0)
    )


def test_tools_read_and_write_bam(spark, write, tmp_path):
    lines = many_reads()
    sam = write("in.sam", [*HEADER, *lines])
    bam = tmp_path / "out.bam"
    tools.scan(spark, sam, str(bam), library=LIBRARY, single_file=True)
    assert bam_header(str(bam))[0] == "@HD\tVN:1.6\tSO:unordered"
    back = [r["value"] for r in read_bam_lines(spark, str(bam)).orderBy("file_ord", "block", "seq").collect()]
    assert back == lines

    # With an index the same rows come from several tasks.
    places = []
    with open(bam, "rb") as handle:
        from riftspan.sources.bam import _read_head

        stream = BlockStream(handle)
        _read_head(stream)
        for i in range(len(lines)):
            if i % 500 == 0:
                places.append(stream.place)
            stream.read(struct.unpack("<i", stream.read(4))[0])
    write_index(bam, places)
    parts = read_bam_lines(spark, str(bam), split_bytes=1)
    assert parts.rdd.getNumPartitions() > 1
    assert [r["value"] for r in parts.orderBy("file_ord", "block", "seq").collect()] == lines

    again = tmp_path / "again.sam"
    tools.unique(spark, str(bam), str(again), single_file=True)
    with open(again) as handle:
        rows = [line for line in handle.read().splitlines() if not line.startswith("@")]
    assert rows[0] == lines[0] + "\txI:i:0" and len(rows) == len(lines)
