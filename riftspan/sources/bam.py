"""Binary BAM files as Spark data source and sink.

The codec turns records into SAM lines and back; everything else is shared with SAM text. With a
``.bai`` index next to the file, tasks read separate stretches that start at indexed records.
Without one, record boundaries are unknown and a file is read by one task, many files by many.
"""

from __future__ import annotations

import os
import shutil
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from riftspan.errors import MalformedRecord, OutputExists
from riftspan.sources.bgzf import END_BLOCK, BlockStream, blocks

# Fixed values of the format.
_MAGIC = b"BAM\1"
_BASES = "=ACMGRSVTWYHKDBN"
_CIGAR = "MIDNSHP=X"
_SCALARS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}

#: Stored bytes one task should read.
SPLIT_BYTES = 64 * 1024 * 1024
_PAIRS = [a + b for a in _BASES for b in _BASES]


def _read_head(stream: BlockStream) -> tuple[list[str], list[tuple[str, int]]]:
    if stream.read(4) != _MAGIC:
        raise MalformedRecord("not a BAM file")
    text = stream.read(struct.unpack("<i", stream.read(4))[0]).rstrip(b"\0").decode()
    refs = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0]).rstrip(b"\0").decode()
        refs.append((name, struct.unpack("<i", stream.read(4))[0]))
    lines = text.splitlines()
    if not any(line.startswith("@SQ") for line in lines):
        lines += [f"@SQ\tSN:{n}\tLN:{k}" for n, k in refs]
    return lines, refs


def bam_header(path: str) -> list[str]:
    """Header lines; reference sequences missing from the text are added from the binary list."""
    with open(path, "rb") as handle:
        return _read_head(BlockStream(handle))[0]


def _tags(data: bytes) -> list[str]:
    found, at = [], 0
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind == "A":
            found.append(f"{name}:A:{chr(data[at])}")
            at += 1
        elif kind in "ZH":
            stop = data.index(0, at)
            found.append(f"{name}:{kind}:{data[at:stop].decode()}")
            at = stop + 1
        elif kind == "B":
            item = chr(data[at])
            n = struct.unpack_from("<i", data, at + 1)[0]
            size = struct.calcsize(_SCALARS[item])
            values = [struct.unpack_from(_SCALARS[item], data, at + 5 + i * size)[0] for i in range(n)]
            found.append(f"{name}:B:{item}," + ",".join(f"{v:g}" if item == "f" else str(v) for v in values))
            at += 5 + n * size
        else:
            value = struct.unpack_from(_SCALARS[kind], data, at)[0]
            found.append(f"{name}:f:{value:g}" if kind == "f" else f"{name}:i:{value}")
            at += struct.calcsize(_SCALARS[kind])
    return found


def decode_record(data: bytes, names: list[str]) -> str:
    """SAM line of a record."""
    tid, pos, name_len, mapq, _, n_ops, flag, n_bases, mtid, mpos, tlen = struct.unpack_from("<iiBBHHHiiii", data)
    at = 32 + name_len
    ops = struct.unpack_from(f"<{n_ops}I", data, at)
    cigar = "".join(f"{op >> 4}{_CIGAR[op & 15]}" for op in ops) or "*"
    at += 4 * n_ops
    packed = data[at : at + (n_bases + 1) // 2]
    bases = "".join([_PAIRS[b] for b in packed])[:n_bases] or "*"
    at += len(packed)
    raw_quality = data[at : at + n_bases]
    quality = "*" if not raw_quality or raw_quality[0] == 255 else bytes(q + 33 for q in raw_quality).decode()
    at += n_bases
    contig = names[tid] if tid >= 0 else "*"
    mate = "*" if mtid < 0 else "=" if mtid == tid else names[mtid]
    name = data[32 : 32 + name_len - 1].decode()
    fields = [name, flag, contig, pos + 1, mapq, cigar, mate, mpos + 1, tlen, bases, quality, *_tags(data[at:])]
    return "\t".join(map(str, fields))


def _bin_of(start: int, end: int) -> int:
    """Index bin of a stretch: the smallest of the nested bins that holds it."""
    end -= 1
    for shift, offset in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end >> shift:
            return offset + (start >> shift)
    return 0


def _encode_tag(text: str) -> bytes:
    name, kind, value = text.split(":", 2)
    head = name.encode()
    if kind == "i":
        return head + b"i" + struct.pack("<i", int(value)) if int(value) < 2**31 else head + b"I" + struct.pack("<I", int(value))
    if kind == "f":
        return head + b"f" + struct.pack("<f", float(value))
    if kind == "A":
        return head + b"A" + value.encode()
    if kind == "B":
        item, *values = value.split(",")
        convert = float if item == "f" else int
        packed = b"".join(struct.pack(_SCALARS[item], convert(v)) for v in values)
        return head + b"B" + item.encode() + struct.pack("<i", len(values)) + packed
    return head + kind.encode() + value.encode() + b"\0"


def encode_line(line: str, tids: dict[str, int]) -> bytes:
    """Record of a SAM line, with its leading length."""
    f = line.split("\t")
    tid = tids.get(f[2], -1)
    mtid = tid if f[6] == "=" else tids.get(f[6], -1)
    pos, ops, number, consumed = int(f[3]) - 1, [], "", 0
    for c in f[5] if f[5] != "*" else "":
        if c.isdigit():
            number += c
        else:
            ops.append(int(number) << 4 | _CIGAR.index(c))
            consumed += int(number) if c in "MDN=X" else 0
            number = ""
    bases = "" if f[9] == "*" else f[9].upper()
    codes = [max(_BASES.find(b), 0) if b in _BASES else 15 for b in bases]
    if len(codes) % 2:
        codes.append(0)
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
    quality = bytes(ord(q) - 33 for q in f[10]) if f[10] != "*" else b"\xff" * len(bases)
    name = f[0].encode() + b"\0"
    # Unplaced records use the bin of position -1.
    bin_no = _bin_of(pos, pos + max(consumed, 1)) if pos >= 0 else 4680
    head = struct.pack(
        "<iiBBHHHiiii", tid, pos, len(name), int(f[4]), bin_no, len(ops), int(f[1]), len(bases), mtid, int(f[7]) - 1, int(f[8])
    )
    body = head + name + struct.pack(f"<{len(ops)}I", *ops) + packed + quality + b"".join(_encode_tag(t) for t in f[11:])
    return struct.pack("<i", len(body)) + body


def _encoded_header(header: list[str]) -> bytes:
    from riftspan.sources.headers import alignment_contigs

    text = "".join(line + "\n" for line in header).encode()
    refs = alignment_contigs(header)
    packed = _MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs))
    for ref in refs:
        name = ref.name.encode() + b"\0"
        packed += struct.pack("<i", len(name)) + name + struct.pack("<i", ref.length)
    return packed


def _indexed_offsets(path: str) -> list[int]:
    """Virtual offsets at which records start, from the index; none without an index."""
    for name in (path + ".bai", path[:-4] + ".bai"):
        if os.path.exists(name):
            break
    else:
        return []
    with open(name, "rb") as handle:
        data = handle.read()
    offsets, at = set(), 8
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        n_bins = struct.unpack_from("<i", data, at)[0]
        at += 4
        for _ in range(n_bins):
            number, n_chunks = struct.unpack_from("<Ii", data, at)
            at += 8
            if number != 37450:  # this bin number holds statistics instead of chunks
                offsets.update(struct.unpack_from("<Q", data, at + 16 * i)[0] for i in range(n_chunks))
            at += 16 * n_chunks
        n_linear = struct.unpack_from("<i", data, at)[0]
        at += 4 + 8 * n_linear
    return sorted(offsets)


@dataclass
class _Stretch(InputPartition):
    """Virtual offsets between which a task reads."""

    start: int
    stop: int | None


class _BamReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def partitions(self) -> list[_Stretch]:
        with open(self.path, "rb") as handle:
            stream = BlockStream(handle)
            _read_head(stream)
            first = stream.place
        cuts = [first]
        for offset in _indexed_offsets(self.path):
            if (offset >> 16) - (cuts[-1] >> 16) >= self.split_bytes:
                cuts.append(offset)
        return [_Stretch(a, b) for a, b in zip(cuts, [*cuts[1:], None])]

    def read(self, partition: _Stretch) -> Iterator[tuple]:
        with open(self.path, "rb") as handle:
            names = [name for name, _ in _read_head(BlockStream(handle))[1]]
            stream = BlockStream(handle, partition.start)
            seq = 0
            while partition.stop is None or stream.place < partition.stop:
                size = stream.read(4)
                if len(size) < 4:
                    return
                yield partition.start, seq, decode_record(stream.read(struct.unpack("<i", size)[0]), names)
                seq += 1


@dataclass
class _Part(WriterCommitMessage):
    number: int
    name: str


class _BamWriter(DataSourceWriter):
    """Tasks write numbered parts; the driver gives them their final names, so retries leave nothing behind."""

    def __init__(self, folder: str, header: list[str]):
        self.folder, self.header = folder, header

    def write(self, iterator: Iterator) -> _Part:
        from riftspan.sources.headers import alignment_contigs

        tids = {c.name: i for i, c in enumerate(alignment_contigs(self.header))}
        name = f"_try-{uuid.uuid4().hex}"
        with open(os.path.join(self.folder, name), "wb") as target:
            for block in blocks(encode_line(row[0], tids) for row in iterator):
                target.write(block)
        return _Part(TaskContext.get().partitionId(), name)

    def commit(self, messages: list[_Part | None]) -> None:
        for part in messages:
            if part is not None:
                os.rename(os.path.join(self.folder, part.name), os.path.join(self.folder, f"part-{part.number + 1:08d}.bgzf"))
        with open(os.path.join(self.folder, "part-00000000.bgzf"), "wb") as target:
            target.writelines(blocks(iter([_encoded_header(self.header)])))
        with open(os.path.join(self.folder, "part-99999999.bgzf"), "wb") as target:
            target.write(END_BLOCK)

    def abort(self, messages: list[_Part | None]) -> None:
        return None


class BamSource(DataSource):
    """``spark.read.format("riftspan_bam").load(path)`` gives SAM lines with their order."""

    @classmethod
    def name(cls) -> str:
        return "riftspan_bam"

    def schema(self) -> str:
        return "start bigint, seq bigint, value string"

    def reader(self, schema) -> _BamReader:
        return _BamReader(self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> _BamWriter:
        return _BamWriter(self.options["path"], self.options["header"].split("\n"))


def read_bam_lines(spark: SparkSession, path: str, file_ord: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """SAM lines of a BAM file with the order columns."""
    spark.dataSource.register(BamSource)
    rows = spark.read.format("riftspan_bam").option("split_bytes", str(split_bytes)).load(os.path.abspath(path))
    return rows.select(
        F.lit(file_ord).alias("file_ord"),
        F.struct(F.lit(path).alias("file"), F.col("start")).alias("block"),
        "seq",
        "value",
    )


def write_bam(
    rows: DataFrame, line: Column, order: list[Column | str], header: list[str], path: str, overwrite: bool = False, single_file: bool = False
) -> None:
    """Write a BAM file as a folder of parts that can be concatenated, or as one file."""
    spark = rows.sparkSession
    spark.dataSource.register(BamSource)
    if os.path.exists(path):
        if not overwrite:
            raise OutputExists(path)
        shutil.rmtree(path) if os.path.isdir(path) else os.remove(path)
    folder = path + ".parts" if single_file else path
    os.makedirs(folder)
    keys = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    lines = rows.select(*keys, line.alias("value")).orderBy(*[f"_o{i}" for i in range(len(keys))]).select("value")
    lines.write.format("riftspan_bam").mode("append").option("header", "\n".join(header)).save(os.path.abspath(folder))
    if single_file:
        with open(path, "wb") as target:
            for name in sorted(n for n in os.listdir(folder) if n.startswith("part-")):
                with open(os.path.join(folder, name), "rb") as source:
                    shutil.copyfileobj(source, target)
        shutil.rmtree(folder)

