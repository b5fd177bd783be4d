"""Blocked gzip: small independent blocks, addressed by (file offset of a block, offset inside it)."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

#: Payload per written block, as usual below the limit of 64 KiB.
BLOCK_PAYLOAD = 0xFF00
# Fixed value of the format: the empty block that ends a file.
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def read_block(handle: BinaryIO) -> tuple[bytes, int] | None:
    """Payload and stored size of the block at the current position, None at the end of the file."""
    head = handle.read(12)
    if len(head) < 12:
        return None
    if head[:4] != b"\x1f\x8b\x08\x04":
        raise ValueError("not a blocked gzip file")
    extra = handle.read(struct.unpack("<H", head[10:12])[0])
    at, size = 0, None
    while at < len(extra):
        tag, length = extra[at : at + 2], struct.unpack("<H", extra[at + 2 : at + 4])[0]
        if tag == b"BC":
            size = struct.unpack("<H", extra[at + 4 : at + 6])[0] + 1
        at += 4 + length
    if size is None:
        raise ValueError("gzip block without a size")
    body = handle.read(size - 12 - len(extra))
    return zlib.decompress(body[:-8], -15), size


def make_block(payload: bytes) -> bytes:
    """One block holding ``payload``."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(payload) + packer.flush()
    size = len(body) + 25
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", size)
    return head + body + struct.pack("<II", zlib.crc32(payload), len(payload))


class BlockStream:
    """Bytes of a blocked gzip file from a virtual offset on; ``place`` is the offset of the next byte."""

    def __init__(self, handle: BinaryIO, offset: int = 0):
        self._handle = handle
        self._block_at = offset >> 16
        handle.seek(self._block_at)
        self._data, self._at, self._size = b"", offset & 0xFFFF, 0
        self._load()

    def _load(self) -> bool:
        found = read_block(self._handle)
        if found is None:
            self._data, self._size = b"", 0
            return False
        self._data, self._size = found
        return True

    @property
    def place(self) -> int:
        """Virtual offset of the next byte."""
        if self._at >= len(self._data) and self._size:
            return (self._block_at + self._size) << 16
        return self._block_at << 16 | self._at

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes; fewer only at the end of the file."""
        pieces = []
        while n > 0:
            piece = self._data[self._at : self._at + n]
            if piece:
                pieces.append(piece)
                self._at += len(piece)
                n -= len(piece)
                continue
            if not self._size:
                break
            self._block_at += self._size
            self._at = 0
            self._load()
        return b"".join(pieces)


def blocks(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Pack a stream of byte strings into blocks."""
    pending = bytearray()
    for chunk in chunks:
        pending += chunk
        while len(pending) >= BLOCK_PAYLOAD:
            yield make_block(bytes(pending[:BLOCK_PAYLOAD]))
            del pending[:BLOCK_PAYLOAD]
    if pending:
        yield make_block(bytes(pending))
