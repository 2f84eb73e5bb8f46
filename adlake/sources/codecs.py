"""Streams of the block formats that Spark's own compression codecs write, read in plain Python.

Each decoder is a generator of plain blocks over a file; files that were written one after
the other into one are read on. A file that ends within a block raises EOFError, and one that
isn't of the format ValueError. Arrow decompresses the raw blocks; it has no LZF, which is
a dozen lines.
"""
from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator
from typing import BinaryIO

# --- Fixed values of the formats -----------------------------------------------------------
# LZ4 block stream: magic, a token whose high half is the method, then compressed and plain length
# and a checksum, little-endian.  Snappy framed stream: magic and two version numbers, then
# big-endian lengths.  LZF: "ZV", 0 (plain) or 1 (compressed), big-endian lengths.
LZ4_MAGIC, LZ4_PLAIN, LZ4_PACKED = b"LZ4Block", 0x10, 0x20
SNAPPY_MAGIC = b"\x82SNAPPY\x00"
LZF_MAGIC, LZF_PLAIN, LZF_PACKED = b"ZV", 0, 1
# ---------------------------------------------------------------------------------------------


def _exactly(file: BinaryIO, n: int) -> bytes:
    data = file.read(n)
    if len(data) != n:
        raise EOFError("the stream ends within a block")
    return data


def lz4_blocks(file: BinaryIO) -> Iterator[bytes]:
    import pyarrow as pa
    while magic := file.read(len(LZ4_MAGIC)):
        if magic != LZ4_MAGIC:
            raise ValueError("no LZ4 block where one should start")
        token, packed, plain, _ = struct.unpack("<Biii", _exactly(file, 13))
        data = _exactly(file, packed)
        if token & 0xF0 not in (LZ4_PLAIN, LZ4_PACKED):
            raise ValueError(f"unknown LZ4 method {token & 0xF0:#x}")
        if plain:  # a block of nothing ends a stream
            yield data if token & 0xF0 == LZ4_PLAIN else pa.decompress(data, decompressed_size=plain, codec="lz4_raw", asbytes=True)


def _varint(data: bytes) -> int:
    value = 0
    for k, byte in enumerate(data[:5]):
        value |= (byte & 0x7F) << 7 * k
        if byte < 0x80:
            return value
    raise ValueError("no Snappy block where one should start")


def snappy_blocks(file: BinaryIO) -> Iterator[bytes]:
    import pyarrow as pa
    started = False
    while head := file.read(4):
        if head == SNAPPY_MAGIC[:4]:
            if _exactly(file, 12)[:4] != SNAPPY_MAGIC[4:]:
                raise ValueError("not a Snappy stream")
            started = True
            continue
        if not started or len(head) != 4:
            raise ValueError("not a Snappy stream") if not started else EOFError("the stream ends within a block")
        data = _exactly(file, int.from_bytes(head, "big"))
        yield pa.decompress(data, decompressed_size=_varint(data), codec="snappy", asbytes=True)


def lzf_block(data: bytes, size: int) -> bytes:
    """A control byte below 32 announces that many bytes and one; else its high bits are a length and its low ones,
    with the next byte, how far back to copy from."""
    out, at = bytearray(), 0
    while at < len(data):
        control = data[at]
        at += 1
        if control < 32:
            out += data[at:at + control + 1]
            at += control + 1
            continue
        length = control >> 5
        if length == 7:
            length += data[at]
            at += 1
        start = len(out) - ((control & 31) << 8 | data[at]) - 1
        at += 1
        if start < 0:
            raise ValueError("an LZF copy from before the block")
        for k in range(start, start + length + 2):  # may run into what it writes
            out.append(out[k])
    if len(out) != size:
        raise ValueError("an LZF block of another length than it declares")
    return bytes(out)


def lzf_blocks(file: BinaryIO) -> Iterator[bytes]:
    while head := file.read(3):
        if len(head) != 3:
            raise EOFError("the stream ends within a block")
        if head[:2] != LZF_MAGIC or head[2] not in (LZF_PLAIN, LZF_PACKED):
            raise ValueError("no LZF block where one should start")
        size = int.from_bytes(_exactly(file, 2), "big")
        if head[2] == LZF_PLAIN:
            yield _exactly(file, size)
        else:
            plain = int.from_bytes(_exactly(file, 2), "big")
            yield lzf_block(_exactly(file, size), plain)


class BlockStream(io.RawIOBase):
    """The plain bytes of a stream of blocks, one block held at a time."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.held = blocks, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.held:
            block = next(self.blocks, None)
            if block is None:
                return 0
            self.held = memoryview(block)
        n = min(len(into), len(self.held))
        into[:n] = self.held[:n]
        self.held = self.held[n:]
        return n


def _zstd(file: BinaryIO):
    import zstandard
    return zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True)


def _blocks(decoder: Callable[[BinaryIO], Iterator[bytes]]):
    return lambda file: io.BufferedReader(BlockStream(decoder(file)))


#: Openers by the ending that Spark gives a file.
OPENERS = {".zstd": _zstd, ".lz4": _blocks(lz4_blocks), ".snappy": _blocks(snappy_blocks), ".lzf": _blocks(lzf_blocks)}
