"""Digest and record count of a data file in one pass over its bytes (used inside tasks).

The digest is fed with the bytes as stored, a record counter with the decoded ones. Records are those of Spark's
line-based CSV reader with the settings of a read: lines, ended by LF, CR LF or CR, that hold a character above
the space (a quote never joins lines); a byte-order mark that begins the file is no character. A file that
cannot be decoded to its end has the records whose line ends come before the damage.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of content taken at a time, and bytes decoded at a time.
CHUNK, DECODED = 1 << 20, 4 << 20
BOM = b"\xef\xbb\xbf"


class RecordCounter:
    """Non-blank lines of a byte stream that comes in pieces."""

    def __init__(self):
        self.records = 0
        self._ink = False  # the line begun has a character above the space
        self._start: bytes | None = b""

    def feed(self, data: bytes) -> None:
        if self._start is not None:
            data, self._start = self._start + data, None
            if len(data) < len(BOM) and BOM.startswith(data):
                self._start = data
                return
            data = data.removeprefix(BOM)
        if not data:
            return
        raw = np.frombuffer(data, np.uint8)
        ink = np.cumsum(raw > 0x20, dtype=np.int64)
        ends = np.flatnonzero((raw == 0x0A) | (raw == 0x0D))
        if not len(ends):
            self._ink |= bool(ink[-1])
            return
        at = ink[ends]
        self.records += int(self._ink or at[0] > 0) + int((at[1:] > at[:-1]).sum())
        self._ink = bool(ink[-1] > at[-1])

    def finish(self, whole: bool) -> int:
        """All records; the last line of a whole stream needs no end."""
        if self._start:
            self._start, held = None, self._start
            self._ink = held != BOM
        return self.records + int(whole and self._ink)


class DamagedFile(ValueError):
    """The bytes cannot be decoded any further."""


class _Input:
    """Bytes that come in pieces, taken in any sizes."""

    def __init__(self, chunks: Iterable[bytes]):
        self._chunks, self.held = iter(chunks), b""

    def more(self) -> bool:
        piece = next(self._chunks, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise DamagedFile("the file ends too early")
        out, self.held = self.held[:n], self.held[n:]
        return out

    def through_zero(self) -> bytes:
        while (at := self.held.find(b"\0")) < 0:
            if not self.more():
                raise DamagedFile("the file ends too early")
        return self.take(at + 1)


def _skip_header(data: _Input) -> None:
    """One gzip header (RFC 1952)."""
    read = data.take(10)
    flags = read[3]
    if read[:3] != b"\x1f\x8b\x08" or flags & 0xE0:
        raise DamagedFile("no gzip header")
    if flags & 4:
        size = data.take(2)
        read += size + data.take(int.from_bytes(size, "little"))
    for flag in (8, 16):
        if flags & flag:
            read += data.through_zero()
    if flags & 2 and data.take(2) != (zlib.crc32(read) & 0xFFFF).to_bytes(2, "little"):
        raise DamagedFile("wrong check sum of the header")


def _inflated(decoder, data: bytes) -> Iterator[bytes]:
    """What ``decoder`` makes of ``data``; with damage, all that comes before it."""
    before = decoder.copy()
    try:
        out = [decoder.decompress(data, DECODED)]
        while decoder.unconsumed_tail:
            out.append(decoder.decompress(decoder.unconsumed_tail, DECODED))
    except zlib.error as e:
        for i in range(len(data)):
            try:
                yield before.decompress(data[i:i + 1])
            except zlib.error:
                break
        raise DamagedFile(str(e)) from e
    yield from out


def gunzipped(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Decoded bytes of all members of a gzip file."""
    data = _Input(chunks)
    while data.held or data.more():
        _skip_header(data)
        decoder, crc, size = zlib.decompressobj(-zlib.MAX_WBITS), 0, 0
        while not decoder.eof:
            if not data.held and not data.more():
                raise DamagedFile("the file ends too early")
            piece, data.held = data.held, b""
            for out in _inflated(decoder, piece):
                crc, size = zlib.crc32(out, crc), size + len(out)
                yield out
        data.held = decoder.unused_data
        if data.take(8) != crc.to_bytes(4, "little") + (size & 0xFFFFFFFF).to_bytes(4, "little"):
            raise DamagedFile("wrong check sum")


def checked(chunks: Iterable[bytes], gzipped: bool) -> tuple[str, int, int]:
    """(MD5, bytes, records) of a file whose content comes in pieces."""
    digest, counter, size = hashlib.md5(), RecordCounter(), 0

    def hashed():
        nonlocal size
        for c in chunks:
            digest.update(c)
            size += len(c)
            yield c

    stream = hashed()
    whole = True
    try:
        for part in gunzipped(stream) if gzipped else stream:
            counter.feed(part)
    except DamagedFile:
        whole = False
    for _ in stream:  # the digest is that of all bytes
        pass
    return digest.hexdigest(), size, counter.finish(whole)


def pieces(content) -> Iterator[bytes]:
    """The bytes of a buffer, some at a time."""
    view = memoryview(content)
    for lo in range(0, len(view), CHUNK):
        yield bytes(view[lo:lo + CHUNK])
