"""Reading parts of remote files: byte ranges through a cache of blocks, members of a zip without the rest, whole files.

A source is a function range(a, b) that gives the bytes [a, b) of something of known size.
"""

from __future__ import annotations

import os
import struct
import urllib.request
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

Range = Callable[[int, int], bytes]


class Blocks:
    """A source read in blocks, the latest of which are kept, so that many small reads take few requests."""

    def __init__(self, range_: Range, size: int, block: int = 1 << 20, kept: int = 8):
        self._range, self.size, self._block, self._kept = range_, size, block, kept
        self._cache: OrderedDict[int, bytes] = OrderedDict()

    def _at(self, number: int) -> bytes:
        if number in self._cache:
            self._cache.move_to_end(number)
        else:
            a = number * self._block
            self._cache[number] = self._range(a, min(self.size, a + self._block))
            while len(self._cache) > self._kept:
                self._cache.popitem(last=False)
        return self._cache[number]

    def pieces(self, a: int, b: int) -> Iterator[bytes]:
        """The bytes [a, b), as far as there are such, a block at a time."""
        a, b = max(a, 0), min(b, self.size)
        while a < b:
            number, inside = divmod(a, self._block)
            piece = self._at(number)[inside : inside + b - a]
            if not piece:
                raise OSError(f"the source ended at byte {a} of {self.size}")
            yield piece
            a += len(piece)

    def read(self, a: int, b: int) -> bytes:
        return b"".join(self.pieces(a, b))


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int


def directory(source: Blocks) -> dict[str, Member]:
    """Members of a zip by name, from its central directory alone; archives and members beyond 4 GB too."""
    for reach in (1024, 65_557):  # the end is followed by a comment, of 65,535 bytes at most
        tail_at = max(0, source.size - reach)
        tail = source.read(tail_at, source.size)
        end = tail.rfind(b"PK\x05\x06")
        if end >= 20 or end == tail_at == 0:
            break
    else:
        raise ValueError("not a zip archive")
    length, start = struct.unpack_from("<II", tail, end + 12)
    if 0xFFFFFFFF in (length, start):
        (where,) = struct.unpack("<Q", source.read(tail_at + end - 12, tail_at + end - 4))
        length, start = struct.unpack("<QQ", source.read(where + 40, where + 56))
    listing, at, out = source.read(start, start + length), 0, {}
    while at + 46 <= len(listing) and listing[at : at + 4] == b"PK\x01\x02":
        flags, method = struct.unpack_from("<HH", listing, at + 8)
        crc, packed, size, n_name, n_extra, n_comment = struct.unpack_from("<IIIHHH", listing, at + 16)
        (header,) = struct.unpack_from("<I", listing, at + 42)
        name = listing[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = listing[at + 46 + n_name : at + 46 + n_name + n_extra]
        wide = _wide_numbers(extra)
        # numbers that don't fit stand in the extra field, in this order
        size, packed, header = (next(wide) if v == 0xFFFFFFFF else v for v in (size, packed, header))
        out[name] = Member(name, method, crc, packed, size, header)
        at += 46 + n_name + n_extra + n_comment
    return out


def _wide_numbers(extra: bytes) -> Iterator[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            yield from struct.unpack_from(f"<{n // 8}Q", extra, at + 4)
        at += 4 + n


def member_bytes(source: Blocks, member: Member) -> Iterator[bytes]:
    """A member's content, unpacked piece by piece and checked by its length and CRC."""
    n_name, n_extra = struct.unpack("<HH", source.read(member.header + 26, member.header + 30))
    first = member.header + 30 + n_name + n_extra
    if member.method not in (0, 8):
        raise ValueError(f"{member.name} is packed by method {member.method}")
    unpack = zlib.decompressobj(-15) if member.method == 8 else None
    crc = n = 0
    for piece in source.pieces(first, first + member.packed):
        piece = unpack.decompress(piece) if unpack else piece
        crc, n = zlib.crc32(piece, crc), n + len(piece)
        yield piece
    if (crc, n) != (member.crc, member.size):
        raise OSError(f"{member.name} is damaged")


def write_whole(pieces: Iterator[bytes], to: str | os.PathLike) -> Path:
    """A file that appears with all of its pieces or not at all."""
    to = Path(to)
    unfinished = to.parent / f".{to.name}.{os.getpid()}"
    try:
        with unfinished.open("wb") as out:
            out.writelines(pieces)
        return unfinished.rename(to)
    finally:
        unfinished.unlink(missing_ok=True)


def extract(source: Blocks, name: str, to: str | os.PathLike) -> Path:
    """One member of a zip as a file; the bytes of the others aren't fetched."""
    found = directory(source)
    if name not in found:
        raise KeyError(f"no member {name!r}; there are {', '.join(sorted(found))}")
    return write_whole(member_bytes(source, found[name]), to)


def http(url: str, timeout: float = 60) -> Blocks:
    """A source behind a server that answers range requests."""

    def ask(a: int, b: int):
        return urllib.request.urlopen(urllib.request.Request(url, headers={"Range": f"bytes={a}-{b - 1}"}), timeout=timeout)

    with ask(0, 1) as answer:
        total = (answer.headers.get("Content-Range") or "").rpartition("/")[2]
        if answer.status != 206 or not total.isdigit():
            raise OSError(f"{url} doesn't answer range requests")

    def range_(a: int, b: int) -> bytes:
        with ask(a, b) as part:
            data = part.read()
        if len(data) != b - a:
            raise OSError(f"{url} gave {len(data)} of {b - a} bytes")
        return data

    return Blocks(range_, int(total))


def download(url: str, to: str | os.PathLike, timeout: float = 60) -> Path:
    """A whole file, which appears when all of it has come."""
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        wanted = answer.headers.get("Content-Length")

        def pieces() -> Iterator[bytes]:
            n = 0
            for piece in iter(lambda: answer.read(1 << 20), b""):
                n += len(piece)
                yield piece
            if wanted is not None and n != int(wanted):
                raise OSError(f"{url} gave {n} of {wanted} bytes")

        return write_whole(pieces(), to)
