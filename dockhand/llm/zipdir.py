"""The directory of a ZIP archive, read by ranges.

Only the end of the file, the central directory and one local header per wanted member are
read.  Archives over 4 GB or 65,535 members keep their numbers in ZIP64 records.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from typing import NamedTuple

# Signatures and layouts of the ZIP records.
_END = struct.Struct("<4s4H2LH")
_END_SIGNATURE = b"PK\x05\x06"
_END64_LOCATOR = struct.Struct("<4sLQL")
_END64_LOCATOR_SIGNATURE = b"PK\x06\x07"
_END64 = struct.Struct("<4sQ2H2L4Q")
_END64_SIGNATURE = b"PK\x06\x06"
_ENTRY = struct.Struct("<4s6H3L5H2L")
_ENTRY_SIGNATURE = b"PK\x01\x02"
_LOCAL = struct.Struct("<4s5H3L2H")
_LOCAL_SIGNATURE = b"PK\x03\x04"
_ZIP64_EXTRA = 1
_UTF8_FLAG = 0x800
_ENCRYPTED_FLAG = 0x1
_MAX_COMMENT = 65535
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF

Read = Callable[[int, int], bytes]
"""Bytes from a place in the file, by place and number."""


class ZipError(ValueError):
    """An archive that is damaged or of an unsupported kind."""


class Member(NamedTuple):
    name: str
    method: int
    crc32: int
    compressed_size: int
    size: int
    header: int

    @property
    def stored(self) -> bool:
        return self.method == 0


def _unpack(layout: struct.Struct, data: bytes, at: int, signature: bytes) -> tuple:
    if at < 0 or len(data) < at + layout.size or data[at:at + 4] != signature:
        raise ZipError(f"no record {signature!r} where one must be")
    return layout.unpack_from(data, at)


def _directory(read: Read, size: int) -> tuple[int, int, int]:
    """Place, size and number of entries of the central directory."""
    tail_size = min(size, _END.size + _MAX_COMMENT + _END64_LOCATOR.size)
    tail = read(size - tail_size, tail_size)
    at = tail.rfind(_END_SIGNATURE)
    while at >= 0:
        fields = _END.unpack_from(tail, at) if len(tail) >= at + _END.size else None
        if fields and at + _END.size + fields[7] == len(tail):
            break
        at = tail.rfind(_END_SIGNATURE, 0, at)
    if at < 0:
        raise ZipError("no end of a central directory")
    count, length, place = fields[4], fields[5], fields[6]
    if count == _FULL16 or _FULL32 in (length, place):
        locator = _unpack(_END64_LOCATOR, tail, at - _END64_LOCATOR.size, _END64_LOCATOR_SIGNATURE)
        end64 = _unpack(_END64, read(locator[2], _END64.size), 0, _END64_SIGNATURE)
        count, length, place = end64[7], end64[8], end64[9]
    if place + length > size:
        raise ZipError("the central directory lies outside the file")
    return place, length, count


def _wide(extra: bytes, numbers: list[int]) -> list[int]:
    """The numbers, those that are full taken from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == _ZIP64_EXTRA:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            try:
                return [next(wide) if n == _FULL32 else n for n in numbers]
            except StopIteration as e:
                raise ZipError("a ZIP64 field is too short") from e
        at += 4 + length
    if _FULL32 in numbers:
        raise ZipError("a ZIP64 field is missing")
    return numbers


def members(read: Read, size: int) -> list[Member]:
    """All members of the archive, in the order of its central directory."""
    place, length, count = _directory(read, size)
    data, at, found = read(place, length), 0, []
    for _ in range(count):
        entry = _unpack(_ENTRY, data, at, _ENTRY_SIGNATURE)
        flags, method, crc = entry[3], entry[4], entry[7]
        name_size, extra_size, comment_size = entry[10], entry[11], entry[12]
        name_at = at + _ENTRY.size
        name = data[name_at:name_at + name_size].decode("utf-8" if flags & _UTF8_FLAG else "cp437")
        extra = data[name_at + name_size:name_at + name_size + extra_size]
        full, packed, header = _wide(extra, [entry[9], entry[8], entry[16]])
        if flags & _ENCRYPTED_FLAG:
            raise ZipError(f"{name} is encrypted")
        found.append(Member(name, method, crc, packed, full, header))
        at = name_at + name_size + extra_size + comment_size
    return found


def data_start(read: Read, member: Member) -> int:
    """Where in the file the bytes of a stored member begin."""
    if not member.stored:
        raise ZipError(f"{member.name} is compressed by method {member.method}, not stored")
    local = _unpack(_LOCAL, read(member.header, _LOCAL.size), 0, _LOCAL_SIGNATURE)
    return member.header + _LOCAL.size + local[9] + local[10]
