"""Writes small xBase files byte by byte."""

from __future__ import annotations

import struct
from pathlib import Path


def dbf(fields: list[tuple[str, str, int, int]], records: list[tuple], tail: bytes = b"\x1a") -> bytes:
    """File bytes; a record is ``(flag, value, ...)`` with values as text or raw bytes."""
    size = 1 + sum(f[2] for f in fields)
    header = 32 + 32 * len(fields) + 1
    out = struct.pack("<4xIHH20x", len(records), header, size)
    for name, code, length, decimals in fields:
        raw = name if isinstance(name, bytes) else name.encode("ascii")
        out += struct.pack("<11sc4xBB14x", raw, code if isinstance(code, bytes) else code.encode(), length, decimals)
    out += b"\x0d"
    for flag, *values in records:
        out += flag.encode()
        for (_, code, length, _), value in zip(fields, values):
            raw = value if isinstance(value, bytes) else value.encode("cp1252")
            out += raw.rjust(length) if code in "NF" else raw.ljust(length)
    return out + tail


def write(path: Path, fields, records, **kw) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(dbf(fields, records, **kw))
    return str(path)
