"""Text normalization as native expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Characters dropped from text (NUL, controls but tab/LF/CR, DEL, U+FFFD).
UNWANTED_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{FFFD}]"

_WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(col, F.lit(_WHITE_SPACE))


def clean_text(col: Column | str) -> Column:
    """Drop control characters and outer white space; nothing left means NULL."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nullif(strip(F.regexp_replace(col, UNWANTED_CHARS, "")), F.lit(""))


def clean_label(col: Column | str) -> Column:
    """Like :func:`clean_text`, but NULL and empty both become the empty string."""
    return F.coalesce(clean_text(col), F.lit(""))


# Bytes 0x80-0x9F are the only ones where cp1252 and ISO-8859-1 differ. translate() drops
# a character without a counterpart, so the unassigned bytes go last to vanish.
def _cp1252_block() -> tuple[str, str]:
    pairs = {bytes([b]).decode("iso-8859-1"): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    assigned = [k for k, v in pairs.items() if v]
    dropped = [k for k, v in pairs.items() if not v]
    return "".join(assigned + dropped), "".join(pairs[k] for k in assigned)


def decode_cp1252(raw: Column) -> Column:
    """Decode cp1252 bytes; unassigned bytes are dropped."""
    return F.translate(F.decode(raw, "ISO-8859-1"), *_cp1252_block())


def field_name(name: str) -> str:
    """Column name for an xBase field name."""
    plain = re.sub(r"\W", "_", str(name).lower(), flags=re.ASCII).strip("_") or "field_unknown"
    return f"f_{plain}" if plain[0].isdigit() else plain
