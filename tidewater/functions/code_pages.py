"""Text in single-byte code pages (L16): bytes to characters and back, JVM-side.

A byte is read as the character of the same number and then translated, so
no byte raises an error and one that the code page doesn't define is seen.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._col import as_col


@cache
def _table(charset: str) -> tuple[str, str, str]:
    """The byte numbers with another character, these characters, and the
    byte numbers without one."""
    moved, to, undefined = [], [], []
    for byte in range(256):
        try:
            char = bytes([byte]).decode(charset)
        except UnicodeDecodeError:
            undefined.append(chr(byte))
            continue
        if len(char) != 1:
            raise ValueError(f"{charset} isn't a single-byte code page")
        if char != chr(byte):
            moved.append(chr(byte))
            to.append(char)
    if undefined and max(undefined) > "\x9f" and len(undefined) > 100:
        raise ValueError(f"{charset} isn't a single-byte code page")
    return "".join(moved), "".join(to), "".join(undefined)


def byte_text(c) -> Column:
    """Each byte of a binary value as the character of its number."""
    return F.decode(as_col(c), "ISO-8859-1")


def is_undecodable(c, charset: str) -> Column:
    """True when a binary value has a byte that the code page doesn't define."""
    undefined = _table(charset)[2]
    text = byte_text(c)
    return F.translate(text, undefined, "") != text if undefined else text.isNull() & F.lit(False)


def decode_bytes(c, charset: str) -> Column:
    """Binary to text; null where a byte has no character (or the value is null)."""
    moved, to, _ = _table(charset)
    return F.when(~is_undecodable(c, charset), F.translate(byte_text(c), moved, to))


def encode_text(c, charset: str) -> Column:
    """Text to binary; null where a character isn't in the code page."""
    moved, to, undefined = _table(charset)
    known = "".join(sorted((set(map(chr, range(256))) - set(moved) - set(undefined)) | set(to)))
    c = as_col(c)
    return F.when(F.translate(c, known, "") == "", F.encode(F.translate(c, to, moved), "ISO-8859-1"))
