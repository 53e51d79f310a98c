"""Letter-and-digit words of whole texts, cut on their UTF-8 bytes.

A word is a run of ASCII letters, digits and all characters beyond ASCII; only
A-Z are lower-cased. One table lookup per byte lower-cases and blanks out the
rest, so a text is cut without a regular expression.
"""

from __future__ import annotations

from collections.abc import Iterator

CHUNK = 4 << 20         # bytes of a very long text cut into words at a time

_TABLE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))


def blanked(text: str | None) -> bytes:
    """The text's bytes, each in its place: lower-case words, spaces between."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)


def words(data: bytes) -> Iterator[list[bytes]]:
    """Words of ``blanked`` bytes, list by list; no word is cut."""
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + CHUNK) if len(data) - start > CHUNK else -1
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop
