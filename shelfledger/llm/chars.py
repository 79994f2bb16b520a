"""Code points of a batch of texts as arrays, with letter, digit and case tables."""

from __future__ import annotations

from functools import cache

import numpy as np

PLANES = 0x323B0  # code points from here on count as other characters; none of them is a letter


@cache
def tables() -> dict[str, np.ndarray]:
    """Per code point: lower case, and whether it is a letter, a decimal digit, an upper-case letter."""
    every = [chr(c) for c in range(PLANES)]
    lower = np.arange(PLANES, dtype=np.uint32)
    for c, x in enumerate(every):
        y = x.lower()
        if y != x and len(y) == 1:
            lower[c] = ord(y)
    return {
        "lower": lower,
        "letter": np.array([x.isalpha() for x in every]),
        "digit": np.array([x.isdecimal() for x in every]),
        "upper": np.array([x.isupper() for x in every]),
    }


def code_points(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and code points of UTF-8 rows; what lies beyond the tables becomes 0, bytes that
    aren't UTF-8 become U+FFFD."""
    raw = data.tobytes()
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    try:
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        rows = [raw[i:j].decode(errors="replace") for i, j in zip(offsets[:-1], offsets[1:])]
        at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        codes = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32)
    if len(codes) and codes.max() >= PLANES:
        codes = np.where(codes < PLANES, codes, np.uint32(0))
    return at, codes
