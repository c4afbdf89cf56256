"""Hashed character n-grams, computed for a whole text at a time with numpy."""

from __future__ import annotations

from functools import cache

import numpy as np


@cache
def _letters() -> np.ndarray:
    """For each code point: True if it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters_only(text: str) -> np.ndarray:
    """Lower-case code points, every run of other characters one blank, blanks at the ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(32))
    blank = codes == 32
    keep = ~(blank & np.concatenate([[False], blank[:-1]]))
    return codes[keep]


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def ngrams(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket (0 to 2**bits - 1) of every n-gram, in order, repeats included."""
    if len(codes) < n:
        return np.zeros(0, np.int64)
    h = np.full(len(codes) - n + 1, n * 0x51_7C_C1_B7 + 1, np.uint64)
    for k in range(n):
        h = (h ^ codes[k:len(codes) - n + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - bits)).astype(np.int64)
