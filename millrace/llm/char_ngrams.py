"""Hashed character n-grams of a text, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHARACTERS_AT_ONCE = 1 << 18
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def ngram_buckets(text: str, longest: int, bits: int) -> Iterator[np.ndarray]:
    """The bucket of every n-gram with 1 to ``longest`` characters of the lower-cased text, in pieces."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(codes), CHARACTERS_AT_ONCE):
        part = codes[at : at + CHARACTERS_AT_ONCE + longest - 1]
        ends = min(CHARACTERS_AT_ONCE, len(codes) - at)
        mixed = np.zeros(len(part), np.uint32)
        for n in range(longest):
            if len(part) <= n:
                break
            mixed = mixed[: len(part) - n] * np.uint32(31) + part[n:] * _FACTORS[n % len(_FACTORS)]
            hashed = (mixed ^ (mixed >> np.uint32(15))) * _FACTORS[(n + 1) % len(_FACTORS)] + np.uint32(n)
            yield (hashed >> np.uint32(32 - bits))[:ends]
