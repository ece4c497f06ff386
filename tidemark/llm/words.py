"""Words of whole texts as numpy arrays, one Arrow batch at a time.

A word is a run of bytes other than space and the control characters 9 to 13.
Texts come as UTF-8 bytes; a missing text has no words. Nothing is cut off: a
batch is as long as its texts.
"""

from __future__ import annotations

import numpy as np

#: Multipliers of the mixing steps (odd, high entropy).
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_3 = np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them evenly."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= _MIX_2
    values ^= values >> np.uint64(27)
    values *= _MIX_3
    values ^= values >> np.uint64(31)
    return values


def split(text: bytes | None) -> list[bytes]:
    """The words of one text, unchanged; none for a missing text."""
    return text.split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def runs_of(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive codes; empty if there are fewer."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for offset in range(length):
            total *= _MIX
            total += codes[offset : offset + n]
        return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    have, least = 1, values
    while have * 2 <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[:n], least[rest : rest + n])
