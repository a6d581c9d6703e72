"""Hashes of the words of whole texts, for many texts at once in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# An odd multiplier and its inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 2**64)

# Bytes as parts of words: letters in lower case, digits, and all that is outside ASCII; 0 separates words.
WORD_BYTES = np.zeros(256, np.uint8)
for _byte in range(256):
    if _byte >= 0x80 or chr(_byte).isalnum():
        WORD_BYTES[_byte] = ord(chr(_byte).lower()) if _byte < 0x80 else _byte
# The same for words between white space and control characters, as they are written.
PRINTED_BYTES = np.where(np.arange(256) > 0x20, np.arange(256), 0).astype(np.uint8)


# Bytes hashed in one go, whatever the length of the texts.
BYTES_PER_PIECE = 1 << 18


@lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    """The first powers modulo 2**64, one for each byte of a piece."""
    powers = np.full(BYTES_PER_PIECE, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTOR))
    values[0] = 0
    return values


def word_starts(parts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words start in the bytes ``parts``, in which 0 separates; no word spans two texts."""
    inside = parts > 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    borders = ends[:-1][ends[:-1] < len(parts)]
    start[borders] = inside[borders]
    return np.flatnonzero(start)


def word_hashes(parts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, whatever its length and place.

    Bytes are weighted by powers that count from the start of their piece, and each word's
    sum is brought back to powers that count from its own start. A word that is longer than a
    piece is summed piece by piece.
    """
    sums = np.zeros(len(starts), np.uint64)
    ups, downs, values = _powers(FACTOR), _powers(INVERSE), _byte_values()
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = int(np.searchsorted(starts, begin + BYTES_PER_PIECE, side="left"))
        end = min(int(starts[last]) if last < len(starts) else len(parts), begin + BYTES_PER_PIECE)
        inside = starts[first:last] - begin
        sums[first:last] = np.add.reduceat(values[parts[begin:end]] * ups[: end - begin], inside) * downs[inside]
        # What is left of the last word, if it reaches beyond the piece.
        at, scale = end, pow(FACTOR, end - int(starts[last - 1]), 2**64)
        while at < len(parts) and parts[at - 1] and parts[at] and (last == len(starts) or at < starts[last]):
            stop = min(at + BYTES_PER_PIECE, int(starts[last]) if last < len(starts) else len(parts))
            piece = parts[at:stop]
            gaps = np.flatnonzero(piece == 0)
            piece = piece[: gaps[0]] if len(gaps) else piece
            total = int((values[piece] * ups[: len(piece)]).sum(dtype=np.uint64)) * scale % 2**64
            sums[last - 1 : last] += np.uint64(total)
            at, scale = at + len(piece), scale * pow(FACTOR, len(piece), 2**64) % 2**64
        first = last
    return mix(sums)


def owners(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of the text that holds each word."""
    return np.searchsorted(ends, starts, side="right")
