"""SHA-256 over many messages at once, with states that can be kept, stored and resumed.

Messages here are joined digests in lower-case hex. One digest is 64 characters, just one
block of SHA-256, so the state before any digest of a message is eight 32-bit words.
Arrays of states and digests hold one message a column.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa


def _primes(n: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < n:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= x else (low, middle - 1)
    return low


# The first 32 fractional bits of the square roots of 8 primes and of the cube roots of 64 primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)[:, None]
ROUNDS = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]


def _hex_table() -> np.ndarray:
    """Four hex characters, as one big-endian word, of every 16-bit number."""
    numbers = np.arange(1 << 16, dtype=np.uint32)
    table = np.zeros(1 << 16, np.uint32)
    for shift in (12, 8, 4, 0):
        digit = (numbers >> np.uint32(shift)) & np.uint32(15)
        table = (table << np.uint32(8)) | np.where(digit < 10, digit + ord("0"), digit + (ord("a") - 10)).astype(np.uint32)
    return table


HEX = _hex_table()


def endings(digests: int) -> np.ndarray:
    """The last block of messages of 0 to ``digests`` digests, one a column."""
    block = np.zeros((16, digests + 1), np.uint32)
    block[0] = 1 << 31
    block[15] = 512 * np.arange(digests + 1)
    return block


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def resume(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block of 16 words; both arrays broadcast along messages."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for t, constant in enumerate(ROUNDS):
        if t >= 16:
            x, y = w[(t - 15) % 16], w[(t - 2) % 16]
            low = _turned(x, 7) ^ _turned(x, 18) ^ (x >> np.uint32(3))
            high = _turned(y, 17) ^ _turned(y, 19) ^ (y >> np.uint32(10))
            w[t % 16] = w[t % 16] + low + w[(t - 7) % 16] + high
        first = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ (e & (f ^ g))) + (w[t % 16] + constant)
        second = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + first, c, b, a, first + second
    return np.stack(np.broadcast_arrays(a, b, c, d, e, f, g, h)) + state


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The block of each digest's 64 hex characters."""
    block = np.empty((16, *digests.shape[1:]), np.uint32)
    block[0::2], block[1::2] = HEX[digests >> np.uint32(16)], HEX[digests & np.uint32(0xFFFF)]
    return block


def from_binary(column: pa.Array) -> np.ndarray:
    """Digests of 32 bytes each, as columns of words."""
    raw = np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.uint32)
    return np.ascontiguousarray(raw.reshape(-1, 8).T)


def to_binary(digests: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(digests.T).astype(">u4").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), digests.shape[1], [None, pa.py_buffer(raw)]).cast(pa.binary())


def to_hex(digests: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(hex_block(digests).T).astype(">u4").tobytes()
    offsets = np.arange(digests.shape[1] + 1, dtype=np.int32) * 64
    return pa.Array.from_buffers(pa.string(), digests.shape[1], [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
