"""SHA-256 of many messages side by side, with states that can be kept and resumed.

A state is the eight words after a whole number of 64-byte blocks.  A digest as
lower-case hex is exactly one block, so a hash over digests has a state at every
border between two of them.  Arrays hold one message a row.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

CHUNK = 4096  # rows worked on at once: their words stay in the cache
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def primes(n: int) -> list[int]:
    found: list[int] = []
    candidate = 2
    while len(found) < n:
        if all(candidate % p for p in found):
            found.append(candidate)
        candidate += 1
    return found


def cube_root(n: int) -> int:
    """Largest whole number whose cube is at most ``n``."""
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** 3 <= n else (low, mid - 1)
    return low


# fractional parts of square and cube roots of primes, 32 bits
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in primes(8)], np.uint32)
ROUND = [np.uint32(cube_root(p << 96) & 0xFFFFFFFF) for p in primes(64)]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _block(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    w = list(np.ascontiguousarray(words.T))
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w.append(w[i - 16] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3)))
                 + w[i - 7] + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))))
    a, b, c, d, e, f, g, h = first = list(np.ascontiguousarray(state.T))
    for k, word in zip(ROUND, w):
        t1 = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k + word
        t2 = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    return np.stack([x + y for x, y in zip(first, (a, b, c, d, e, f, g, h))], axis=1)


def absorbed(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) each."""
    out = np.empty_like(state)
    for at in range(0, len(state), CHUNK):
        out[at:at + CHUNK] = _block(state[at:at + CHUNK], words[at:at + CHUNK])
    return out


def fresh(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as bytes -> the block (n, 16) of their lower-case hex."""
    text = np.empty((len(digests), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = HEX[digests >> 4], HEX[digests & 15]
    return text.view(">u4").astype(np.uint32)


def finished(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of messages of ``blocks`` whole blocks."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0], last[:, 15] = 0x80000000, blocks * 512
    return as_bytes(absorbed(state, last))


def as_bytes(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.astype(">u4")).view(np.uint8).reshape(-1, 32)


def as_state(stored: np.ndarray) -> np.ndarray:
    """The reverse of ``as_bytes``."""
    return np.ascontiguousarray(stored).view(">u4").astype(np.uint32).reshape(-1, 8)
