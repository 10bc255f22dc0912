"""SHA-256 of many nodes at once, with states that can be kept, copied and resumed.

A digest as hex text is 64 bytes, which is one block of SHA-256.  So the state before each child of a node is the
chain of eight words after the children to its left, and resuming it needs nothing else.  All functions work on
arrays of nodes; a digest is a row of eight big-endian words.
"""

from __future__ import annotations

import numpy as np


def _primes(count: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < count:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _root_fraction(prime: int, power: int) -> int:
    """The first 32 bits of the fraction of a prime's square (2) or cube (3) root."""
    scaled = prime << (32 * power)
    low, high = 0, 1 << 40
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**power <= scaled else (low, middle)
    return low & 0xFFFFFFFF


ROUND_KEYS = np.array([_root_fraction(p, 3) for p in _primes(64)], np.uint32)
FRESH = np.array([_root_fraction(p, 2) for p in _primes(8)], np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def fresh(count: int) -> np.ndarray:
    return np.broadcast_to(FRESH, (count, 8)).copy()


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states after one more block of 16 words each."""
    words = [blocks[:, i].copy() for i in range(16)]
    a, b, c, d, e, f, g, h = (states[:, i].copy() for i in range(8))
    for at in range(64):
        if at >= 16:
            w15, w2 = words[(at - 15) % 16], words[(at - 2) % 16]
            s0 = _turned(w15, 7) ^ _turned(w15, 18) ^ (w15 >> np.uint32(3))
            s1 = _turned(w2, 17) ^ _turned(w2, 19) ^ (w2 >> np.uint32(10))
            words[at % 16] = words[at % 16] + s0 + words[(at - 7) % 16] + s1
        t1 = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ (e & (f ^ g))) + ROUND_KEYS[at] + words[at % 16]
        t2 = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def hex_bytes(digests: np.ndarray) -> np.ndarray:
    """The 64 characters of each digest."""
    raw = np.ascontiguousarray(digests.astype(">u4")).view(np.uint8).reshape(len(digests), 32)
    return _HEX[np.stack([raw >> 4, raw & 15], axis=2).reshape(len(digests), 64)]


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The block of each digest as hex text."""
    return hex_bytes(digests).view(">u4").astype(np.uint32)


def finish(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages that end here, after so many whole blocks."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 0x80000000
    last[:, 15] = blocks * 512
    return absorb(states, last)


def from_bytes(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u4").astype(np.uint32).reshape(len(digests), 8)


def to_bytes(digests: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(digests.astype(">u4")).tobytes()
    return [raw[at : at + 32] for at in range(0, len(raw), 32)]
