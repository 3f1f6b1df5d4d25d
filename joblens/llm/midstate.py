"""SHA-256 over many messages at once, with its running state in the open.

``hashlib`` cannot hand out the state between two blocks, and a state that is
kept in a table must travel between executors.  A message here is a sequence
of 64-byte blocks (a digest in hexadecimal text is exactly one), so the state
after each block is all that resuming needs.  Arrays are (words, messages).
"""

from __future__ import annotations

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _root_bits(x: int, degree: int) -> int:
    """First 32 bits of the fraction of a square or cube root of ``x``."""
    whole = x << 32 * degree
    low, high = 0, 1 << 40
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**degree <= whole else (low, mid - 1)
    return low & 0xFFFFFFFF


START = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
ROUNDS = np.array([_root_bits(p, 3) for p in _primes(64)], np.uint32)
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def start(n: int) -> np.ndarray:
    """States of ``n`` empty messages."""
    return np.repeat(START[:, None], n, 1)


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return x >> np.uint32(k) | x << np.uint32(32 - k)


def absorb(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States after one more block each; ``blocks`` are (messages, 64) bytes."""
    words = list(np.ascontiguousarray(blocks).view(">u4").astype(np.uint32).T.copy())
    for i in range(16, 64):
        a, b = words[i - 15], words[i - 2]
        s0 = _turn(a, 7) ^ _turn(a, 18) ^ a >> np.uint32(3)
        s1 = _turn(b, 17) ^ _turn(b, 19) ^ b >> np.uint32(10)
        words.append(words[i - 16] + s0 + words[i - 7] + s1)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ e & (f ^ g)) + ROUNDS[i] + words[i]
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + (a & b | c & (a | b))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def finish(state: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests, as (messages, 64) hexadecimal letters, of messages that have
    absorbed ``n_blocks`` blocks each."""
    n = state.shape[1]
    pad = np.zeros((n, 64), np.uint8)
    pad[:, 0] = 0x80
    pad[:, 56:] = (512 * n_blocks.astype(np.uint64)).astype(">u8").view(np.uint8).reshape(n, 8)
    raw = np.ascontiguousarray(absorb(state, pad).T).astype(">u4").view(np.uint8).reshape(n, 32)
    out = np.empty((n, 64), np.uint8)
    out[:, 0::2], out[:, 1::2] = DIGITS[raw >> 4], DIGITS[raw & 15]
    return out
