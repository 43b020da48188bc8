"""Words of many texts at once, as numpy arrays: where they stand and a 64-bit hash of each."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: A prime field beside it: words that the hash modulo 2**64 cannot tell apart (long regular ones) differ here.
_PRIME = np.uint64((1 << 31) - 1)
_ROOT = 1_103_515_245
_pow = np.ones(1, np.uint64)
_unpow = np.ones(1, np.uint64)
_field = np.ones((2, 1), np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, at least n of each."""
    global _pow, _unpow
    if len(_pow) < n:
        size = 1 << max(16, (n - 1).bit_length())
        a, b = np.full(size, _BASE), np.full(size, _UNBASE)
        a[0] = b[0] = 1
        _pow, _unpow = np.cumprod(a), np.cumprod(b)
    return _pow, _unpow


def field_powers(n: int) -> np.ndarray:
    """Powers of the prime field's base and of its inverse, at least n of each."""
    global _field
    while _field.shape[1] < n:
        size = _field.shape[1]
        step = [[pow(b, size, int(_PRIME))] for b in (_ROOT, pow(_ROOT, -1, int(_PRIME)))]
        _field = np.concatenate([_field, _field * np.array(step, np.uint64) % _PRIME], axis=1)
    return _field


def byte_values(fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte (fixed seed); with fold_case A-Z have those of a-z."""
    values = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which hash_range() takes the hash of any range."""
    pow_, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pow_[: len(values)], out=out[1:])
    return out


def hash_range(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end], independent of where it stands."""
    _, unpow = powers(len(sums))
    return (sums[end] - sums[start]) * unpow[start]


class Words:
    """Word splitter: a word is a longest run of the bytes marked in ``word_byte`` (256 booleans)."""

    def __init__(self, word_byte: np.ndarray, fold_case: bool = True):
        self.word_byte, self.values = word_byte, byte_values(fold_case)
        self.field = self.values % _PRIME

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first byte, end byte) of each word, and where each text's words begin (one more entry than texts)."""
        n = len(data)
        if n == 0:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
        inside = self.word_byte[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = hash_range(prefix(self.values[data]), start, end)
        power, back = field_powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.field[data] * power[:n] % _PRIME, out=sums[1:])
        second = (sums[end] - sums[start]) % _PRIME * back[start] % _PRIME
        return mix(mix(h + (end - start).astype(np.uint64)) + second), start, end, np.searchsorted(start, offsets)


def alnum_bytes() -> np.ndarray:
    """Bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z: digits, letters, all beyond ASCII."""
    out = np.zeros(256, bool)
    out[48:58] = out[65:91] = out[97:123] = out[128:] = True
    return out


def nonspace_bytes() -> np.ndarray:
    """Bytes of ``[^\\x20\\x09-\\x0D]``."""
    out = np.ones(256, bool)
    out[32] = False
    out[9:14] = False
    return out
