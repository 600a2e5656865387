"""Monotone sequences in little memory, and the n-gram trie made of them."""

from __future__ import annotations

import os
import tempfile

import numpy as np

CODES = 256
LOWEST = -12.0


def quantise(p: np.ndarray) -> np.ndarray:
    """Probabilities as one of 256 evenly spaced logarithms."""
    z = np.log10(np.maximum(p, 10.0**LOWEST)) / LOWEST
    return np.clip(np.rint(z * (CODES - 1)), 0, CODES - 1).astype(np.uint8)


def logarithm(codes: np.ndarray) -> np.ndarray:
    return np.arange(CODES)[codes] * (LOWEST / (CODES - 1))


class EliasFano:
    """Ascending 64-bit values: low bytes as they are, high parts as gaps in a bit string."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = -(-max(0, (top // max(n, 1)).bit_length() - 1) // 8)  # whole bytes
        v = np.ascontiguousarray(values, "<u8")
        low = v.view(np.uint8).reshape(n, 8)[:, :width].copy()
        place = (v >> np.uint64(8 * width) if width < 8 else v * 0).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(place[-1]) + 1 if n else 0, np.uint8)
        bits[place] = 1
        return cls(n, width, low.reshape(-1), np.packbits(bits))

    def values(self) -> np.ndarray:
        out = np.zeros((self.n, 8), np.uint8)
        out[:, : self.width] = np.asarray(self.low).reshape(self.n, self.width)
        place = np.flatnonzero(np.unpackbits(np.asarray(self.high)))
        high = (place - np.arange(self.n)).astype(np.uint64)
        shift = np.uint64(8 * self.width)
        return out.reshape(-1).view("<u8") + (high << shift if self.width < 8 else high * np.uint64(0))

    def tobytes(self) -> bytes:
        return np.array([self.n, self.width], "<i8").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def frombytes(cls, blob) -> EliasFano:
        n, width = (int(x) for x in np.frombuffer(blob, "<i8", 2))
        body = np.frombuffer(blob, np.uint8, offset=16)
        return cls(n, width, body[: n * width], body[n * width :])


class Trie:
    """A shard of the model, its levels memory-mapped from files.

    Level 1 holds contexts, level 2 the words that follow each, level 3 the longer contexts
    ending in each, level 4 what follows those, written as its rank among the followers of the
    shorter context. Pointers say where a node's children begin. Children of a node are a
    monotone run once the node's own number is put before them, so each level is one monotone
    sequence and a search in it is relative to its context.
    """

    NAMES = ("v", "w", "u", "t", "w_from", "u_from", "t_from")

    def __init__(self, levels: dict[str, np.ndarray], codes: dict[str, np.ndarray], folder: str | None = None):
        self.folder = folder or tempfile.mkdtemp(prefix="trie-")
        self.shape: dict[str, tuple[int, int, int]] = {}
        for name in self.NAMES:
            e = EliasFano.of(levels[name])
            np.concatenate([e.low, e.high]).tofile(self._path(name))
            self.shape[name] = (e.n, e.width, len(e.high))
        for name, c in codes.items():
            c.tofile(self._path(name))
        self.codes = tuple(codes)

    def _path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def level(self, name: str) -> np.ndarray:
        n, width, high = self.shape[name]
        if not n:
            return np.zeros(0, np.uint64)
        m = np.memmap(self._path(name), np.uint8, "r")
        return EliasFano(n, width, m[: n * width], m[n * width :]).values()

    def code(self, name: str) -> np.ndarray:
        return np.memmap(self._path(name), np.uint8, "r") if os.path.getsize(self._path(name)) else np.zeros(0, np.uint8)

    def drop(self) -> None:
        for name in (*self.NAMES, *self.codes):
            os.unlink(self._path(name))
        os.rmdir(self.folder)

    def search(self, level: np.ndarray, context: np.ndarray, bits: int, word: np.ndarray) -> np.ndarray:
        """Where each word stands among the children of its context; -1 if it does not."""
        key = (context.astype(np.uint64) << np.uint64(bits)) | word.astype(np.uint64)
        at = np.searchsorted(level, key)
        at[at == len(level)] = 0
        found = (level[at] == key) if len(level) else np.zeros(len(key), bool)
        return np.where(found & (context >= 0), at, -1)
