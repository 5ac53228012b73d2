"""One level of an n-gram trie in a compact byte image.

A level holds, for every context, its successors.  Three rising sequences are
Elias-Fano coded: the contexts, the pointers to where each context's successors
start, and the successors themselves (made rising by their context's rank).
Smoothed probabilities are quantised to one byte.  The image is contiguous and
is read in place, from an anonymous memory map, a mapped file or any buffer;
a query decodes only the windows of a sequence that it needs.
"""
from __future__ import annotations

import mmap

import numpy as np

STEP = 8  # quantisation: code = -STEP * log2(p), rounded
ABSENT = 255
SAMPLE = 256  # elements between two samples of the high bits
SPAN = 1 << 16  # elements decoded at once


def quantize(p: np.ndarray, down: bool = False) -> np.ndarray:
    """Codes of the nearest probabilities (2^(1/16) at most off), or of the next ones
    ``down`` (2^(1/8) at most)."""
    code = -STEP * np.log2(p)
    return np.clip(np.ceil(code) if down else np.rint(code), 0, ABSENT - 1).astype(np.uint8)


def probability(code: np.ndarray) -> np.ndarray:
    """Probability of each code; ``ABSENT`` is 0."""
    table = 2.0 ** (-np.arange(256) / STEP)
    table[ABSENT] = 0.0
    return table[code]


def encode(values: np.ndarray) -> list[np.ndarray]:
    """Elias-Fano parts of a rising uint64 sequence: header, high bits, low bytes, samples.

    The low part has whole bytes, at least log2(universe / n) bits; the high
    part is one bit per element and one per step of the high value.
    """
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // max(n, 1)).bit_length())
    low_bytes = -(-width // 8)
    shift = np.uint64(8 * low_bytes)
    high = (values >> shift).astype(np.int64) if low_bytes < 8 else np.zeros(n, np.int64)
    at = high + np.arange(n)
    bits = np.zeros((int(at[-1]) + 1) if n else 0, np.uint8)
    bits[at] = 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low_bytes]
    packed = np.packbits(bits, bitorder="little")
    samples = at[::SAMPLE].astype(np.int64)
    header = np.array([n, low_bytes, len(packed), len(samples)], np.int64)
    return [header, packed, np.ascontiguousarray(planes).ravel(), samples]


class Rising:
    """Elias-Fano coded sequence read in place from ``buffer`` at ``offset``."""

    def __init__(self, buffer, offset: int):
        self.n, self.low_bytes, packed, samples = np.frombuffer(buffer, np.int64, 4, offset).tolist()
        offset += 32
        self.samples = np.frombuffer(buffer, np.int64, samples, offset)
        offset += 8 * samples
        self.high = np.frombuffer(buffer, np.uint8, packed, offset)
        offset += packed
        self.low = np.frombuffer(buffer, np.uint8, self.n * self.low_bytes, offset).reshape(self.n, self.low_bytes)
        self.end = offset + self.n * self.low_bytes
        self.end += -self.end % 8

    def window(self, a: int, b: int) -> np.ndarray:
        """Elements a to b (exclusive)."""
        a, b = max(0, a), min(self.n, b)
        if a >= b:
            return np.empty(0, np.uint64)
        first, last = a // SAMPLE, -(-b // SAMPLE)
        start = int(self.samples[first])
        stop = int(self.samples[last]) if last < len(self.samples) else 8 * len(self.high)
        byte = start >> 3
        at = np.flatnonzero(np.unpackbits(self.high[byte : -(-stop // 8)], bitorder="little")) + 8 * byte
        at = at[np.searchsorted(at, start) :]
        index = first * SAMPLE
        at = at[a - index : b - index]
        value = (at - np.arange(a, b)).astype(np.uint64)
        low = np.zeros((b - a, 8), np.uint8)
        low[:, : self.low_bytes] = self.low[a:b]
        low = low.view("<u8").ravel()
        return low if self.low_bytes >= 8 else (value << np.uint64(8 * self.low_bytes)) | low

    def find(self, wanted: np.ndarray, low: int = 0, high: int | None = None) -> np.ndarray:
        """Index of each value of a rising array within [low, high), or -1: a
        successor search that walks over decoded windows."""
        out = np.full(len(wanted), -1, np.int64)
        high = self.n if high is None else high
        done = 0
        for a in range(low, high, SPAN):
            if done == len(wanted):
                break
            values = self.window(a, min(a + SPAN, high))
            to = int(np.searchsorted(wanted, values[-1], "right"))
            part = wanted[done:to]
            at = np.searchsorted(values, part)
            hit = values[np.minimum(at, len(values) - 1)] == part
            out[done:to][hit] = at[hit] + a
            done = to
        return out


def build(keys: np.ndarray, counts: np.ndarray, bits: int) -> mmap.mmap:
    """Image of a level from rising keys (context << bits | successor) seen
    ``counts`` > 0 times.

    Witten-Bell smoothing: a context seen C times with T distinct successors
    gives a successor seen c times the mass c / (C + T) and leaves T / (C + T)
    to the shorter context.  Where a context's rounded masses would add up to more
    than 1, all of them are rounded down.
    """
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    contexts, starts = np.unique(keys >> shift, return_index=True)
    degree = np.diff(np.append(starts, len(keys)))
    rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), degree)
    total = np.add.reduceat(counts, starts) if len(starts) else counts
    whole = total + degree
    direct = backoff = np.empty(0, np.uint8)
    if len(keys):
        mass, left = counts / np.repeat(whole, degree), degree / whole
        direct, backoff = quantize(mass), quantize(left)
        above = np.add.reduceat(probability(direct), starts) + probability(backoff) > 1
        direct = np.where(np.repeat(above, degree), quantize(mass, down=True), direct)
        backoff = np.where(above, quantize(left, down=True), backoff)
    sequences = (contexts, np.append(starts, len(keys)).astype(np.uint64), (rank << shift) | (keys & mask))
    chunks: list[bytes] = []
    size = 0
    for values in sequences:
        header, packed, low, samples = encode(values)
        part = b"".join(x.tobytes() for x in (header, samples, packed, low))
        part += b"\0" * (-len(part) % 8)
        chunks.append(part)
        size += len(part)
    chunks += [backoff.tobytes(), direct.tobytes()]
    image = mmap.mmap(-1, max(1, size + len(backoff) + len(direct)))
    image.write(b"".join(chunks))
    return image


class Level:
    """A level's image, queried in place."""

    def __init__(self, buffer, bits: int):
        self.bits = bits
        self.contexts = Rising(buffer, 0)
        self.pointers = Rising(buffer, self.contexts.end)
        self.successors = Rising(buffer, self.pointers.end)
        at = self.successors.end
        self.backoff = np.frombuffer(buffer, np.uint8, self.contexts.n, at)
        self.direct = np.frombuffer(buffer, np.uint8, self.successors.n, at + self.contexts.n)

    def query(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of the direct probability or ABSENT, code of the backoff weight)
        of rising keys; an unknown context backs off with weight 1."""
        shift, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        wanted, inverse = np.unique(keys >> shift, return_inverse=True)
        context = self.contexts.find(wanted)[inverse]
        direct, backoff = np.full(len(keys), ABSENT, np.uint8), np.zeros(len(keys), np.uint8)
        known = np.flatnonzero(context >= 0)
        if len(known):
            rank = context[known]
            backoff[known] = self.backoff[rank]
            # the pointers bound the search to the known contexts' successors
            low = int(self.pointers.window(int(rank[0]), int(rank[0]) + 1)[0])
            high = int(self.pointers.window(int(rank[-1]) + 1, int(rank[-1]) + 2)[0])
            relative = (rank.astype(np.uint64) << shift) | (keys[known] & mask)
            at = self.successors.find(relative, low, high)
            direct[known[at >= 0]] = self.direct[at[at >= 0]]
        return direct, backoff
