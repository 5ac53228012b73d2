"""SetSketch: registers of truncated logarithms of minima, and joint estimation.

Register i of a set is floor(1 - log_b(min over elements of h_i)), with h_i
exponential hashes: the register-wise maximum of two sketches is the sketch of
the union, and the share of equal registers grows with the Jaccard similarity.
"""
from __future__ import annotations

import numpy as np

REGISTERS = 180
BASE = 2.0**0.125  # eight register values per doubling: one byte spans 32 doublings
_GRID = np.linspace(0.0, 1.0, 51)


def _seeds(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_210))
    return rng.integers(0, 1 << 32, m, np.uint32), rng.integers(0, 1 << 31, m, np.uint32) * np.uint32(2) + np.uint32(1)


_XOR, _MUL = _seeds(REGISTERS)


def registers(hashes: np.ndarray, block: int = 1024) -> np.ndarray:
    """Sketch of a set of well-mixed 64-bit hashes (uint8; not for an empty set)."""
    h = ((hashes >> np.uint64(32)) ^ hashes).astype(np.uint32)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(h), block):
        v = (h[a : a + block, None] ^ _XOR) * _MUL
        np.minimum(low, v.min(0), out=low)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)  # uniform minimum -> exponential minimum
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 255).astype(np.uint8)


def log_likelihood(regs: np.ndarray, sizes: np.ndarray, one: np.ndarray, size: int) -> np.ndarray:
    """Log-likelihood over the similarity grid of each sketch against ``one``.

    With cardinality shares u, v the chance that the first register is larger
    is p(u - v J) and that the second is larger p(v - u J), where p(x) =
    -log_b(1 - x (b - 1) / b); the rest are equal registers.  Similarities that
    the cardinalities rule out are -inf.
    """
    more = (regs > one).sum(1).astype(np.float64)[:, None]
    less = (regs < one).sum(1).astype(np.float64)[:, None]
    equal = REGISTERS - more - less
    total = (sizes + size).astype(np.float64)[:, None]
    u, v = sizes[:, None] / total, size / total
    j = _GRID[None, :]
    scale = (BASE - 1) / BASE
    with np.errstate(divide="ignore", invalid="ignore"):
        p_more = -np.log1p(-np.maximum(u - v * j, 1e-9) * scale) / np.log(BASE)
        p_less = -np.log1p(-np.maximum(v - u * j, 1e-9) * scale) / np.log(BASE)
        ll = more * np.log(p_more) + less * np.log(p_less) + equal * np.log(np.maximum(1 - p_more - p_less, 1e-12))
    limit = np.minimum(u / v, v / u)
    return np.where(j <= limit + 0.02, ll, -np.inf)


def similarity(ll: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of each row."""
    return _GRID[np.argmax(ll, 1)]


def may_reach(ll: np.ndarray, threshold: float, odds: float = 14.0) -> np.ndarray:
    """Whether a similarity of ``threshold`` or more is not ruled out: some such
    similarity is at most exp(odds) times less likely than the best one."""
    above = ll[:, _GRID >= threshold - 0.02]
    return above.max(1) >= ll.max(1) - odds
