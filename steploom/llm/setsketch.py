"""SetSketch registers: truncated logarithms of minima, mergeable and sensitive to locality."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np


@dataclass(frozen=True)
class SketchConfig:
    """``bands`` bands of ``rows`` registers.  Register values are spaced by powers of ``base``.

    ``rate``: rate of the exponential minima; with it, values of sets of 1 to about
    ``base ** limit / rate`` elements lie between 0 and ``limit``.
    """

    bands: int = 32
    rows: int = 4
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65_534
    seed: int = 9

    @property
    def registers(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=4)
def _factors(config: SketchConfig) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(config.seed)
    draw = lambda: random.integers(0, 1 << 63, config.registers, dtype=np.uint64)
    return (draw() << np.uint64(1)) | np.uint64(1), draw()


def sketches(sets: list[np.ndarray], config: SketchConfig) -> np.ndarray:
    """Registers (unsigned 16-bit) of sets of 64-bit hashes; a row for each set, none of them empty.

    An element's value in register i is exponential with the given rate; a register keeps
    ``floor(1 - log_base(minimum))`` within 0 to ``limit + 1``.  The register of a union is
    the larger of two registers.
    """
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    joined = np.concatenate(sets)
    factors, shifts = _factors(config)
    least = np.empty((len(sets), config.registers), dtype=np.uint64)
    buffer = np.empty_like(joined)
    for i in range(config.registers):
        np.multiply(joined, factors[i], out=buffer)
        np.add(buffer, shifts[i], out=buffer)
        least[:, i] = np.minimum.reduceat(buffer, starts)
    uniform = (least.astype(np.float64) + 0.5) * 2.0**-64
    minimum = -np.log1p(-uniform) / config.rate
    values = np.floor(1 - np.log(minimum) / np.log(config.base))
    return np.clip(values, 0, config.limit + 1).astype(np.uint16)


def band_values(registers: np.ndarray, config: SketchConfig) -> np.ndarray:
    """One 64-bit value for each band: its registers side by side, mixed with the band's number."""
    from .wordhash import mixed

    parts = registers.reshape(len(registers), config.bands, config.rows).astype(np.uint64)
    value = np.broadcast_to(np.arange(config.bands, dtype=np.uint64), (len(registers), config.bands)).copy()
    for r in range(config.rows):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r] + np.uint64(1))
    return value.view(np.int64)


def likely_similarity(
    above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, config: SketchConfig, steps: int = 18
) -> np.ndarray:
    """Jaccard similarity of set pairs that makes their registers most likely.

    ``above`` and ``below``: registers of the first set that are larger or smaller than
    the second's; the others are equal.  ``n_a`` and ``n_b``: sizes.  With u = n_a / (n_a + n_b)
    and v = n_b / (n_a + n_b), a register is larger with probability p(u - v J), smaller
    with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b); the log likelihood is
    concave in J, and its maximum is found by golden section between 0 and the smaller
    ratio of the sizes.
    """
    u = n_a / (n_a + n_b)
    v = 1 - u
    equal = config.registers - above - below
    b = config.base
    p = lambda x: np.maximum(-np.log1p(-np.clip(x, 0, 1) * (b - 1) / b) / np.log(b), 1e-12)

    def score(j: np.ndarray) -> np.ndarray:
        more, less = p(u - v * j), p(v - u * j)
        return above * np.log(more) + below * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(steps):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        better = score(left) >= score(right)
        high, low = np.where(better, right, high), np.where(better, low, left)
    return (low + high) / 2
