"""Hashes of word windows of whole batches of texts, with numpy over their bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_AS_IS = bytes(range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Bytes that are hashed together; a longer text forms a group of its own.
GROUP_BYTES = 1 << 20


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return np.random.default_rng(20_240).integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(20, (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            np.multiply.accumulate(row, out=row)
            _POWERS[name] = row
    return _POWERS["up"], _POWERS["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; different values stay different."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes: a polynomial over them, from running sums, then mixed."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_codes()[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def normalized(text: str | None, lower: bool = True) -> bytes:
    """Words of a text with one space after each, A-Z lower-cased if asked."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER if lower else _AS_IS).split()
    return b" ".join(found) + b" " if found else b""


def window_hashes(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each normalized text the hash of every ``width`` words in a row, in order.

    A text with fewer words is one window; one without words has none.
    """
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for t in texts:
        if group and size + len(t) > GROUP_BYTES:
            out += _group_hashes(group, width)
            group, size = [], 0
        group.append(t)
        size += len(t)
    return out + (_group_hashes(group, width) if group else [])


def _group_hashes(texts: list[bytes], width: int) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    word_ends = np.flatnonzero(data == 32) + 1
    lengths = np.array([len(t) for t in texts])
    text_ends = np.cumsum(lengths)
    last = np.searchsorted(word_ends, text_ends, side="right")
    first = np.concatenate([[0], last[:-1]])
    word_starts = np.concatenate([[0], word_ends[:-1]]) if len(word_ends) else word_ends
    starts, ends = [], []
    for lo, hi in zip(first.tolist(), last.tolist(), strict=True):
        if hi == lo:
            starts.append(np.empty(0, dtype=np.int64))
            ends.append(np.empty(0, dtype=np.int64))
            continue
        starts.append(word_starts[lo : max(hi - width + 1, lo + 1)])
        ends.append(word_ends[min(lo + width, hi) - 1 : hi])
    hashes = span_hashes(data, np.concatenate(starts), np.concatenate(ends))
    return np.split(hashes, np.cumsum([len(s) for s in starts])[:-1])
