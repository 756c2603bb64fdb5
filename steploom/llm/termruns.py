"""Counts of terms by packing: short terms as one or two 64-bit words in radix order, longer ones as sorted bytes."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

#: Bytes of a term: letters of ASCII and all of other characters; A-Z count as a-z.
_IS_TERM = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Longest packed term; widths of the buckets for longer ones.  Beyond the widest, terms are Python bytes.
PACKED = 16
WIDTHS = (32, 64, 128, 256)
_DIGIT = 16

#: A bucket's terms: words of 64 bits (most significant first) or one column of bytes.
Keys = list[np.ndarray]


def radix_order(columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Places that sort unsigned columns (with the number of their 16-bit digits), the first column first; ties keep their order."""
    order: np.ndarray | None = None
    for column, digits in reversed(columns):
        for k in range(digits):
            digit = ((column >> np.uint64(_DIGIT * k)) & np.uint64(0xFFFF)).astype(np.uint16)
            if order is None:
                order = np.argsort(digit, kind="stable")
            elif len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order if order is not None else np.arange(0)


def _digits(values: np.ndarray) -> int:
    """16-bit digits of the largest value."""
    return max(1, -(-int(values.max(initial=0)).bit_length() // _DIGIT))


def _order(bucket: int, keys: Keys, tie: np.ndarray) -> np.ndarray:
    tie = tie.astype(np.uint64)
    if bucket > PACKED // 2:
        order = radix_order([(tie, _digits(tie))])
        return order[np.argsort(keys[0][order], kind="stable")]
    last = min(bucket, 4)
    if bucket <= 4:
        return radix_order([(keys[0], last), (tie, _digits(tie))])
    return radix_order([(keys[0], 4), (keys[1], bucket - 4), (tie, _digits(tie))])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


@dataclass
class Runs:
    """Terms of one bucket with their group, occurrences and documents; at most a row for each term and group.

    Bucket 1 to 8: terms of up to twice as many bytes; 9 and up: by ``WIDTHS``.
    """

    keys: Keys
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def __len__(self) -> int:
        return len(self.group)


def _counted(bucket: int, keys: Keys, doc: np.ndarray, group_of: np.ndarray) -> Runs:
    """Runs of tokens; ``doc`` numbers documents so that those of a group follow each other."""
    order = _order(bucket, keys, doc)
    keys, doc = [k[order] for k in keys], doc[order]
    group = group_of[doc]
    in_doc, in_group = _changes(*keys, doc), _changes(*keys, group)
    at = np.flatnonzero(in_group)
    return Runs(
        [k[at] for k in keys],
        group[at],
        np.diff(np.append(at, len(doc))),
        np.add.reduceat(in_doc.astype(np.int64), at),
    )


def _merged(bucket: int, parts: list[Runs], one_doc: bool = False) -> Runs:
    keys = [np.concatenate([p.keys[i] for p in parts]) for i in range(len(parts[0].keys))]
    group = np.concatenate([p.group for p in parts])
    n, docs = np.concatenate([p.n for p in parts]), np.concatenate([p.docs for p in parts])
    order = _order(bucket, keys, group)
    keys, group, n, docs = [k[order] for k in keys], group[order], n[order], docs[order]
    at = np.flatnonzero(_changes(*keys, group))
    summed = np.add.reduceat(docs, at)
    return Runs([k[at] for k in keys], group[at], np.add.reduceat(n, at), np.ones_like(summed) if one_doc else summed)


def packed_tokens(data: np.ndarray) -> list[tuple[int, Keys, np.ndarray]]:
    """Buckets of the lower-cased terms in a run of UTF-8 bytes, each with its terms and where they start."""
    inside = np.concatenate([[False], _IS_TERM[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    padded = np.concatenate([_LOWER[data], np.zeros(WIDTHS[-1], dtype=np.uint8)])
    word_at = np.ndarray((len(padded) - 7,), dtype=">u8", buffer=padded, strides=(1,))
    found = []
    bucket_of = np.minimum((lengths + 1) // 2, PACKED // 2 + 1)
    for bucket in range(1, PACKED // 2 + 1):
        own = np.flatnonzero(bucket_of == bucket)
        if not len(own):
            continue
        at, length = starts[own], lengths[own]
        first = word_at[at].astype(np.uint64)
        spare = lambda width, length=length: (8 * (width - length)).astype(np.uint64)
        if bucket <= 4:
            keys = [(first >> spare(8)) << (spare(8) - np.uint64(8 * (8 - 2 * bucket)))]
        else:
            second = word_at[at + 8].astype(np.uint64)
            keys = [first, (second >> spare(16)) << (spare(16) - np.uint64(8 * (16 - 2 * bucket)))]
        found.append((bucket, keys, at))
    low = PACKED
    for i, width in enumerate(WIDTHS):
        own = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        if len(own):
            at, columns = starts[own], np.arange(width)
            chars = padded[at[:, None] + columns]
            chars[columns >= lengths[own][:, None]] = 0
            found.append((PACKED // 2 + 1 + i, [chars.view(f"S{width}")[:, 0]], at))
    own = np.flatnonzero(lengths > low)
    if len(own):
        whole = padded.tobytes()
        terms = np.array([whole[s : s + n] for s, n in zip(starts[own].tolist(), lengths[own].tolist(), strict=True)], dtype=object)
        found.append((PACKED // 2 + 1 + len(WIDTHS), [terms], starts[own]))
    return found


def term_strings(bucket: int, keys: Keys) -> pa.Array:
    """The terms of a bucket as an Arrow column of strings."""
    if bucket > PACKED // 2 + len(WIDTHS):
        return pa.array([k.decode("utf-8") for k in keys[0]], pa.string())
    if bucket > PACKED // 2:
        chars = np.ascontiguousarray(keys[0]).view(np.uint8).reshape(len(keys[0]), -1)
    elif bucket <= 4:
        chars = keys[0].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - 2 * bucket :]
    else:
        first = keys[0].astype(">u8").view(np.uint8).reshape(-1, 8)
        second = keys[1].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 16 - 2 * bucket :]
        chars = np.concatenate([first, second], axis=1)
    used = chars != 0
    offsets = np.concatenate([[0], np.cumsum(used.sum(1))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(chars), pa.py_buffer(offsets.tobytes()), pa.py_buffer(chars[used].tobytes()))


@dataclass
class TermCounter:
    """Counts of terms by group over many batches of texts, in bounded memory.

    ``slice_bytes``: text that is packed and sorted together; a longer text is cut between
    terms and its parts count as one document.  ``hold``: rows kept before they are merged;
    when more are left after merging, all are given out and counting goes on afresh.
    """

    slice_bytes: int = 4 << 20
    hold: int = 2_000_000
    _held: dict[int, list[Runs]] = field(default_factory=dict)
    _rows: int = 0

    def add(self, texts: pa.Array, groups: np.ndarray) -> list[tuple[int, Runs]]:
        """Count a column of texts without NULLs whose rows belong to ``groups``; returns what must be given out now."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        out: list[tuple[int, Runs]] = []
        lo = 0
        while lo < len(texts):
            hi = int(np.searchsorted(offsets, offsets[lo] + self.slice_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), lo + 0xFFFF)
            if offsets[hi] - offsets[lo] > self.slice_bytes:
                self._add_long(data[offsets[lo] : offsets[hi]], int(groups[lo]))
            else:
                self._add_slice(data, offsets[lo : hi + 1], groups[lo:hi])
            lo = hi
            if self._rows > self.hold:
                out += self._merge()
        return out

    def rest(self) -> list[tuple[int, Runs]]:
        return self._merge(give_all=True)

    def _keep(self, bucket: int, runs: Runs) -> None:
        self._held.setdefault(bucket, []).append(runs)
        self._rows += len(runs)

    def _merge(self, give_all: bool = False) -> list[tuple[int, Runs]]:
        merged = [(b, _merged(b, parts)) for b, parts in self._held.items()]
        self._rows = sum(len(r) for _, r in merged)
        if give_all or self._rows > self.hold // 2:
            self._held, self._rows = {}, 0
            return merged
        self._held = {b: [r] for b, r in merged}
        return []

    def _add_slice(self, data: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> None:
        # A zero byte between texts keeps the last term of one and the first of the next apart.
        base, n = offsets[0], len(groups)
        body = data[base : offsets[-1]]
        inner = offsets[1:-1] - base
        joined = np.insert(body, inner, 0) if n > 1 else body
        begins = (offsets[:-1] - base) + np.arange(n)
        by_group = np.argsort(groups, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[by_group] = np.arange(n)
        for bucket, keys, at in packed_tokens(joined):
            doc = rank[np.searchsorted(begins, at, side="right") - 1]
            self._keep(bucket, _counted(bucket, keys, doc, groups[by_group]))

    def _add_long(self, data: np.ndarray, group: int) -> None:
        parts: dict[int, list[Runs]] = {}
        lo = 0
        while lo < len(data):
            hi = min(lo + self.slice_bytes, len(data))
            while hi < len(data) and _IS_TERM[data[hi]]:
                gaps = np.flatnonzero(~_IS_TERM[data[hi : hi + self.slice_bytes]])
                hi = hi + int(gaps[0]) if len(gaps) else min(hi + self.slice_bytes, len(data))
            for bucket, keys, at in packed_tokens(data[lo:hi]):
                none = np.zeros(len(at), dtype=np.int64)
                parts.setdefault(bucket, []).append(_counted(bucket, keys, none, np.array([group])))
                if len(parts[bucket]) > 8:
                    parts[bucket] = [_merged(bucket, parts[bucket], one_doc=True)]
            lo = hi
        for bucket, own in parts.items():
            self._keep(bucket, _merged(bucket, own, one_doc=True))
