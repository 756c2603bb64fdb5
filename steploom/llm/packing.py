"""Packing documents into token sequences by order-preserving dynamic programming."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_SCHEMA = (
    "doc_id {key}, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


@dataclass(frozen=True)
class PackConfig:
    """``tokenizer``: path of the vocabulary file, on every executor.

    Costs are in tokens: a padded token costs 1, a cut inside a document at the end of a
    sentence ``sentence_cut``, any other cut ``word_cut``.  ``run_tokens``: tokens that
    are cut together; the last sequence of a run is the only one with much padding.
    ``filler``: tokens between two places for cuts where no sentence ends.
    """

    tokenizer: str = ""
    length: int = 2048
    end_id: int = 1
    sentence_cut: float = 2.0
    word_cut: float = 4.0
    run_tokens: int = 1 << 19
    filler: int = 48
    cache_words: int = 800_000


# The split pattern of the vocabulary file, and the end sign of its words.
WORD_END = "</w>"
_ASCII_SPACES = dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# Code points on which lower case, composition and character classes are settled
# alike everywhere: printable ASCII and white space, and Latin letters and signs up to U+012F.
_PLAIN = re.compile("[\\x09-\\x0d\\x20-\\x7e\u00a1-\u012f]*\\Z")


def _plain_pattern() -> re.Pattern:
    """The split pattern for plain text, with its letters and numbers written out."""
    plain = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x130))]
    letters, numbers = (
        "".join(re.escape(c) for c in plain if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}")
    )
    return re.compile(SPLIT_PATTERN.replace(r"\p{L}", letters).replace(r"\p{N}", numbers))


class WordTokenizer:
    """Token ids of texts, part by part, with a bounded memory for parts seen before.

    The vocabulary splits a text into words, numbers and signs and never joins across
    them, so a text's ids are its parts' ids in order.  Plain text is split here, and its
    new parts go to the tokenizer together: the last token of a part bears the end sign of
    a word, so the answer is cut there.  Text with other characters or something like a
    special token in it goes to the tokenizer word by word.
    """

    def __init__(self, path: str, cache_words: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = _plain_pattern()
        self.cache_words = cache_words
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _direct(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, parts: list[str]) -> None:
        ids = self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids
        ends = ((np.flatnonzero(self.is_end[ids]) + 1) * 4).tolist()
        if len(ends) != len(parts):
            self.parts.update((p, self._direct(p)) for p in parts)
            return
        data, start = array("I", ids).tobytes(), 0
        for part, end in zip(parts, ends, strict=True):
            self.parts[part] = data[start:end]
            start = end

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if "<|" in text or not _PLAIN.match(text):
            words = text.encode("utf-8", "replace").decode("utf-8").translate(_ASCII_SPACES).split(" ")
            if len(self.words) > self.cache_words // 4:
                self.words.clear()
            self.words.update((w, self._direct(w)) for w in set(words).difference(self.words))
            return b"".join(map(self.words.__getitem__, words))
        parts = self.split.findall(text.lower())
        if len(self.parts) > self.cache_words:
            self.parts.clear()
        new = list(set(parts).difference(self.parts))
        if new:
            self._learn(new)
        return b"".join(map(self.parts.__getitem__, parts))


@lru_cache(maxsize=2)
def tokenizer_of(path: str, cache_words: int) -> WordTokenizer:
    return WordTokenizer(path, cache_words)


def choose_cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """Indices of the cheapest cuts through ``places`` (0 first, the end last), both ends included.

    A window between two cuts holds at most ``length`` tokens and costs its padding plus
    the penalty of the cut that ends it.  Windows whose length is a power of two are not
    padded.  ``best[j] = min(best[i] - (length - places[i])) ...`` over a sliding window
    is a queue whose front is the minimum, so a place is added and removed once.
    """
    p, pen = places.tolist(), penalties.tolist()
    n = len(p)
    best, back = [0.0] * n, [0] * n
    at = {x: i for i, x in enumerate(p)}
    powers = [1 << b for b in range(length.bit_length()) if (1 << b) <= length]
    queue: deque[int] = deque([0])
    lead = [0.0] * n
    for j in range(1, n):
        here = p[j]
        low = here - length
        while p[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        cost, origin = lead[i] - here + length, i
        for w in powers:
            i = at.get(here - w)
            if i is not None and best[i] < cost:
                cost, origin = best[i], i
        cost += pen[j]
        best[j], back[j] = cost, origin
        own = lead[j] = cost + here
        while queue and lead[queue[-1]] >= own:
            queue.pop()
        queue.append(j)
    cuts, j = [n - 1], n - 1
    while j:
        j = back[j]
        cuts.append(j)
    return cuts[::-1]


def cut_places(ends: np.ndarray, sentence_ends: np.ndarray, config: PackConfig) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run may be cut, with penalties.

    ``ends``: ends of documents; ``sentence_ends``: ends of sentences.  Where two
    neighbours are further apart than ``filler`` tokens, places between them are added.
    """
    soft = np.setdiff1d(sentence_ends, ends)
    places = np.concatenate([[0], ends, soft])
    penalty = np.concatenate([[0.0], np.zeros(len(ends)), np.full(len(soft), config.sentence_cut)])
    order = np.argsort(places, kind="stable")
    places, penalty = places[order], penalty[order]
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > config.filler)
    if len(wide):
        counts = (gaps[wide] - 1) // config.filler
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        extra = np.repeat(places[wide], counts) + step * config.filler
        places = np.concatenate([places, extra])
        penalty = np.concatenate([penalty, np.full(len(extra), config.word_cut)])
        order = np.argsort(places, kind="stable")
        places, penalty = places[order], penalty[order]
    return places, penalty


def pack_run(ids: list[np.ndarray], stops: np.ndarray, config: PackConfig) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a run of documents."""
    sizes = np.array([len(x) for x in ids])
    ends = np.cumsum(sizes)
    stream = np.concatenate(ids)
    sentence_ends = np.flatnonzero(np.isin(stream, stops)) + 1
    places, penalty = cut_places(ends, sentence_ends, config)
    cuts = places[choose_cuts(places, penalty, config.length)]
    edges = np.union1d(cuts, np.concatenate([[0], ends]))
    begin, end = edges[:-1], edges[1:]
    doc = np.searchsorted(ends, begin, side="right")
    sequence = np.searchsorted(cuts, begin, side="right") - 1
    start = begin - (ends - sizes)[doc]
    return list(zip(doc.tolist(), start.tolist(), (end - begin).tolist(), sequence.tolist(), (begin - cuts[sequence]).tolist(), strict=True))


def _packed(config: PackConfig):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer_of(config.tokenizer, config.cache_words)
        stops = np.array([tokens.ids("a" + sign)[4:] for sign in ".!?"]).view("<u4")
        end = np.array([config.end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 40
        keys, run, held = [], [], 0

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            pieces = pack_run(run, stops, config)
            doc, start, length, sequence, offset = (list(x) for x in zip(*pieces, strict=True))
            ids = [run[d][s : s + n] for d, s, n in zip(doc, start, length, strict=True)]
            ends = np.cumsum([0, *length]).astype("i4")
            base, number = number, number + sequence[-1] + 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[d] for d in doc], kind),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.ListArray.from_arrays(ends, np.concatenate(ids).view("<i4")),
                    pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    pa.array([len(run[d]) for d in doc], pa.int64()),
                    pa.array([base + q for q in sequence], pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(key)
                run.append(np.frombuffer(tokens.ids(text.as_py() or "") + end, dtype="<u4"))
                held += len(run[-1])
                if held >= config.run_tokens:
                    yield flush(kind)
                    keys, run, held = [], [], 0
        if run:
            yield flush(kind)

    return pack


def pack_documents(docs: DataFrame, config: PackConfig, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``.

    Every task reads its documents in order, cuts them run by run and never waits for
    another: no shuffle, and memory is one run plus one document.  A lost task is
    computed again from the same rows with the same result; sequence numbers hold the
    task's number in their upper bits.

    Every document ends with ``end_id``, so a NULL or empty text is one token and one
    piece.  NULL and repeated ids are kept as they are; no rows give no rows; other
    columns are left out.  A text of any length is packed whole.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_packed(config), PIECE_SCHEMA.format(key=kind))
