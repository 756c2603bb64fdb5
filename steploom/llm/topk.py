"""Exact search of the highest inner products with block-at-a-time pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from steploom.session import materialize

_EXACT = 2**53
_LONG = 2**63 - 1

BLOCK_SCHEMA = "ids binary, width int, high binary, low binary, vectors binary"
HIT_SCHEMA = "query_row long, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class SearchConfig:
    """``block_rows``: vectors in a block.  ``query_chunk``: queries that are sent to all tasks at once."""

    k: int = 10
    block_rows: int = 512
    query_chunk: int = 4096


def quantized(embedding: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of every component, as double; NULL if a component is NULL or not finite."""
    odd = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~odd, F.transform(embedding, lambda c: _floor(c.cast("double") * scale)))


def _floor(x: Column) -> Column:
    """Floor that stays a double, also beyond the range of a long."""
    return F.when(F.abs(x) < float(_EXACT), F.floor(x).cast("double")).otherwise(x)


def _matrix(lists: list[list[float]]) -> np.ndarray:
    """Rows of equal width; shorter vectors go on with zeros."""
    width = max(map(len, lists), default=0)
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def _blocks(rows: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        vectors: list[list[float]] = []

        def block() -> pa.RecordBatch:
            m = _matrix(vectors)
            columns = [
                np.array(ids, dtype="<i8").tobytes(), m.shape[1], m.max(0).tobytes(), m.min(0).tobytes(), m.tobytes()
            ]
            kinds = [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(columns, kinds, strict=True)], names=["ids", "width", "high", "low", "vectors"]
            )

        for batch in batches:
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            while len(ids) >= rows:
                rest = ids[rows:], vectors[rows:]
                ids, vectors = ids[:rows], vectors[:rows]
                yield block()
                ids, vectors = rest
        if ids:
            yield block()

    return build


def forward_blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of consecutive rows of ``vec_id, vector``: the vectors and the extremes of every component."""
    return vectors.select("vec_id", "vector").mapInArrow(_blocks(rows), BLOCK_SCHEMA)


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return m[:, :width] if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows, as long; beyond a long they stop at its ends."""
    width = max(a.shape[1], b.shape[1])
    a, b = _fit(a, width), _fit(b, width)
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if reach < _EXACT:
        return (a @ b.T).astype("i8")
    if reach < 2**62 and np.abs(a).max() < 2**62 and np.abs(b).max() < 2**62:
        return a.astype("i8") @ b.astype("i8").T
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    exact = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in whole[1]] for p in whole[0]]
    return np.array([[max(-_LONG - 1, min(_LONG, s)) for s in row] for row in exact], dtype="i8").reshape(len(a), len(b))


class TopK:
    """The k best of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.empty(0, "i8")] * n
        self.ids: list[np.ndarray] = [np.empty(0, "i8")] * n
        self.kth = np.full(n, -math.inf)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        order = np.lexsort((i, -s.astype(object) if s.size and s.min() == -_LONG - 1 else -s))[: self.k]
        self.scores[q], self.ids[q] = s[order], i[order]
        if len(order) == self.k:
            self.kth[q] = float(self.scores[q][-1])


def upper_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Largest possible score of each query in each block: positive weights times maxima, negative times minima."""
    width = max(queries.shape[1], high.shape[1])
    q, high, low = _fit(queries, width), _fit(high, width), _fit(low, width)
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    # Room for rounding where sums leave the exact range of a double.
    return bound + np.abs(bound) * 1e-9


def _search(queries, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, q = queries.value
        blocks = [r for b in batches for r in b.to_pylist()]
        if not blocks or not len(ids):
            return
        width = max(b["width"] for b in blocks)
        as_rows = lambda name: np.stack([_fit(np.frombuffer(b[name])[None, :], width)[0] for b in blocks])
        bounds = upper_bounds(q, as_rows("high"), as_rows("low"))
        best = TopK(len(ids), k)
        order = np.argsort(-bounds, axis=1, kind="stable")
        for step in range(len(blocks)):
            # The next block of every query that may still gain from it, grouped by block.
            chosen = order[:, step]
            live = np.flatnonzero(bounds[np.arange(len(ids)), chosen] >= best.kth)
            if not len(live):
                break
            for b in np.unique(chosen[live]):
                mine = live[chosen[live] == b]
                block = blocks[b]
                own = np.frombuffer(block["ids"], "<i8")
                vectors = np.frombuffer(block["vectors"]).reshape(len(own), block["width"])
                scores = inner_products(q[mine], vectors)
                for n, i in enumerate(mine):
                    keep = (own != ids[i]) & (scores[n] >= best.kth[i])
                    if keep.any():
                        best.add(i, scores[n][keep], own[keep])
        counts = [len(s) for s in best.ids]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(rows, counts)),
                    pa.array(np.repeat(ids, counts)),
                    pa.array(np.concatenate(best.ids)),
                    pa.array(np.concatenate(best.scores)),
                ],
                names=["query_row", "query_id", "vec_id", "score"],
            )

    return search


def search_top_k(
    vectors: DataFrame, queries: DataFrame, config: SearchConfig | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest inner products of every row of ``queries``.

    Both tables hold ``vec_id`` and ``vector`` (see ``quantized``); a query is scored
    against every row of ``vectors`` with another id.  A task holds a range of blocks: it
    visits them in the order of each query's upper bound and stops at the first bound below
    the query's kth score.  The best of all tasks are merged.  Queries go to the tasks in
    chunks of about ``query_chunk`` by a hash of their row, so what is sent is bounded.

    Rows with a NULL id or vector take no part.  Repeated rows are candidates each, and
    repeated queries are answered each.  A shorter vector goes on with zeros; an empty
    one scores 0.  Fewer than ``k`` candidates give fewer rows, empty tables none.
    """
    config = config or SearchConfig()
    spark = vectors.sparkSession
    blocks = materialize(
        forward_blocks(vectors.where("vec_id IS NOT NULL AND vector IS NOT NULL"), config.block_rows), "blocks"
    )
    asked = materialize(
        queries.where("vec_id IS NOT NULL AND vector IS NOT NULL").select(
            "vec_id", "vector", F.monotonically_increasing_id().alias("query_row")
        ),
        "queries",
    )
    chunks = max(1, -(-asked.count() // config.query_chunk))
    found = None
    for c in range(chunks):
        rows = asked.where(F.pmod(F.xxhash64("query_row"), F.lit(chunks)) == c).collect()
        value = (
            np.array([r["query_row"] for r in rows], dtype="i8"),
            np.array([r["vec_id"] for r in rows], dtype="i8"),
            _matrix([r["vector"] for r in rows]),
        )
        hits = blocks.mapInArrow(_search(spark.sparkContext.broadcast(value), config.k), HIT_SCHEMA)
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= config.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
