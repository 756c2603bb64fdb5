"""How far the sources of a language stand apart in their use of terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from steploom.session import materialize

from .termruns import Runs, TermCounter, term_strings

_COUNTED = "lang string, source string, term string, n long, docs long"
#: Parts in which a language of very many sources is met.
_SALTS = 16


@dataclass(frozen=True)
class DivergenceConfig:
    """``min_docs``: documents of its language that a term must occur in.  ``top``: terms given per group.

    A term's share is ``1 + floor(scale * (count + 2) / (all + 2 * terms))``.  ``cell``:
    sources that are compared together; ``cell_terms``: terms that are, at most.
    """

    min_docs: int = 10
    top: int = 10
    scale: int = 1_000_000_000
    cell: int = 64
    cell_terms: int = 8192

    def __post_init__(self) -> None:
        if not 0 < self.scale <= 2_000_000_000:
            raise ValueError("squares of shares must fit 64 bits")


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers: dict[tuple[str, str], int] = {}
    counter = TermCounter()

    def rows(runs: list[tuple[int, Runs]]) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([k[i] for k in numbers], pa.string()) for i in (0, 1))
        for bucket, r in runs:
            for lo in range(0, len(r), 65_536):
                part = slice(lo, lo + 65_536)
                of = pa.array(r.group[part])
                yield pa.RecordBatch.from_arrays(
                    [langs.take(of), sources.take(of), term_strings(bucket, [k[part] for k in r.keys]), pa.array(r.n[part]), pa.array(r.docs[part])],
                    names=["lang", "source", "term", "n", "docs"],
                )

    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        groups = np.fromiter((numbers.setdefault(p, len(numbers)) for p in pairs), dtype=np.int64, count=batch.num_rows)
        yield from rows(counter.add(batch.column(2), groups))
    yield from rows(counter.rest())


def kept_terms(docs: DataFrame, config: DivergenceConfig) -> DataFrame:
    """``lang, term, total, counts``: the kept terms of each language, their occurrences, and those per source.

    Tasks pack, sort and count the terms of their documents; rows are then dealt by language
    and term, so one shuffle serves the sums per source and per language.
    """
    counted = docs.mapInArrow(_counting, _COUNTED).repartition("lang", "term")
    by_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return by_term.where(F.col("docs") >= config.min_docs).drop("docs")


def _share(count: Column, everything: Column, terms: Column, scale: int) -> Column:
    """The smoothed share of a count, in exact arithmetic; 1 where there are no terms."""
    above = F.lit(scale).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = (everything + 2 * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", above, below)).otherwise(1).cast("long")


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def shared_parts(p: np.ndarray, rest: np.ndarray, cell: int) -> Iterator[tuple[int, int, int]]:
    """For source pairs (a < b) the part of their distance that terms of both have beyond the sum of what each has alone.

    ``p``: shares, a row per term, a column per source; ``rest``: the sources' shares of terms that
    they do not have, which also stand in ``p`` where that is so; such entries give 0.
    """
    k = p.shape[1]
    for lo in range(0, k, cell):
        for low in range(lo, k, cell):
            some = (p[:, lo : lo + cell] != rest[lo : lo + cell]).any(1) & (p[:, low : low + cell] != rest[low : low + cell]).any(1)
            left, right = p[some, lo : lo + cell], p[some, low : low + cell]
            for a in range(left.shape[1]):
                first = max(0, lo + a + 1 - low)
                x, x0 = left[:, a, None], rest[lo + a]
                y, y0 = right[:, first:], rest[low + first : low + cell]
                sums = (_distances(x, y) - _distances(x, y0) - _distances(x0, y)).sum(0) + len(left) * _distances(x0, y0)
                for b in np.flatnonzero(sums).tolist():
                    yield lo + a, low + first + b, int(sums[b])


def _last_term(batch: pa.RecordBatch) -> tuple[tuple[str, str], int]:
    """Language and term of the last row of a sorted batch, and the first of its rows that has them."""
    lang, term = (batch.column(batch.schema.get_field_index(c)) for c in ("lang", "term"))
    last = (lang[-1], term[-1])
    other = pc.or_(pc.not_equal(lang, last[0]), pc.not_equal(term, last[1])).to_numpy(zero_copy_only=False)
    return (last[0].as_py(), last[1].as_py()), int(np.flatnonzero(other).max(initial=-1)) + 1


def _compared(config: DivergenceConfig):
    """Rows arrive sorted by language and term; each run of whole terms gives a row for each pair of its sources."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # The rows of a term may go on in the next batch, so the last term waits for it.
            before, (last, at) = last, _last_term(batch)
            if (at or last != before) and sum(b.num_rows for b in held) + at >= 16 * config.cell_terms:
                yield from done([*held, batch.slice(0, at)])
                held = [batch.slice(at)]
            else:
                held.append(batch)
        if held:
            yield from done(held)

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: table.column(name).combine_chunks()
        langs, terms = column("lang").dictionary_encode(), column("term").dictionary_encode()
        code, term = (np.asarray(c.indices, dtype=np.int64) for c in (langs, terms))
        sources, names = (f(column("source").dictionary_encode()) for f in (lambda c: np.asarray(c.indices), lambda c: c.dictionary.to_pylist()))
        share, none = (column(c).to_numpy(zero_copy_only=False) for c in ("p", "p0"))
        out: list[tuple[str, str, str, int]] = []
        for c, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(code == c)
            own_sources, col = np.unique(sources[own], return_inverse=True)
            rest = np.empty(len(own_sources), dtype=np.int64)
            rest[col] = none[own]
            own_terms, row = np.unique(term[own], return_inverse=True)
            step = max(1, min(config.cell_terms, (4 << 20) // len(own_sources)))
            order = np.argsort(row, kind="stable")
            for lo in range(0, len(own_terms), step):
                at = order[np.searchsorted(row[order], lo) : np.searchsorted(row[order], lo + step)]
                p = np.tile(rest, (min(step, len(own_terms) - lo), 1))
                p[row[at] - lo, col[at]] = share[own[at]]
                for a, b, value in shared_parts(p, rest, config.cell):
                    out.append((lang, names[own_sources[a]], names[own_sources[b]], value))
                    if len(out) >= 65_536:
                        yield batch_of(out)
                        out = []
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple[str, str, str, int]]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["lang", "a", "b", "value"])

    return compare


def source_divergence(docs: DataFrame, config: DivergenceConfig | None = None) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of a language and a source.

    Part ``pair``: the distance to each other source of the language, all of them; part
    ``term``: the kept terms that the group has and uses more than its language, the ``top`` first.
    Equal values go by the item's bytes.

    The distance of two sources is a sum over all kept terms.  It is put together from what
    each has alone (a histogram of its shares met with the other's share of missing terms) and
    from a correction for terms that both have, summed in numpy over runs of terms; so terms that
    neither has cost nothing, and no pairs of rows are made within a term.

    NULL texts, languages and sources are empty strings.  Equal rows count each.  A group without terms
    has its pairs, and no terms.  A language without kept terms has distances of 0.  No rows give no rows.
    """
    config = config or DivergenceConfig()
    own = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = materialize(kept_terms(own, config), "kept-terms")
    entries = kept.select("lang", "term", "total", F.inline("counts"))
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("everything"))
    sizes = kept.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_everything"))
    groups = own.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(sizes, F.col("lang") == F.col("of"), "left")
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("everything", "terms", "lang_everything")}
    groups = groups.select("lang", "source", *[c.alias(n) for n, c in filled.items()])
    groups = materialize(groups.withColumn("p0", _share(F.lit(0), F.col("everything"), F.col("terms"), config.scale)), "groups")

    priced = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "p0",
        _share(F.col("n"), F.col("everything"), F.col("terms"), config.scale).alias("p"),
        _share(F.col("total"), F.col("lang_everything"), F.col("terms"), config.scale).alias("q"),
    )
    priced = materialize(priced, "shares")

    pairs = _pairs(priced, groups, config).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    above = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = above.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= config.top)
    return pairs.withColumn("rank", F.row_number().over(ranking)).unionByName(top)


def _pairs(priced: DataFrame, groups: DataFrame, config: DivergenceConfig) -> DataFrame:
    # Shares and how many terms have them; the terms that a group does not have share one value.
    some = priced.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    had = some.groupBy("lang", "source").agg(F.sum("m").alias("had"))
    none = groups.join(had, ["lang", "source"], "left").select(
        "lang", "source", F.col("p0").alias("p"), (F.col("terms") - F.coalesce("had", F.lit(0))).alias("m")
    )
    base = groups.select("lang", "source", "p0", "terms")
    shares = some.unionByName(none).join(base, ["lang", "source"])
    salted = shares.withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(_SALTS)))
    others = base.select(
        F.col("lang").alias("in_lang"), F.col("source").alias("item"), F.col("p0").alias("q0"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("in_salt")
    )
    met = salted.join(others, (F.col("lang") == F.col("in_lang")) & (F.col("salt") == F.col("in_salt")) & (F.col("source") != F.col("item")))
    alone = met.groupBy("lang", "source", "item").agg(
        F.sum(F.col("m") * _distance(F.col("p"), F.col("q0"))).alias("value"),
        F.max(F.col("terms") * _distance(F.col("p0"), F.col("q0"))).alias("twice"),
    )
    alone = materialize(alone, "alone")
    dealt = priced.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    both = materialize(dealt.mapInArrow(_compared(config), "lang string, a string, b string, value long"), "both")
    turned = lambda df, a, b, value: df.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), value.alias("value"))
    parts = [
        turned(alone, "source", "item", F.col("value") - F.col("twice")),
        turned(alone, "item", "source", F.col("value")),
        turned(both, "a", "b", F.col("value")),
        turned(both, "b", "a", F.col("value")),
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
