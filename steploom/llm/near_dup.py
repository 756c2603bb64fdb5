"""Near-duplicate documents: SetSketch bands for candidates, likelihood to rank them, full sets to confirm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize

from .common import spare_name
from .components import connected_components
from .setsketch import SketchConfig, band_values, likely_similarity, sketches
from .wordhash import normalized, window_hashes

SKETCH_SCHEMA = "doc_id long, n_shingles long, n_bytes long, set_id binary, bands array<long>"
_SKETCH_ROWS = 256


@dataclass(frozen=True)
class NearDupConfig:
    """Documents are linked if ``100 * common >= percent * union`` of their distinct shingles.

    With 40 bands of 6 registers a pair at 0.85 is missed with probability 6e-9, with 60
    bands a pair at 0.8 with 1e-8.  ``slack``: a candidate is compared in full unless its likely
    similarity is this many standard errors below the limit.  ``block_docs`` and
    ``block_bytes``: documents of a candidate group that one task compares.  A group of at least
    ``mixing_blocks`` blocks is dealt into other blocks ``mixing_rounds`` times before its
    stragglers meet all others; that saves comparisons and changes no result.
    """

    percent: int = 85
    width: int = 5
    sketch: SketchConfig = field(default_factory=lambda: SketchConfig(bands=40, rows=6))
    slack: float = 7.0
    block_docs: int = 256
    block_bytes: int = 8 << 20
    mixing_rounds: int = 2
    mixing_blocks: int = 32


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    return [np.unique(h) for h in window_hashes([normalized(t) for t in texts], width)]


def _sketched(config: NearDupConfig):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _SKETCH_ROWS):
                batch = whole.slice(lo, _SKETCH_ROWS)
                texts = batch.column(1).to_pylist()
                sets = shingle_sets(texts, config.width)
                filled = [i for i, s in enumerate(sets) if len(s)]
                bands: list[np.ndarray | None] = [None] * len(sets)
                if filled:
                    values = band_values(sketches([sets[i] for i in filled], config.sketch), config.sketch)
                    for i, v in zip(filled, values, strict=True):
                        bands[i] = v
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([len(t or "") for t in texts], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "n_bytes", "set_id", "bands"],
                )

    return sketch


class _Union:
    def __init__(self, labels: list[int]):
        self.root: dict[int, int] = {}
        self.labels = labels

    def find(self, x: int) -> int:
        while (up := self.root.get(x, x)) != x:
            self.root[x] = x = self.root.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.root[max(a, b)] = min(a, b)
        return True


def common_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of set pairs, one by one or as products of presence matrices, whichever is less work."""
    sizes = np.array([len(s) for s in sets])
    shared, counts = np.unique(np.concatenate(sets), return_counts=True)
    shared = shared[counts > 1]
    one_by_one = (sizes[a] + sizes[b]).sum() * 30 + len(a) * 8_000
    together = len(shared) * len(sets) ** 2 // 10 + sizes.sum() * 60
    if one_by_one <= together:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
    rows = np.repeat(np.arange(len(sets)), sizes)
    place = np.searchsorted(shared, flat := np.concatenate(sets))
    known = place < len(shared)
    known[known] = shared[place[known]] == flat[known]
    rows, place = rows[known], place[known]
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    step = 4096
    for lo in range(0, len(shared), step):
        s, e = np.searchsorted(place, [lo, lo + step])
        present = np.zeros((len(sets), min(step, len(shared) - lo)), dtype=np.float32)
        present[rows[s:e], place[s:e] - lo] = 1
        total += present @ present.T
    return total[a, b].astype(np.int64)


def block_links(
    ids: list[int], labels: list[int], sides: list[int], texts: list[str | None], config: NearDupConfig
) -> list[tuple[int, int]]:
    """Links that join different components among the documents of one block.

    Sides 0 and 1 are compared with each other; documents of side 2 also among themselves.
    A pair is compared if it shares a band, its sizes allow the similarity, and its likely
    similarity is not far below the limit.
    """
    sets = shingle_sets(texts, config.width)
    sizes = np.array([len(s) for s in sets])
    registers = np.concatenate([sketches(sets[i : i + _SKETCH_ROWS], config.sketch) for i in range(0, len(sets), _SKETCH_ROWS)])
    bands = band_values(registers, config.sketch)
    label, side = np.array(labels), np.array(sides)
    met = np.zeros((len(ids), len(ids)), dtype=bool)
    for k in range(bands.shape[1]):
        met |= bands[:, k][:, None] == bands[:, k][None, :]
    met &= label[:, None] != label[None, :]
    met &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
    met &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= config.percent * np.maximum(sizes[:, None], sizes[None, :])
    a, b = np.nonzero(np.triu(met, 1))
    if not len(a):
        return []
    likely = np.empty(len(a))
    for lo in range(0, len(a), 8192):
        x, y = a[lo : lo + 8192], b[lo : lo + 8192]
        above = (registers[x] > registers[y]).sum(1)
        below = (registers[x] < registers[y]).sum(1)
        likely[lo : lo + 8192] = likely_similarity(above, below, sizes[x], sizes[y], config.sketch)
    limit = config.percent / 100
    error = np.sqrt(limit * (1 - limit) / config.sketch.registers)
    near = likely >= limit - config.slack * error
    a, b = a[near], b[near]
    if not len(a):
        return []
    common = common_counts(sets, a, b)
    linked = 100 * common >= config.percent * (sizes[a] + sizes[b] - common)
    groups, found = _Union(labels), []
    for i, j in zip(a[linked].tolist(), b[linked].tolist(), strict=True):
        if groups.join(labels[i], labels[j]):
            found.append((ids[i], ids[j]))
    return found


def _linked(config: NearDupConfig):
    """Blocks arrive sorted by key; each is compared once it is complete."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, []

        def links() -> pa.RecordBatch:
            pairs = block_links(*map(list, zip(*block, strict=True)), config) if len(block) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for row in zip(*(c.to_pylist() for c in columns), strict=True):
                if row[0] != key and block:
                    yield links()
                    block = []
                key = row[0]
                block.append(row[1:])
        if block:
            yield links()

    return link


def _compare(rows: DataFrame, config: NearDupConfig) -> DataFrame:
    """Links among rows of ``block`` (a struct), ``doc_id``, ``label``, ``side``, ``text``."""
    dealt = rows.select("block", "doc_id", "label", "side", "text").repartition("block").sortWithinPartitions("block", "doc_id")
    keyed = dealt.select(F.to_json("block").alias("key"), "doc_id", "label", "side", "text")
    return keyed.mapInArrow(_linked(config), "a long, b long")


def _place(salt: int, blocks) -> F.Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(salt)), blocks)


def near_duplicate_components(docs: DataFrame, config: NearDupConfig | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    1. Every text becomes a set of word shingles and a SetSketch; documents with equal
       sets form one class, which is represented by its smallest id from here on.
    2. Representatives that share the registers of a band are candidates.  Each bucket
       links its members to its smallest one only; the components of these links are
       candidate groups.
    3. A group is compared in blocks of bounded size.  A group of one block is done then.
       Of larger ones, documents outside a group's largest component then meet all others, block by block.
    4. Components of the confirmed links name the groups of near-duplicates.

    No pair leaves a task unless it joins two components.  No number of candidates is capped.
    Ids are integers.  Rows with a NULL id cannot be named: they keep a NULL component and are kept.
    Texts without words are linked with nothing.  Rows with equal ids are one document;
    where their texts differ, the smallest text is compared.  No rows give no rows.
    """
    config = config or NearDupConfig()
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = materialize(own.mapInArrow(_sketched(config), SKETCH_SCHEMA), "sketches")
    named = sketched.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    # Stored, so that the join below is a plain one whose hot keys Spark can split.
    classes = materialize(named.groupBy("set_id").agg(F.min("doc_id").alias("rep")), "set-classes")
    is_rep = F.col("doc_id") == F.col("rep")
    classed = materialize(
        named.join(classes, "set_id").select("doc_id", "rep", "n_bytes", F.when(is_rep, F.col("bands")).alias("bands")), "classes"
    )
    links = _confirmed_links(own, classed.where(is_rep), config)
    edges = links.unionByName(classed.where(~is_rep).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = connected_components(edges).select(F.col("node").alias("doc_id"), F.col("component"))
    joined = sketched.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        F.col("doc_id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _confirmed_links(own: DataFrame, reps: DataFrame, config: NearDupConfig) -> DataFrame:
    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "value")).select(
        "doc_id", F.xxhash64("band", "value").alias("bucket")
    )
    buckets = banded.groupBy("bucket").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = buckets.where("first <> last").select("bucket", "first")
    groups = connected_components(_stars(banded.join(shared, "bucket")))
    sized = groups.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "grp")
    weights = reps.groupBy("doc_id").agg(F.max("n_bytes").alias("n_bytes"))
    totals = sized.join(weights, "doc_id").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / config.block_docs), F.ceil(F.col("bytes") / config.block_bytes), F.lit(1))
    # Stored, so that the join below is a plain one whose hot groups Spark can split.
    totals = materialize(totals.select("grp", blocks.alias("blocks")), "group-sizes")
    placed = materialize(sized.join(totals, "grp"), "groups")
    met = own.join(placed, "doc_id").groupBy("doc_id", "grp", "blocks").agg(F.min("text").alias("text"))
    compared = materialize(met, "candidates")

    two = F.lit(2)
    first = compared.select(
        F.struct("grp", _place(0, F.col("blocks")).alias("i"), F.lit(0).cast("long").alias("j")).alias("block"),
        "doc_id", F.col("doc_id").alias("label"), two.alias("side"), "text",
    )
    links = materialize(_compare(first, config), "links")
    large = compared.where("blocks > 1")
    if large.isEmpty():
        return links
    huge = compared.where(F.col("blocks") >= config.mixing_blocks)
    for salt in range(1, 1 + (0 if huge.isEmpty() else config.mixing_rounds)):
        labelled = _labelled(huge, links)
        again = labelled.select(
            F.struct("grp", _place(salt, F.col("blocks")).alias("i"), F.lit(0).cast("long").alias("j")).alias("block"),
            "doc_id", "label", two.alias("side"), "text",
        )
        links = links.unionByName(materialize(_compare(again, config), "links"))
    return links.unionByName(materialize(_compare(_stragglers(_labelled(large, links), config), config), "links"))


def _stars(met: DataFrame) -> DataFrame:
    """Edges that join each document with the firsts of its buckets.

    A document names its smallest first only, and that one the others: in a hot group these are the
    same few pairs for all members, so they fall together before anything is joined.  Edges may repeat.
    """
    firsts = met.groupBy("doc_id").agg(F.array_sort(F.collect_set("first")).alias("firsts"))
    hub = F.col("firsts")[0]
    ends = F.concat(F.array("doc_id"), F.slice("firsts", 2, F.size("firsts")))
    return firsts.select(hub.alias("a"), F.explode(ends).alias("b")).where("a <> b")


def _labelled(docs: DataFrame, links: DataFrame) -> DataFrame:
    """Documents with the smallest id of their component so far."""
    found = connected_components(links).select(F.col("node").alias("doc_id"), F.col("component"))
    return docs.join(found, "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component")


def _stragglers(labelled: DataFrame, config: NearDupConfig) -> DataFrame:
    """Blocks in which the documents outside the largest component of their group meet all others.

    Straggler blocks meet each other and every block of the largest component; blocks of
    the latter do not meet.
    """
    sizes = labelled.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("bytes"))
    main = sizes.groupBy("grp").agg(
        F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.sum("n").alias("all_n"), F.sum("bytes").alias("all_bytes"),
        F.max("n").alias("main_n"),
    )
    half = F.lit(config.block_docs // 2)
    by_bytes = F.ceil(F.col("all_bytes") / (config.block_bytes // 2))
    outside = F.greatest(F.ceil((F.col("all_n") - F.col("main_n")) / half), F.least(by_bytes, F.col("all_n") - F.col("main_n")))
    inside = F.greatest(F.ceil(F.col("main_n") / half), F.least(by_bytes, F.col("main_n")))
    plan = main.where("all_n > main_n").select(
        "grp", "main", F.greatest(outside, F.lit(1)).alias("outside"), F.greatest(inside, F.lit(1)).alias("inside")
    )
    rows = labelled.join(plan, "grp")
    is_main = F.col("label") == F.col("main")
    at = F.when(is_main, _place(91, F.col("inside"))).otherwise(_place(92, F.col("outside")))
    rows = rows.withColumn("main_doc", is_main).withColumn("at", at.cast("long"))
    of_main = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("outside") - 1),
        lambda i: F.struct(F.col("grp").alias("grp"), i.alias("i"), (-F.col("at") - 1).alias("j"), F.lit(1).alias("side")),
    )
    own = F.col("at")
    with_main = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("inside") - 1),
        lambda j: F.struct(F.col("grp").alias("grp"), own.alias("i"), (-j - 1).alias("j"), F.lit(0).alias("side")),
    )
    among = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("outside") - 1),
        lambda k: F.struct(
            F.col("grp").alias("grp"), F.least(own, k).alias("i"), F.greatest(own, k).alias("j"),
            F.when(k == own, 2).when(k < own, 1).otherwise(0).alias("side"),
        ),
    )
    tasks = F.when(F.col("main_doc"), of_main).otherwise(F.concat(with_main, among))
    spread = rows.withColumn("task", F.explode(tasks))
    return spread.select(
        F.struct("task.grp", "task.i", "task.j").alias("block"), "doc_id", "label", F.col("task.side").alias("side"), "text"
    )


def drop_near_duplicates(docs: DataFrame, config: NearDupConfig | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Rows with a NULL id stay.  Of rows with equal ids the one with the smallest text stays (a NULL
    text only if there is no other), which is the text that was compared; of equal texts the
    row with the smallest hash of all columns but maps.
    """
    verdicts = near_duplicate_components(docs, config, key, text)
    name = spare_name(docs, "_kept_id")
    kept = verdicts.where(F.col("kept") & F.col(key).isNotNull()).select(F.col(key).alias(name)).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    order = F.struct(F.col(text).isNull(), F.col(text), hashed)
    chosen = docs.join(kept, F.col(key) == F.col(name)).groupBy(name).agg(F.min_by(F.struct(*columns), order).alias("row"))
    return chosen.select("row.*").unionByName(docs.where(F.col(key).isNull()))
