"""Mixing sources to target weights in fixed-length blocks of words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from steploom.session import materialize

from .common import let, spare_name, words

#: Rounds of a keyed permutation; each moves about half of the values.
ROUNDS = 16
#: Tables of sources are broadcast up to this many rows and joined by shuffles beyond.
MAX_BROADCAST = 100_000
#: Rows of a key that one task adds up in a running sum; beyond, sums of such runs are added up first.
RUN = 4096
#: A prime: places of a shard are a multiple of it apart, so that its sources alternate.
STRIDE = 1_000_003


@dataclass(frozen=True)
class MixConfig:
    """``weights`` go to the sources in code point order (NULL last) and repeat.

    ``block``: words in a block.  ``shard_slots``: blocks in an output shard.
    ``max_repeats``: how often a source may be used up.  ``run_rows``: documents of a
    source that one task numbers.  ``task_slots``: slots that one task draws.
    """

    weights: Sequence[int] = (5, 2, 1)
    max_repeats: int = 3
    block: int = 64
    shard_slots: int = 4096
    run_rows: int = 4096
    task_slots: int = 1 << 17
    seed: int = 17

    def __post_init__(self) -> None:
        if not 0 < self.shard_slots < STRIDE:
            raise ValueError(f"shard_slots must lie between 1 and {STRIDE - 1}")


def permuted(x: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Place of ``x`` in a pseudorandom permutation of ``0 .. size - 1`` that ``key`` selects.

    Each round pairs every value with its mirror image around a keyed point and swaps
    the pair if a hash of the pair says so: a bijection for any size, without a table.
    """

    def step(at: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, r), size) - at, size)
        swap = F.pmod(F.xxhash64(key, r, F.greatest(at, mirror)), F.lit(2)) == 1
        return F.when(swap, mirror).otherwise(at)

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), x.cast("long"), step)


def target_sizes(sizes: list[tuple[str | None, int]], config: MixConfig) -> list[float]:
    """Words to take of each source.

    The sum of all sizes is shared by weight.  A source that would be used more than
    ``max_repeats`` times stops there, and what is left is shared among the others again.
    """
    weights = [config.weights[i % len(config.weights)] for i in range(len(sizes))]
    limit = [config.max_repeats * n for _, n in sizes]
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(n for _, n in sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / total > limit[i]}
        if not over:
            for i in free:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(limit[i])
        left -= sum(limit[i] for i in over)
        free -= over
    return targets


def _source_plan(like: DataFrame, totals: list[tuple[str | None, int]], config: MixConfig) -> DataFrame:
    """One row per source: its number, target, blocks and slots to fill."""
    targets, rows = target_sizes(totals, config), []
    for no, ((name, size), target) in enumerate(zip(totals, targets, strict=True)):
        blocks = -(-size // config.block)
        turns = min(config.max_repeats, int(target // size)) if size else 0
        rest = min(blocks, round((target - turns * size) / config.block)) if turns < config.max_repeats else 0
        slots = turns * blocks + rest
        rows.append((no, name, size, target, blocks, slots))
    schema = "no int, source string, source_size long, target double, blocks long, slots long"
    return like.sparkSession.createDataFrame(rows, schema)


def _bounded(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MAX_BROADCAST else table


def with_base(rows: DataFrame, keys: Sequence[str], at: str, amount: str) -> DataFrame:
    """Add ``base``: the sum of ``amount`` over the key's rows with a smaller ``at`` (whole numbers, each once in a key).

    Summed in two levels, so a key with any number of rows is spread over tasks.
    """
    whole = Window.unboundedPreceding
    dealt = rows.withColumn("_run", F.floor(F.col(at) / RUN))
    sums = dealt.groupBy(*keys, "_run").agg(F.sum(amount).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_run").rowsBetween(whole, -1))
    names = {k: f"_of_{k}" for k in (*keys, "_run")}
    starts = sums.select(*[F.col(k).alias(n) for k, n in names.items()], F.coalesce(before, F.lit(0)).alias("_start"))
    inner = F.sum(amount).over(Window.partitionBy(*keys, "_run").orderBy(at).rowsBetween(whole, -1))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    placed = dealt.withColumn("_inner", F.coalesce(inner, F.lit(0))).join(starts, same)
    return placed.select(*rows.columns, (F.col("_start") + F.col("_inner")).alias("base"))


def number_words(docs: DataFrame, config: MixConfig) -> DataFrame:
    """Add ``start``: the place of a document's first word among all words of its source,
    and ``row_key`` with ``nth``, which name a row even if its id is NULL or repeated.

    ``docs`` holds ``source``, ``doc_id``, ``size`` and ``tie``.  A source is dealt into runs by a hash of
    the id, so no source is sorted in one task; run totals are summed first.
    """
    runs = F.pmod(F.xxhash64("doc_id", "tie"), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / config.run_rows)))
    dealt = docs.withColumn("run", runs)
    sums = dealt.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
    starts = with_base(sums, ["source"], "run", "run_size").select(F.col("source").alias("s"), F.col("run").alias("r"), "base")
    inside = Window.partitionBy("source", "run").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    numbered = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))).select(
        *docs.columns, (F.col("base") + F.col("inner")).alias("start"), F.xxhash64("doc_id", "source", "tie").alias("row_key")
    )
    equal = Window.partitionBy("row_key").orderBy("doc_id", "tie", "source", "start")
    return numbered.withColumn("nth", F.row_number().over(equal))


def alias_rows(slots: Sequence[int]) -> list[tuple[int, int, int]]:
    """``cell, below, other`` for each source: how to draw sources by their slots in one look-up.

    Draw a cell and a number under the total of all slots, both evenly: the source is the cell's own if the
    number is less than ``below``, else the other.  All in whole numbers, so shares are exact.
    """
    total, n = sum(slots), len(slots)
    left, below, other = [w * n for w in slots], [total] * n, list(range(n))
    small, large = [i for i in range(n) if left[i] < total], [i for i in range(n) if left[i] >= total]
    while small and large:
        i, giver = small.pop(), large[-1]
        below[i], other[i] = left[i], giver
        left[giver] -= total - left[i]
        if left[giver] < total:
            small.append(large.pop())
    return list(zip(range(n), below, other, strict=True))


def _tasks(spark: SparkSession, slots: int, config: MixConfig) -> int:
    return max(spark.sparkContext.defaultParallelism, slots // config.task_slots)


def shard_draws(like: DataFrame, slots: Sequence[int], config: MixConfig) -> DataFrame:
    """``shard, no, n``: multinomial source counts of each output shard, with shares as the sources' ``slots``.

    Every slot of a shard draws its source on its own; counts are combined in the task that draws a shard.
    """
    total, spark = sum(slots), like.sparkSession
    cells = spark.createDataFrame(alias_rows(slots), "cell int, below long, other int")
    drawn = spark.range(0, total, 1, _tasks(spark, total, config)).select(
        F.floor(F.col("id") / config.shard_slots).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(config.seed), F.lit("cell")), F.lit(max(len(slots), 1))).cast("int").alias("cell"),
        F.pmod(F.xxhash64("id", F.lit(config.seed), F.lit("share")), F.lit(max(total, 1))).alias("share"),
    )
    no = F.when(F.col("share") < F.col("below"), F.col("cell")).otherwise(F.col("other"))
    met = drawn.join(_bounded(cells, len(slots)), "cell").select("shard", no.alias("no"))
    return met.groupBy("shard", "no").agg(F.count(F.lit(1)).alias("n"))


def settled_draws(draws: DataFrame, slots: Sequence[int], config: MixConfig) -> DataFrame:
    """The draws with each source's sum over all shards brought to its ``slots``.

    Sums of draws miss the targets by about their square root.  A source drawn too often gives
    that many slots back, spread evenly over its draws; sources drawn too seldom take them in a keyed random order.
    """
    spark = draws.sparkSession
    got = {r["no"]: r["n"] for r in draws.groupBy("no").agg(F.sum("n").alias("n")).collect()}
    over = [(no, got.get(no, 0), max(0, got.get(no, 0) - w)) for no, w in enumerate(slots)]
    short = [(no, w - got.get(no, 0)) for no, w in enumerate(slots) if w > got.get(no, 0)]
    moved = sum(n for _, n in short)
    if not moved:
        return draws
    surplus = spark.createDataFrame([r for r in over if r[1]], "no int, drawn long, surplus long")
    upto = lambda k: F.expr(f"cast(({k}) * cast(surplus as decimal(20, 0)) div drawn as long)")
    based = with_base(draws, ["no"], "shard", "n").join(_bounded(surplus, len(slots)), "no")
    given = materialize(based.select("shard", "no", "n", (upto("base + n") - upto("base")).alias("given")), "given")

    freed = given.groupBy("shard").agg(F.sum("given").alias("freed")).where("freed > 0").withColumn("all", F.lit(0))
    place = F.explode(F.sequence("base", F.col("base") + F.col("freed") - 1))
    places = with_base(freed, ["all"], "shard", "freed").select("shard", place.alias("place"))
    first, rows = 0, []
    for no, n in short:
        rows.append((no, first, first + n - 1))
        first += n
    takers = spark.createDataFrame(rows, "no int, first long, last long").select("no", F.explode(F.sequence("first", "last")).alias("turn"))
    takers = takers.select("no", permuted(F.col("turn"), F.lit(moved).cast("long"), F.lit(config.seed + 1)).alias("place"))
    taken = places.join(takers, "place").select("shard", "no", F.lit(1).cast("long").alias("n"))
    kept = given.select("shard", "no", (F.col("n") - F.col("given")).alias("n"))
    return kept.unionByName(taken).groupBy("shard", "no").agg(F.sum("n").alias("n")).where("n > 0")


def draw_slots(like: DataFrame, plan: DataFrame, config: MixConfig) -> DataFrame:
    """``shard``, ``slot``, ``source``, ``block`` and ``turn`` of every slot of the output.

    Each shard draws its source counts (:func:`shard_draws`); the sums over all shards are brought to the targets
    (:func:`settled_draws`).  Running sums of a source's counts number its slots; the k-th
    takes block ``permutation(k mod blocks)`` of turn ``k div blocks``.  A shard's sources alternate along its slots.
    """
    slots = [r["slots"] for r in plan.select("no", "slots").orderBy("no").collect()]
    total = sum(slots)
    draws = materialize(shard_draws(like, slots, config), "draws")
    counts = materialize(settled_draws(draws, slots, config), "counts")
    in_shard = Window.partitionBy("shard").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    numbered = with_base(counts, ["no"], "shard", "n").withColumn("offset", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
    # A count is a small row that stands for many slots: tasks are dealt by slots, not by the size of the counts.
    each = numbered.repartition(_tasks(like.sparkSession, total, config), "shard").select("shard", "no", "base", "offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    size = F.least(F.lit(config.shard_slots).cast("long"), F.lit(total).cast("long") - F.col("shard") * config.shard_slots)
    turned = F.pmod(F.xxhash64("shard", F.lit(config.seed)), size)
    k = F.col("base") + F.col("i")
    owners = plan.select("no", "source", "blocks")
    return each.join(_bounded(owners, len(slots)), "no").select(
        "shard",
        F.pmod((F.col("offset") + F.col("i")) * STRIDE + turned, size).alias("slot"),
        "source",
        permuted(F.pmod(k, F.col("blocks")), F.col("blocks"), F.hash("source", F.lit(config.seed))).alias("block"),
        F.floor(k / F.col("blocks")).alias("turn"),
    )


@dataclass(frozen=True)
class Mix:
    """``documents``: key columns, ``size``, ``source_size``, ``target``, ``taken``.

    ``slots``: which block fills which slot.  ``pieces``: a row for each run of words
    of a document within a block and each turn that takes it.
    """

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def mix_sources(
    docs: DataFrame, config: MixConfig | None = None, key: str = "doc_id", text: str = "text", source: str = "source"
) -> Mix:
    """Take words of every source near its target, in blocks, repeating at most ``max_repeats`` times.

    The words of a source, document after document, are cut into blocks of ``block``
    words.  Slots and blocks meet by (source, block number), so no source is a hot key.
    The plan depends only on ids, texts and ``seed``: reruns agree.

    A NULL source is one source, the last.  NULL and empty texts have size 0 and give
    nothing.  Rows with equal or NULL ids are told apart by a hash of their text; equal
    rows share what they take evenly in the order of their places, each as a row of its own.
    One row for each source reaches the driver; tables of sources are broadcast up to ``MAX_BROADCAST`` rows.
    """
    config = config or MixConfig()
    sized = materialize(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.size(words(F.col(text))).cast("long").alias("size"),
            F.xxhash64(text).alias("tie"),
        ),
        "sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n_docs"))
    rows = sorted(per_source.collect(), key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    plan = _source_plan(docs, [(r["source"], r["size"]) for r in rows], config)
    counts = docs.sparkSession.createDataFrame(
        [(r["source"], r["n_docs"]) for r in rows], "counted string, n_docs long"
    )
    known = sized.join(_bounded(counts, len(rows)), F.col("source").eqNullSafe(F.col("counted"))).drop("counted")
    numbered = materialize(number_words(known, config), "numbered")

    slots = draw_slots(docs, plan, config)
    used = slots.groupBy(F.col("source").alias("used_source"), F.col("block").alias("used_block")).agg(
        F.collect_list("turn").alias("turns")
    )
    blocks = F.sequence(F.floor(F.col("start") / config.block), F.floor((F.col("start") + F.col("size") - 1) / config.block))
    parts = numbered.where("size > 0").select("source", "row_key", "nth", "start", "size", F.explode(blocks).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * config.block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * config.block)
    met = parts.join(
        used, F.col("source").eqNullSafe(F.col("used_source")) & (F.col("block") == F.col("used_block"))
    ).select("row_key", "nth", "size", (low - F.col("start")).alias("begin"), (high - low).alias("length"), "turns")
    taken = met.groupBy("row_key", "nth").agg(F.sum(F.col("length") * F.size("turns")).alias("taken"))
    targets = plan.select(F.col("source").alias("p_source"), "source_size", "target")
    documents = (
        numbered.join(taken, ["row_key", "nth"], "left")
        .join(_bounded(targets, len(rows)), F.col("source").eqNullSafe(F.col("p_source")))
        .select(
            F.col("doc_id").alias(key), F.col("source"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
        )
    )
    pieces = met.select("row_key", "nth", "size", "begin", "length", F.explode("turns").alias("turn"))
    return Mix(documents, slots, pieces)


def mixed_documents(
    docs: DataFrame, config: MixConfig | None = None, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The mix as rows with the columns of ``docs``: one row for each document and turn that takes some of it.

    A turn that takes the whole document keeps its text as it is; one that takes some
    blocks keeps their words in order with the space that follows each.  A column
    ``n_chars``, if there is one, follows the text.
    """
    cuts = mix_sources(docs, config, key, text, source).pieces.groupBy("row_key", "nth", "turn", "size").agg(
        F.sort_array(F.collect_list(F.struct("begin", "length"))).alias("cuts"), F.sum("length").alias("words")
    )
    take = F.struct(F.col("turn"), F.col("cuts"), (F.col("words") == F.col("size")).alias("whole"))
    takes = cuts.groupBy("row_key", "nth").agg(F.sort_array(F.collect_list(take)).alias("takes"))
    name = {c: spare_name(docs, f"_mix_{c}") for c in ("row_key", "nth", "takes", "tie")}
    takes = takes.select(*[F.col(c).alias(name[c]) for c in ("row_key", "nth", "takes")])
    own_key, own_nth = spare_name(docs, "_own_key"), spare_name(docs, "_own_nth")
    tie = F.xxhash64(text)
    rows = docs.withColumn(own_key, F.xxhash64(F.col(key), F.col(source), tie))
    rows = rows.withColumn(own_nth, F.row_number().over(Window.partitionBy(own_key).orderBy(F.col(key), tie, F.col(source))))
    met = rows.join(takes, (F.col(own_key) == F.col(name["row_key"])) & (F.col(own_nth) == F.col(name["nth"])))
    met = met.withColumn(name["takes"], F.explode(name["takes"]))
    parts = F.regexp_extract_all(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*"), F.lit(0))
    one = F.col(name["takes"])
    cut = let(
        parts,
        lambda p: F.concat_ws(
            "", F.flatten(F.transform(one["cuts"], lambda c: F.slice(p, c["begin"].cast("int") + 1, c["length"].cast("int"))))
        ),
    )
    content = F.when(one["whole"], F.col(text)).otherwise(cut)
    met = met.withColumn(name["tie"], content)
    lengths = {"n_chars": F.length(name["tie"]).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    new = {text: F.col(name["tie"]), **lengths}
    return met.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
