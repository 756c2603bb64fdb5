"""What filters take from a corpus in every order, and what each is worth: potentials of the removal game."""

from __future__ import annotations

from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize

from .common import let, words

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Filters: those of ``text_failures``, then the one that finds copies.
LETTERS = "ABCDE"
DUPLICATE = "E"
#: Beyond this many filters there are too many orders to list.
MAX_FILTERS = 7


def text_failures(text: Column) -> Column:
    """Bits of the filters that see one text and fail it (bit i: ``LETTERS[i]``); NULL is an empty text."""
    full = F.coalesce(text, F.lit(""))
    upper = F.length(full) - F.length(F.translate(full, _UPPER, ""))

    def bits(found: Column) -> Column:
        failed = {
            "A": F.size(found) < 50,
            "B": 100 * F.size(F.array_distinct(found)) < 65 * F.size(found),
            "C": 100 * upper > 5 * F.length(full),
            "D": full.rlike("[#$%&*|]"),
        }
        return sum((F.when(c, 1 << LETTERS.index(k)).otherwise(0) for k, c in failed.items()), F.lit(0))

    return let(words(full), bits)


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part that fail exactly the filters of ``mask`` (bit i: ``LETTERS[i]``).

    Texts do not leave their task: what is shuffled is an id, a digest of the text and the
    mask.  The first document of each text is the smallest id of its digest, a minimum
    combined before the shuffle; that row is then found by id and digest, so a text with any number
    of copies is no hot key.  Labels meet documents by id.

    A NULL text is empty, a NULL part is ``""``.  Rows with equal ids count each; none is a copy of
    another.  A document without an id has no label and, as no id is smaller than none, is no copy.
    Labels given more than once count once, if any of them is 1.
    """
    rows = docs.select(
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.col(key).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"),
        text_failures(F.col(text)).alias("mask"),
    )
    stored = materialize(rows, "audited")
    first = stored.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    firsts = first.select(F.col("first_id"), F.col("digest").alias("first_digest"))
    is_one = lambda name: F.max((F.coalesce(F.col(name), F.lit(0)) == 1).cast("int"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        is_one("quality").alias("good"), is_one("toxic").alias("toxic")
    )
    met = stored.join(firsts, (F.col("doc_id") == F.col("first_id")) & (F.col("digest") == F.col("first_digest")), "left")
    met = met.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    copy = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    bit = 1 << LETTERS.index(DUPLICATE)
    return met.groupBy("part", (F.col("mask") + F.when(copy, bit).otherwise(0)).alias("mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"),
    )


def removal_games(counts: DataFrame, filters: int, weights: tuple[str, ...] = ("n", "good", "toxic")) -> DataFrame:
    """A row per part with an array for each weight: what the filters of coalition ``S`` (its index) remove together.

    At most one row for each part and mask comes in; each is counted in the coalitions that hold a filter it fails.
    """
    holds = lambda s, value: f"sum(if((mask & {s}) <> 0, {value}, 0))"
    game = lambda value: f"array({', '.join(holds(s, value) for s in range(1 << filters))})"
    return counts.groupBy("part").agg(
        F.sum("n").alias("all"),
        F.expr(f"array({', '.join(holds(1 << i, 'n') for i in range(filters))})").alias("fails"),
        *[F.expr(game(w)).alias(w) for w in weights],
    )


def potential(game: Column, filters: int) -> Column:
    """Hart and Mas-Colell's potential of every coalition, times the least common multiple of 1 to ``filters``, which makes it whole.

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|, so that the potentials' differences
    by one member add up to v(S).  Subsets have smaller numbers, so one pass in order does.
    """
    unit = lcm(*range(1, filters + 1))

    def without(known: Column, s: Column, i: int) -> Column:
        member = s.bitwiseAND(1 << i) != 0
        return F.when(member, F.get(known, s - F.when(member, 1 << i).otherwise(0))).otherwise(0)

    def step(known: Column, s: Column) -> Column:
        total = F.get(game, s) * unit + sum((without(known, s, i) for i in range(filters)), F.lit(0))
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), step)


def audit_orders(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order of the filters and step from ``failure_counts``.

    ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` follow from differences
    of the removal game between the coalition that has run and the one before.  ``shapley``
    is the filter's removals summed over all orders: its Shapley value, which is the
    potential of all filters minus that of all but it, times the number of orders.
    All are exact integers.  No rows give no rows.
    """
    k = len(letters)
    if not 0 < k <= MAX_FILTERS or len(set(letters)) < k:
        raise ValueError(f"1 to {MAX_FILTERS} different filters")
    games = removal_games(counts, k)
    games = games.select("*", potential(F.col("n"), k).alias("worth"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    steps = games.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")
    )

    def coalition(upto: Column) -> Column:
        ran = F.substring("filter_order", F.lit(1), upto)
        return sum((F.when(F.contains(ran, F.lit(c)), 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0))

    own = F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    known = steps.withColumns({"before": coalition(F.col("step") - 1), "after": coalition(F.col("step")), "own": own})
    gained = lambda game: F.get(game, F.col("after")) - F.get(game, F.col("before"))
    grand, unit = (1 << k) - 1, lcm(*range(1, k + 1))
    others = F.lit(grand) - F.get(F.array(*[F.lit(1 << i) for i in range(k)]), F.col("own"))
    without = lambda game: F.get(game, F.lit(grand)) - F.get(game, others)
    return known.select(
        "part",
        "filter_order",
        "step",
        (F.col("all") - F.get("n", F.col("after"))).alias("kept"),
        gained("n").alias("removed"),
        (F.get("fails", F.col("own")) - gained("n")).alias("redundant"),
        without("n").alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        (without("worth") * (factorial(k) // unit)).alias("shapley"),
    )
