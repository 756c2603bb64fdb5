"""Connected components by contraction, with the state of each round on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def contracted(edges: DataFrame, round_: int) -> tuple[DataFrame, DataFrame]:
    """One round over distinct ``edges`` (``a < b``): where each node goes (``node``, ``next``), and what edges are left.

    A node steps to the node with the most edges among itself and its neighbours, and from there
    once more; of equals the smallest hash is taken, which is another one every round.  So a star is settled in
    one round whatever its ids are, and chains shrink by halves and more.
    Edges get the new ends; those whose ends agree are settled and go, as do repeats.
    Counts and minima are combined before they are shuffled, and stored before they are joined, so the joins are
    plain ones that Spark can split at a node with very many edges.
    """
    hashed = F.shiftrightunsigned(F.xxhash64("node", F.lit(round_)), 32)
    counts = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    # One number, so that minima need no sort; it only chooses among neighbours, any of which is right.
    ranks = materialize(counts.select("node", (hashed - F.least("n", F.lit(1 << 30)) * F.lit(1 << 32)).alias("place")), "ranks")
    at = lambda end: ranks.select(F.col("node").alias(end), F.col("place").alias(f"{end}_place"))
    to_near = [
        F.struct(F.col(x).alias("node"), F.col(y).alias("near"), F.col(f"{y}_place").alias("place")) for x in ("a", "b") for y in ("a", "b")
    ]
    ends = edges.join(at("a"), "a").join(at("b"), "b").select(F.inline(F.array(*to_near)))
    steps = materialize(ends.groupBy("node").agg(F.min_by("near", "place").alias("next")), "steps")
    again = steps.select(F.col("node").alias("next"), F.col("next").alias("far"))
    moves = materialize(steps.join(again, "next").select("node", F.col("far").alias("next")), "moves")
    to = lambda end: moves.select(F.col("node").alias(end), F.col("next").alias(f"{end}_next"))
    moved = edges.join(to("a"), "a").join(to("b"), "b").where("a_next <> b_next")
    left = moved.select(*_ordered(F.col("a_next"), F.col("b_next"))).distinct()
    return moves, materialize(left, "edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every end of ``edges`` (``a``, ``b``).

    Rounds of ``contracted`` until no edge is left; what goes on to the next round are
    the edges between what is left of the nodes, so the work shrinks from round to round.
    Then the rounds' moves are followed back from the last to the first, each met with the places its nodes
    ended at.  A node with no edge but to itself is a component of its own.  Edges with a NULL
    end and no edges give no rows.
    """
    stored = materialize(edges.where("a IS NOT NULL AND b IS NOT NULL").select(*_ordered(F.col("a"), F.col("b"))).distinct(), "edges")
    own = stored.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    left = stored.where("a <> b")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        moves, left = contracted(left, len(rounds))
        rounds.append(moves)
    if not rounds:
        return own
    ended = rounds.pop().select("node", F.col("next").alias("root"))
    while rounds:
        last = ended.select(F.col("node").alias("next"), "root")
        ended = materialize(rounds.pop().join(last, "next", "left").select("node", F.coalesce("root", "next").alias("root")), "ended")
    smallest = materialize(ended.groupBy("root").agg(F.min("node").alias("component")), "smallest")
    named = ended.join(smallest, "root").select("node", "component")
    return named if own.isEmpty() else named.unionByName(own.join(named.select("node"), "node", "left_anti"))
