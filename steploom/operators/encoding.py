"""What is usual for a series at a point of its season, learned from training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEYS, SeriesModel
from ..session import materialize

#: Name of the encoded column; the calendar column that is the season slot, and how many slots there are.
CODE = "usual"
SLOTS = {"hourly": ("hour", 24), "daily": ("dayofweek", 7)}
#: Folds are dealt by day, so that neighbouring hours stay in one.
FOLDS = 5
#: Rows that the pooled mean counts as.
WEIGHT = 20.0


def fold_of(period: Column | str) -> Column:
    return F.pmod(F.floor(F.unix_micros(period) / F.lit(86_400_000_000)), F.lit(FOLDS)).cast("int")


def _slot(config: SeriesModel) -> str:
    name = SLOTS[config.resolution][0]
    if name not in config.columns["calendar"]:
        raise ValueError("the code of a series needs the calendar columns")
    return name


def code_sums(train: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sums and counts of ``y`` by series, slot and fold: all that the code is made of, and mergeable."""
    slot = F.col(_slot(config)).cast("int").alias("_slot")
    sums = train.groupBy(*keys, slot, fold_of("period").alias("_fold")).agg(F.sum("y").alias("_sum"), F.count("y").alias("_n"))
    return materialize(sums, "code-sums")


def _code(total: Column, n: Column, prior: Column) -> Column:
    return (total + WEIGHT * prior) / (n + WEIGHT)


def _pooled(sums: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Sums of each slot of a series, and those of each fold over everything."""
    spots = sums.groupBy(*keys, "_slot").agg(F.sum("_sum").alias("_all"), F.sum("_n").alias("_all_n"))
    folds = sums.groupBy("_fold").agg(F.sum("_sum").alias("_fold_sum"), F.sum("_n").alias("_fold_n"))
    return spots, folds


def season_code(
    rows: DataFrame, sums: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS, own_fold: bool = True
) -> DataFrame:
    """Feature rows with the column ``usual``: the mean of their series and season slot, shrunk to the pooled mean.

    With ``own_fold`` the rows are those that ``sums`` came from, and their own fold is left
    out of both means, so no row sees itself or its day.  A series or slot without other training rows gets the
    pooled mean; rows with a NULL key do, too.  The sums are a small table that combines map-side;
    rows meet it by series, slot and fold.
    """
    keys = list(keys)
    spots, folds = _pooled(sums, keys)
    # At most FOLDS rows, known without looking at the data.
    known = folds.agg(F.sum("_fold_sum").alias("s"), F.sum("_fold_n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("_fold_sum", "_fold_n")))).alias("by"))
    total = known.first()
    placed = rows.withColumns({"_slot": F.col(_slot(config)).cast("int"), "_fold": fold_of("period")})
    met = placed.join(spots, [*keys, "_slot"], "left").join(sums, [*keys, "_slot", "_fold"], "left") if own_fold else placed.join(
        spots, [*keys, "_slot"], "left"
    )
    none = F.lit(0.0)
    if own_fold:
        prior = none
        for fold, part in (total["by"] or {}).items():
            n = total["n"] - part["_fold_n"]
            prior = F.when(F.col("_fold") == fold, (total["s"] - part["_fold_sum"]) / n if n else 0.0).otherwise(prior)
        left, left_n = F.coalesce(F.col("_all") - F.coalesce("_sum", none), none), F.coalesce(F.col("_all_n") - F.coalesce("_n", F.lit(0)), F.lit(0))
    else:
        prior = F.lit(total["s"] / total["n"] if total["n"] else 0.0)
        left, left_n = F.coalesce("_all", none), F.coalesce("_all_n", F.lit(0))
    return met.select(*[F.col(c) for c in rows.columns], _code(left, left_n, prior).alias(CODE))


def code_table(sums: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, usual``: each series' codes of all slots as an array, from all training rows."""
    spots, _ = _pooled(sums, keys)
    total = sums.agg(F.sum("_sum").alias("s"), F.sum("_n").alias("n")).first()
    prior = F.lit(total["s"] / total["n"] if total["n"] else 0.0)
    known = spots.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_slot", _code(F.col("_all"), F.col("_all_n"), prior)))).alias("_codes"))
    slots = F.sequence(F.lit(0), F.lit(SLOTS[config.resolution][1] - 1))
    return known.select(*keys, F.transform(slots, lambda s: F.coalesce(F.try_element_at("_codes", s), prior)).alias(CODE))
