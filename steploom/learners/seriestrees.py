"""One boosted model per series, for all series of a table at once.

Every series has its own trees; no step loops over series.  A series whose rows fit a task is
fitted where its rows are.  A longer one stays spread over the cluster in blocks of
rows: for each level of each tree all blocks of all such series add up their gradient
histograms, Spark sums them by series and cell, and the splits are chosen from the sums.  Both ways
run the same steps, so a series' trees do not depend on which one it takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.buckets import bucket_of
from ..operators.features import features_of
from ..operators.splits import trainable
from ..schemas import KEYS, SeriesModel
from ..session import materialize
from .base import tails
from .histogram import TreeRules, Trees, advanced, bins_of, columns_of, grow, histogram, sampled, split_level
from .recursion import advance_paths, path_schema, unfold_paths

#: Bytes of histograms that a task adds up before it hands them on.
OPEN_BYTES = 64 << 20
_TREE_COLUMNS = ("feature", "bin", "leaf")
_TREES = [T.StructField(c, T.BinaryType()) for c in _TREE_COLUMNS]


@dataclass(frozen=True)
class SeriesTreeOptions:
    """``local_rows``: rows of a series that one task may hold.  ``edges``: "quantile" or "width".

    ``refresh``: trees after which the predictions of spread series are stored anew.
    """

    local_rows: int = 200_000
    edges: str = "quantile"
    penalty: float = 1.0
    bins: int = 64
    refresh: int = 4

    def __post_init__(self) -> None:
        if self.edges not in ("quantile", "width"):
            raise ValueError("edges are either 'quantile' or 'width'")
        if not 2 <= self.bins <= 256:
            raise ValueError("2 to 256 bins")


def _keyed(df: DataFrame, keys: Sequence[str], fields: list[T.StructField]) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + fields)


def _apart(df: DataFrame) -> DataFrame:
    """The same columns, told apart from those of the table that ``df`` was made of."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def about_series(rows: DataFrame, config: SeriesModel, options: SeriesTreeOptions, keys: Sequence[str]) -> DataFrame:
    """``keys, train_rows, base, edges``: rows, mean and the features' bin edges of each series, from mergeable sums."""
    n = options.bins
    columns = config.feature_cols
    if options.edges == "quantile":
        shares = F.array(*[F.lit(k / n) for k in range(1, n)])
        found = [F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]
    else:
        steps = F.array(*[F.lit(k / n) for k in range(1, n)])
        ends = [x for c in columns for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]
        whole = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("train_rows"), F.avg("y").alias("base"), *ends)
        between = lambda lo, hi: F.transform(steps, lambda s: lo + (hi - lo) * s)
        spaced = [between(F.col(f"{c}_lo"), F.col(f"{c}_hi")) for c in columns]
        return whole.select(*keys, "train_rows", "base", F.array(*spaced).alias("edges"))
    whole = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("train_rows"), F.avg("y").alias("base"), *found)
    return whole.select(*keys, "train_rows", "base", F.array(*columns).alias("edges"))


def edge_table(edges, bins: int) -> np.ndarray:
    out = np.full((len(edges), bins - 1), np.inf)
    for f, row in enumerate(edges):
        own = np.unique(np.asarray(row, dtype=float))
        out[f, : len(own)] = own
    return out


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy(dtype="datetime64[us]").astype(np.int64)


def fit_series(
    rows: DataFrame, config: SeriesModel, options: SeriesTreeOptions | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """``keys, train_rows, base, edges, feature, bin, leaf``: the trees of every series of feature ``rows``.

    Rows with a NULL key belong to no series.  The size of a result row is set by the tree settings.
    """
    options, keys = options or SeriesTreeOptions(), list(keys)
    rules = TreeRules(config.trees, options.penalty, options.bins)
    own = rows.dropna(subset=keys)
    about = materialize(about_series(own, config, options, keys), "about")
    short = F.col("train_rows") <= options.local_rows
    fields = [*about.schema.fields[len(keys) :], *_TREES]

    def fit(key: tuple, own_rows: pd.DataFrame, own_about: pd.DataFrame) -> pd.DataFrame:
        if own_rows.empty or own_about.empty:
            return pd.DataFrame(columns=[*own_about.columns, "feature", "bin", "leaf"])
        # A sum over rows in one order, whatever order they arrived in.
        own_rows = own_rows.sort_values("period")
        edges = edge_table(own_about["edges"].iloc[0], rules.bins)
        x = own_rows[config.feature_cols].to_numpy(dtype=float)
        trees = grow(bins_of(x, edges), own_rows["y"].to_numpy(), _micros(own_rows["period"]), float(own_about["base"].iloc[0]), rules)
        return own_about.assign(**dict(zip(_TREE_COLUMNS, ([p] for p in trees.pack()), strict=True)))

    kept = own.join(about.where(short).select(*keys), keys).select(*keys, "period", "y", *config.feature_cols)
    fitted = kept.groupBy(*keys).cogroup(about.where(short).groupBy(*keys)).applyInPandas(fit, _keyed(own, keys, fields))
    fitted = materialize(fitted, "forests")
    long = about.where(~short)
    if long.isEmpty():
        return fitted
    spread = own.join(long.select(*keys), keys).select(*keys, "period", "y", *config.feature_cols)
    return fitted.unionByName(_fit_by_levels(spread, long, config, rules, options, keys))


def _packed(spread: DataFrame, about: DataFrame, config: SeriesModel, rules: TreeRules, keys: list[str]) -> DataFrame:
    """Blocks of a bounded run of time: ``keys, y, at, bins, predicted`` with the columns of all rows in one."""
    placed = spread.withColumn("_bucket", bucket_of("period", config.step_us))
    at = _apart(placed.select(*keys, "_bucket").distinct().join(about.select(*keys, "base", "edges"), keys))
    fields = [T.StructField(c, T.BinaryType()) for c in ("y", "at", "bins", "predicted")]

    def pack(key: tuple, own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("period")
        bins = bins_of(own[config.feature_cols].to_numpy(dtype=float), edge_table(given["edges"].iloc[0], rules.bins))
        cells = own["y"].to_numpy(dtype=float), _micros(own["period"]), bins, np.full(len(own), given["base"].iloc[0])
        return given[keys].assign(**{f.name: [c.tobytes()] for f, c in zip(fields, cells, strict=True)})

    by = [*keys, "_bucket"]
    return materialize(placed.groupBy(*by).cogroup(at.groupBy(*by)).applyInPandas(pack, _keyed(spread, keys, fields)), "blocks")


def _block(row, features: int) -> tuple[np.ndarray, ...]:
    y, at, predicted = (np.frombuffer(d, dtype=k) for d, k in ((row.y, np.float64), (row.at, np.int64), (row.predicted, np.float64)))
    return y, at, np.frombuffer(row.bins, dtype=np.uint8).reshape(-1, features), predicted


def _fit_by_levels(
    spread: DataFrame, about: DataFrame, config: SeriesModel, rules: TreeRules, options: SeriesTreeOptions, keys: list[str]
) -> DataFrame:
    features = len(config.feature_cols)
    blocks = _packed(spread, about, config, rules, keys)
    empty = [F.lit(b"").cast("binary").alias(c) for c in _TREE_COLUMNS]
    model = about.select(*keys, *empty)
    done: list[DataFrame] = []
    for tree in range(config.trees.n_estimators):
        for level in range(rules.depth):
            cells = _level_sums(blocks.join(model, keys), tree, level, features, rules, keys)
            model = materialize(_split(model, cells, tree, level, features, rules, keys), "model")
        if (tree + 1) % options.refresh == 0 or tree + 1 == config.trees.n_estimators:
            done.append(model.withColumn("first_tree", F.lit(tree)))
            if tree + 1 < config.trees.n_estimators:
                blocks = materialize(_refreshed(blocks.join(model, keys), features, rules, keys, blocks.schema), "blocks")
                model = about.select(*keys, *empty)
    parts = done[0]
    for d in done[1:]:
        parts = parts.unionByName(d)
    ordered = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first_tree", "feature", "bin", "leaf"))).alias("parts"))
    whole = lambda c: F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p[c])).alias(c)
    return about.join(ordered, keys).select(*about.columns, whole("feature"), whole("bin"), whole("leaf"))


def _trees(row, rules: TreeRules) -> Trees:
    return Trees.unpack(row.feature, row.bin, row.leaf, rules.nodes)


def _level_sums(held: DataFrame, tree: int, level: int, features: int, rules: TreeRules, keys: list[str]) -> DataFrame:
    """``keys, cell, g, h``: histogram cells of a level, added up in each task before they are shuffled."""
    width = 1 << level

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_sums: dict[tuple, np.ndarray] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for key, sums in open_sums.items():
                flat = sums.reshape(-1, 2)
                cell = np.flatnonzero(flat[:, 1])
                yield pd.DataFrame({**dict(zip(keys, key, strict=True)), "cell": cell, "g": flat[cell, 0], "h": flat[cell, 1]})
            open_sums.clear()

        for batch in batches:
            for row in batch.itertuples(index=False):
                y, at, bins, predicted = _block(row, features)
                trees = _trees(row, rules)
                # Trees before the last are whole; the last one is growing, except before its first level.
                grown = len(trees) if level == 0 else len(trees) - 1
                gradient = predicted + trees.sums(bins, grown) - y
                node = np.ones(len(y), dtype=np.int64)
                for _ in range(level):
                    node = advanced(trees, len(trees) - 1, bins, node)
                place = np.where(sampled(at, tree, rules), node - width, -1)
                sums = histogram(bins, place, gradient, width, rules.bins)
                key = tuple(getattr(row, k) for k in keys)
                open_sums[key] = open_sums[key] + sums if key in open_sums else sums
                if len(open_sums) * sums.nbytes > OPEN_BYTES:
                    yield from rows()
        yield from rows()

    fields = [T.StructField("cell", T.LongType()), T.StructField("g", T.DoubleType()), T.StructField("h", T.DoubleType())]
    parts = held.mapInPandas(partial, _keyed(held, keys, fields))
    return parts.groupBy(*keys, "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _split(model: DataFrame, cells: DataFrame, tree: int, level: int, features: int, rules: TreeRules, keys: list[str]) -> DataFrame:
    """Each series' model with the splits of one more level; a series has one row of a bounded number of cells."""
    gathered = cells.groupBy(*keys).agg(F.collect_list(F.struct("cell", "g", "h")).alias("cells"))
    allowed = columns_of(features, tree, rules)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                trees = _trees(row, rules)
                if level == 0:
                    trees = trees.joined(Trees.blank(1, rules.nodes))
                if row.cells is not None and len(row.cells):
                    sums = np.zeros(((1 << level) * features * rules.bins, 2))
                    at = np.array([c["cell"] for c in row.cells])
                    sums[at, 0], sums[at, 1] = [c["g"] for c in row.cells], [c["h"] for c in row.cells]
                    split_level(trees, len(trees) - 1, level, sums.reshape(1 << level, features, rules.bins, 2), allowed, rules)
                out.append(trees.pack())
            yield batch[keys].assign(**{c: [p[i] for p in out] for i, c in enumerate(_TREE_COLUMNS)})

    return model.join(gathered, keys, "left").mapInPandas(choose, _keyed(model, keys, _TREES))


def _refreshed(held: DataFrame, features: int, rules: TreeRules, keys: list[str], schema: T.StructType) -> DataFrame:
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            new = []
            for row in batch.itertuples(index=False):
                _, _, bins, predicted = _block(row, features)
                new.append((predicted + _trees(row, rules).sums(bins)).tobytes())
            yield batch[[*keys, "y", "at", "bins"]].assign(predicted=new)

    return held.mapInPandas(add, schema)


def forest_of(row, rules: TreeRules) -> Callable[[np.ndarray, int | None], np.ndarray]:
    """Prediction of feature rows by a series' first trees, all of them by default."""
    trees, edges, base = _trees(row, rules), edge_table(row.edges, rules.bins), float(row.base)
    return lambda x, upto=None: base + trees.sums(bins_of(x, edges), upto)


def predict_series(
    rows: DataFrame, forests: DataFrame, config: SeriesModel, options: SeriesTreeOptions | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Feature rows of fitted series with ``z``; a bounded run of a series' time and its trees meet in a task."""
    options, keys = options or SeriesTreeOptions(), list(keys)
    rules = TreeRules(config.trees, options.penalty, options.bins)
    by = [*keys, "_bucket"]
    placed = rows.withColumn("_bucket", bucket_of("period", config.step_us))
    models = _apart(placed.select(*by).distinct().join(forests, keys))

    def apply(key: tuple, own: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if own.empty or model.empty:
            return own.head(0).drop(columns="_bucket").assign(z=pd.Series(dtype=float))
        predict = forest_of(next(model.itertuples(index=False)), rules)
        return own.drop(columns="_bucket").assign(z=predict(own[config.feature_cols].to_numpy(dtype=float)))

    schema = T.StructType([*rows.schema.fields, T.StructField("z", T.DoubleType())])
    return placed.groupBy(*by).cogroup(models.groupBy(*by)).applyInPandas(apply, schema)


class SeriesBoostedLearner:
    """Squared-error boosted trees, one model for each series, fitted side by side.

    ``stages`` of ``forecast_stages`` are numbers of trees: one fit serves them all, since the
    first trees of a longer fit are those of a shorter one.
    """

    info_cols = ("train_rows", "n_features")
    splits = True

    def __init__(self, options: SeriesTreeOptions | None = None):
        self.options = options or SeriesTreeOptions()

    def trainable(self, config: SeriesModel) -> Column:
        return trainable(config)

    def fit_predict(self, train: DataFrame, test: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
        return predict_series(test, fit_series(train, config, self.options, keys), config, self.options, keys)

    def prepare(self, scaled: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
        """Feature rows, written once for all settings that are fitted on them."""
        return materialize(features_of(scaled, config, list(keys)), "features")

    def forecast_stages(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel, stages: Sequence[int],
        keys: Sequence[str] = KEYS, features: DataFrame | None = None,
    ) -> tuple[dict[int, DataFrame], DataFrame]:
        """Paths after each number of trees in ``stages``, from one fit of the largest, and training information."""
        keys, options = list(keys), self.options
        rules = TreeRules(config.trees, options.penalty, options.bins)
        rows = self.prepare(scaled, config, keys) if features is None else features
        forests = materialize(fit_series(rows, config, options, keys), "fitted")
        states = tails(scaled, config.reach, config, keys).join(forests, keys)
        schema = path_schema(states, keys)

        def paths(upto: int) -> DataFrame:
            def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
                predict = forest_of(next(own.itertuples(index=False)), rules)
                return advance_paths(own, horizon, config, lambda _, x: predict(x, upto), keys)

            return unfold_paths(states.groupBy(*keys).applyInPandas(run, schema), keys)

        info = forests.select(*keys, F.col("train_rows").cast("double").alias("train_rows"), F.lit(float(len(config.feature_cols))).alias("n_features"))
        return {n: paths(n) for n in stages}, info

    def forecast(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel,
        keys: Sequence[str] = KEYS, features: DataFrame | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        count = config.trees.n_estimators
        paths, info = self.forecast_stages(scaled, profile, horizon, config, [count], keys, features)
        return paths[count], info
