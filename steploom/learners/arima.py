"""Seasonal ARIMA by two-step least squares (Hannan and Rissanen, 1982).

With ``w`` the values differenced once and once over the season: a long
autoregression of ``w`` gives residuals, then ``w`` is regressed on its own lags and
on lagged residuals.  Both steps are least squares from distributed cross products.
The plain and the seasonal polynomial are multiplied, so the coefficients at the product lags
follow from the others; Gauss-Newton steps find the best ones.  Since the residual sum of squares
is a quadratic form of the multiplied coefficients, sum and Jacobian products of every step come from the same
cross products and no step reads the data again.
Values before a series' start count as zero.  Since every order only picks lags from
one common set, all orders of a grid share both passes over the data.

This is conditional least squares, not an exact likelihood, so estimates and criteria are
close to but not those of a state space fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.buckets import WIDTH, with_halo
from ..schemas import ARIMA_GRID, KEYS, SeriesModel
from ..session import materialize
from .gram import OPEN_SERIES, OpenSums, products_schema, solve, sum_products, unpack

LONG_ORDER = 48
#: Rows of a series that the long autoregression needs for each of its lags; shorter series use fewer lags.
ROWS_PER_LAG = 3
RIDGE = 1e-8
#: Gauss-Newton steps at most, and halvings of one.
STEPS, HALVINGS = 100, 40


@dataclass(frozen=True)
class Order:
    """Autoregressive and moving-average orders, plain and seasonal; both differences are 1.

    ``multiplicative=False`` leaves the coefficients at the product lags free.
    """

    p: int = 1
    q: int = 2
    P: int = 1
    Q: int = 1
    season: int = 24
    multiplicative: bool = True

    @property
    def ar_lags(self) -> list[int]:
        return [*range(1, self.p + 1), *([self.season + i for i in range(self.p + 1)] if self.P else [])]

    @property
    def ma_lags(self) -> list[int]:
        return [*range(1, self.q + 1), *([self.season + i for i in range(self.q + 1)] if self.Q else [])]

    @property
    def products(self) -> bool:
        """Whether some coefficient follows from others."""
        return self.multiplicative and bool((self.p and self.P) or (self.q and self.Q))

    @property
    def parameters(self) -> int:
        return self.p + bool(self.P) + self.q + bool(self.Q) if self.multiplicative else len(self.ar_lags + self.ma_lags)

    @property
    def label(self) -> str:
        return f"({self.p},1,{self.q})×({self.P},1,{self.Q},{self.season})"


def order_grid(grid: dict[str, list[int]] | None = None, season: int = 24) -> list[Order]:
    """All combinations, the last parameter varying fastest."""
    g = grid or ARIMA_GRID
    return [Order(p, q, P, Q, season) for p in g["p"] for q in g["q"] for P in g["P"] for Q in g["Q"]]


def chunks_of(scaled: DataFrame, halo: int, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
    """Series cut into arrays of at most one bucket, each led by the ``halo`` values before it.

    ``head`` counts the leading values that belong to the bucket before.
    """
    rows = with_halo(scaled, config.step_us, halo, width=max(WIDTH, halo))
    packed = rows.groupBy(*keys, "_bucket").agg(
        F.array_sort(F.collect_list(F.struct("period", "value"))).alias("_rows"),
        F.count(F.when(~F.col("_own"), 1)).cast("int").alias("head"),
    )
    return packed.where(F.col("head") < F.size("_rows")).select(
        *keys, F.col("_bucket").alias("bucket"), F.col("_rows")["value"].alias("value"), "head"
    )


def _differenced(value: np.ndarray, season: int) -> np.ndarray:
    """``w``: differenced over one step and one season, from the first complete place on."""
    once = value[1:] - value[:-1]
    return once[season:] - once[:-season] if len(once) > season else once[:0]


def _lags(x: np.ndarray, lags: Sequence[int], start: int) -> np.ndarray:
    """Lagged copies of ``x[start:]`` as columns, zeros before its first value."""
    out = np.zeros((len(x) - start, len(lags)))
    for column, k in enumerate(lags):
        first = max(start, k)
        if first < len(x):
            out[first - start :, column] = x[first - k : len(x) - k]
    return out


def _long_model(products: DataFrame, keys: list[str], long: int, rows_per_lag: int) -> DataFrame:
    """Long autoregression per series; short series use fewer lags, the rest is zero."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            full = unpack(np.stack(batch["products"].to_numpy()), long + 2)
            coef = np.zeros((len(batch), long + 1))
            size = np.minimum(long, batch["rows"].to_numpy() // rows_per_lag) + 1
            for m in np.unique(size):
                at = np.flatnonzero(size == m)
                coef[at, :m] = solve(full[at, :m, :m], full[at, :m, -1], RIDGE)
            out = batch[keys].copy()
            out["long_coef"] = list(coef)
            yield out

    schema = T.StructType(
        [products.schema[k] for k in keys] + [T.StructField("long_coef", T.ArrayType(T.DoubleType()))]
    )
    return products.mapInPandas(fit, schema)


def long_autoregression(
    chunks: DataFrame, season: int, long: int, keys: Sequence[str] = KEYS, rows_per_lag: int = ROWS_PER_LAG
) -> DataFrame:
    """Coefficients ``long_coef`` of ``w`` on its last ``long`` values, intercept first.

    A series uses one lag for every ``rows_per_lag`` rows, ``long`` at most.
    """
    keys = list(keys)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = OpenSums(keys)
        for batch in batches:
            for key, value, head in _chunk_rows(batch, keys):
                w = _differenced(value, season)
                start = max(head - season - 1, 0)
                if start < len(w):
                    ones = np.ones(len(w) - start)
                    sums.add(key, np.column_stack([ones, _lags(w, range(1, long + 1), start), w[start:]]))
            yield from sums.flush(OPEN_SERIES)
        yield from sums.flush()

    parts = chunks.mapInPandas(partial, products_schema(chunks, keys))
    return _long_model(sum_products(parts, keys), keys, long, rows_per_lag)


def _chunk_rows(batch: pd.DataFrame, keys: list[str]):
    for key, value, head in zip(batch[keys].itertuples(index=False, name=None), batch["value"], batch["head"]):
        yield key, np.asarray(value, dtype=float), int(head)


class ArimaLearner:
    """One or many orders at once; many orders add ``combo_id`` to the keys of the result."""

    info_cols = ("aic", "bic", "hqic", "llf")
    splits = False

    def __init__(self, order: Order | None = None, min_observations: int = 96, rows_per_lag: int = ROWS_PER_LAG):
        self.order = order or Order()
        self.min_observations = min_observations
        self.rows_per_lag = rows_per_lag

    def trainable(self, config: SeriesModel) -> Column:
        return F.col("points") >= self.min_observations

    def forecast(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel, keys: Sequence[str] = KEYS
    ) -> tuple[DataFrame, DataFrame]:
        paths, info = forecast_orders(scaled, profile, horizon, config, [self.order], keys, self.rows_per_lag)
        return paths.drop("combo_id"), info.drop("combo_id", "order")


def forecast_orders(
    scaled: DataFrame,
    profile: DataFrame,
    horizon: int,
    config: SeriesModel,
    orders: Sequence[Order],
    keys: Sequence[str] = KEYS,
    rows_per_lag: int = ROWS_PER_LAG,
) -> tuple[DataFrame, DataFrame]:
    """Predictions ``keys, combo_id, step_no, z`` and criteria of every order."""
    keys, orders = list(keys), list(orders)
    season = orders[0].season
    if any(o.season != season for o in orders):
        raise ValueError("all orders of one call share the season length")
    ar = sorted({k for o in orders for k in o.ar_lags})
    ma = sorted({k for o in orders for k in o.ma_lags})
    long = max([LONG_ORDER, *ar, *ma])

    back = season + 1
    reach = max([1, *ar, *ma])
    chunks = materialize(chunks_of(scaled, back + long + reach, config, keys), "chunks")
    modelled = chunks.join(long_autoregression(chunks, season, long, keys, rows_per_lag), keys)
    names = [*[f"w{k}" for k in ar], *[f"e{k}" for k in ma]]

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Products of the second regression and the tail of each chunk."""
        for batch in batches:
            out = batch[[*keys, "bucket"]].copy()
            products, tails = [], {"value": [], "w": [], "e": []}
            for (_, value, head), coef in zip(_chunk_rows(batch, keys), batch["long_coef"]):
                w = _differenced(value, season)
                # In a full halo the first ``long`` residuals lack lags; no own row looks back at them.
                e = w - coef[0] - _lags(w, range(1, long + 1), 0) @ np.asarray(coef[1:])
                start = min(max(head - back, 0), len(w))
                x = np.column_stack([np.ones(len(w) - start), _lags(w, ar, start), _lags(e, ma, start), w[start:]])
                products.append((x.T @ x)[np.triu_indices(x.shape[1])])
                for name, series in (("value", value), ("w", w), ("e", e)):
                    tails[name].append(series[-(back + reach) :])
            yield out.assign(products=products, **tails)

    doubles = T.ArrayType(T.DoubleType())
    second_schema = T.StructType(
        [scaled.schema[k] for k in keys]
        + [T.StructField("bucket", T.LongType())]
        + [T.StructField(c, doubles) for c in ("products", "value", "w", "e")]
    )
    # One short row per chunk, read twice below.
    done = materialize(modelled.mapInPandas(second, second_schema), "second")
    products = sum_products(done.select(*keys, "products"), keys)
    ends = done.groupBy(*keys).agg(F.max_by(F.struct("value", "w", "e"), "bucket").alias("_tail"))
    states = (
        ends.select(*keys, "_tail.value", "_tail.w", "_tail.e")
        .join(products, keys)
        .join(profile.select(*keys, "spread"), keys)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            full = unpack(np.stack(batch["products"].to_numpy()), len(names) + 2)
            value, w, e = (_stack(batch[c], back + reach) for c in ("value", "w", "e"))
            for combo, order in enumerate(orders):
                own = [f"w{k}" for k in order.ar_lags] + [f"e{k}" for k in order.ma_lags]
                at = [1 + names.index(c) for c in own]
                coef, criteria = _fit_order(full, at, batch["spread"].to_numpy(), order)
                out = batch[keys].copy()
                out["combo_id"], out["order"] = combo, order.label
                for name, column in criteria.items():
                    out[name] = column
                out["z"] = list(_run_order(value, w, e, order, coef, horizon))
                yield out

    criteria_fields = [T.StructField(c, T.DoubleType()) for c in ArimaLearner.info_cols]
    schema = T.StructType(
        [scaled.schema[k] for k in keys]
        + [T.StructField("combo_id", T.IntegerType()), T.StructField("order", T.StringType())]
        + criteria_fields
        + [T.StructField("z", T.ArrayType(T.DoubleType()))]
    )
    solved = states.mapInPandas(run, schema)
    paths = solved.select(*keys, "combo_id", F.posexplode("z").alias("_i", "z"))
    return (
        paths.select(*keys, "combo_id", (F.col("_i") + 1).alias("step_no"), "z"),
        solved.drop("z"),
    )


def _stack(column: pd.Series, length: int) -> np.ndarray:
    """Tail arrays as rows, zeros where a series is shorter."""
    out = np.zeros((len(column), length))
    for row, tail in enumerate(column):
        tail = np.asarray(tail, dtype=float)
        out[row, length - len(tail) :] = tail
    return out


def multiplied(order: Order, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients at ``ar_lags + ma_lags`` from those of the polynomials (p, P, q, Q in this order), and their Jacobian."""
    size = len(order.ar_lags) + len(order.ma_lags)
    coef, jacobian = np.zeros((len(free), size)), np.zeros((len(free), size, free.shape[1]))
    at = own = 0
    for plain, seasonal, sign in ((order.p, bool(order.P), -1), (order.q, bool(order.Q), 1)):
        for i in range(plain + seasonal):
            coef[:, at + i] = free[:, own + i]
            jacobian[:, at + i, own + i] = 1
        if seasonal:
            s = own + plain
            for i in range(plain):
                place = at + plain + 1 + i
                coef[:, place] = sign * free[:, own + i] * free[:, s]
                jacobian[:, place, own + i] = sign * free[:, s]
                jacobian[:, place, s] = sign * free[:, own + i]
        at += plain + seasonal * (plain + 1)
        own += plain + seasonal
    return coef, jacobian


def multiplicative_fit(
    gram: np.ndarray, moment: np.ndarray, energy: np.ndarray, order: Order, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Multiplied coefficients with the least residual sum of squares, and that sum, for stacked series.

    Starts at the plain and seasonal coefficients of a free fit.  A step that would not lower the sum is
    halved until it does, so the sum is never above that of the start.
    """
    ar = len(order.ar_lags)
    starts = [*range(order.p + bool(order.P)), *[ar + i for i in range(order.q + bool(order.Q))]]
    free = start[:, starts].copy()

    def rss(coef: np.ndarray) -> np.ndarray:
        return energy - 2 * (coef * moment).sum(1) + np.einsum("ni,nij,nj->n", coef, gram, coef)

    coef, jacobian = multiplied(order, free)
    best = rss(coef)
    for _ in range(STEPS):
        rest = moment - np.einsum("nij,nj->ni", gram, coef)
        slope = np.einsum("nik,ni->nk", jacobian, rest)
        curve = np.einsum("nik,nij,njl->nkl", jacobian, gram, jacobian)
        curve += (1e-12 * np.trace(curve, axis1=1, axis2=2) + 1e-300)[:, None, None] * np.eye(free.shape[1])
        step = np.linalg.solve(curve, slope[..., None])[..., 0]
        moved, before = np.zeros(len(free), dtype=bool), best.copy()
        for _ in range(HALVINGS):
            tried = free + np.where(moved[:, None], 0, step)
            value = rss(multiplied(order, tried)[0])
            better = ~moved & (value < best)
            free[better], best[better] = tried[better], value[better]
            moved |= better
            if moved.all():
                break
            step = step / 2
        coef, jacobian = multiplied(order, free)
        if not (before - best > 1e-13 * np.abs(before)).any():
            break
    return coef, best


def _fit_order(
    full: np.ndarray, at: list[int], spread: np.ndarray, order: Order
) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Coefficients without intercept and Gaussian criteria in the series' own units."""
    n = full[:, 0, 0]
    moment = full[:, at, -1]
    energy = full[:, -1, -1]
    if at:
        gram = full[np.ix_(range(len(full)), at, at)]
        shrink = RIDGE * n[:, None, None] * np.eye(len(at))
        coef = np.linalg.solve(gram + shrink, moment[..., None])[..., 0]
        if order.products:
            coef, _ = multiplicative_fit(gram + shrink, moment, energy, order, coef)
        rss = energy - 2 * (coef * moment).sum(1) + np.einsum("ni,nij,nj->n", coef, gram, coef)
    else:
        coef, rss = np.zeros((len(full), 0)), energy
    variance = np.maximum(rss / n, 1e-300) * spread**2
    llf = -n / 2 * (np.log(2 * math.pi * variance) + 1)
    k = order.parameters + 1
    return coef, {
        "aic": 2 * k - 2 * llf,
        "bic": k * np.log(n) - 2 * llf,
        "hqic": 2 * k * np.log(np.log(n)) - 2 * llf,
        "llf": llf,
    }


def _run_order(
    value: np.ndarray, w: np.ndarray, e: np.ndarray, order: Order, coef: np.ndarray, horizon: int
) -> np.ndarray:
    """Forecast ``w`` with unknown residuals at zero and undo both differences."""
    rows, start = value.shape
    value, w, e = (np.hstack([x, np.zeros((rows, horizon))]) for x in (value, w, e))
    lags = [(w, k) for k in order.ar_lags] + [(e, k) for k in order.ma_lags]
    for now in range(start, start + horizon):
        for i, (source, k) in enumerate(lags):
            w[:, now] += coef[:, i] * source[:, now - k]
        s = order.season
        value[:, now] = w[:, now] + value[:, now - 1] + value[:, now - s] - value[:, now - s - 1]
    return value[:, start:]
