"""Per-series least squares from distributed cross products."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A task holds at most this many open series before it hands its sums on.
OPEN_SERIES = 2000


class OpenSums:
    """Cross products a task is still adding up, by series."""

    def __init__(self, keys: Sequence[str]):
        self.keys, self.sums = list(keys), {}

    def add(self, key: tuple, x: np.ndarray) -> None:
        products = (x.T @ x)[np.triu_indices(x.shape[1])]
        self.sums[key] = self.sums[key] + products if key in self.sums else products

    def flush(self, least: int = 1) -> Iterator[pd.DataFrame]:
        """Hand on the sums when there are at least ``least`` of them."""
        if len(self.sums) >= least:
            out = pd.DataFrame(list(self.sums), columns=self.keys)
            out["products"] = list(self.sums.values())
            self.sums = {}
            yield out


def key_tuple(key) -> tuple:
    return key if isinstance(key, tuple) else (key,)


def products_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + [T.StructField("products", T.ArrayType(T.DoubleType()))])


def cross_products(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row count and upper triangle of ``[1, columns]' [1, columns]`` per series.

    Each task first adds up its own rows, so a series with a third of all rows sends
    one partial vector per task; the partial vectors are summed element by element.
    """
    keys, columns = list(keys), list(columns)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_sums = OpenSums(keys)
        for batch in batches:
            x = np.ones((len(batch), len(columns) + 1))
            x[:, 1:] = batch[columns].to_numpy(dtype=float)
            for key, at in batch.groupby(keys, sort=False).indices.items():
                open_sums.add(key_tuple(key), x[at])
            yield from open_sums.flush(OPEN_SERIES)
        yield from open_sums.flush()

    return sum_products(df.select(*keys, *columns).mapInPandas(partial, products_schema(df, keys)), keys)


def sum_products(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Element-wise sums of the tasks' product vectors, with the row count in front."""
    cells = parts.select(*keys, F.posexplode("products").alias("_i", "_x"))
    summed = cells.groupBy(*keys, "_i").agg(F.sum("_x").alias("_x"))
    gathered = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_cells"))
    products = F.transform("_cells", lambda c: c["_x"])
    return gathered.select(*keys, F.element_at(products, 1).cast("long").alias("rows"), products.alias("products"))


def unpack(products: np.ndarray, size: int) -> np.ndarray:
    """Full symmetric matrices from stacked upper triangles."""
    out = np.zeros((len(products), size, size))
    rows, cols = np.triu_indices(size)
    out[:, rows, cols] = products
    out[:, cols, rows] = products
    return out


def solve(gram: np.ndarray, moment: np.ndarray, ridge: float) -> np.ndarray:
    """Stacked ridge solutions; the intercept in place 0 is not shrunk."""
    size = gram.shape[-1]
    shrink = np.eye(size)
    shrink[0, 0] = 0.0
    rows = gram[:, 0, 0][:, None, None]
    try:
        return np.linalg.solve(gram + ridge * rows * shrink, moment[..., None])[..., 0]
    except np.linalg.LinAlgError:
        return np.stack([np.linalg.lstsq(g, m, rcond=None)[0] for g, m in zip(gram + ridge * rows * shrink, moment)])
