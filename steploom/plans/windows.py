"""The multi-window job: tune, forecast and backtest each window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import shift_steps
from ..learners.base import Learner
from ..operators.gridding import regular_grid
from ..schemas import KEYS, TEST_FRACTION, WINDOWS, ForecastWindow, SeriesModel, model_for, window
from ..session import materialize, run_folder, side_by_side
from ..sources.tables import read_best_params, read_series, write_best_params, write_table
from .backtesting import Backtest, backtest_report
from .forecasting import filled_to_the_end, forecast_grouped
from .tuning import best_params, grid_search


def resolve_windows(keys: Sequence[str] | None = None) -> list[ForecastWindow]:
    """Windows by key, all of them by default; an unknown key is an error."""
    return [window(k) for k in keys] if keys else list(WINDOWS.values())


def config_for(spark, params_path: str | None, target: ForecastWindow) -> SeriesModel | None:
    """Settings of a window from its stored winner; None when it was never tuned."""
    if params_path is None:
        return None
    stored = read_best_params(spark, params_path).where(F.col("window") == target.key).limit(1).collect()
    if not stored:
        return None
    params = {k: v for k, v in stored[0]["params"].asDict().items() if v is not None}
    return model_for(target.resolution, params)


def tune_windows(
    tables: dict[str, DataFrame],
    learner: Learner,
    params_path: str,
    windows: Sequence[str] | None = None,
    grid: dict[str, list] | None = None,
) -> None:
    """Search the grid for each window and store its winner."""
    for target in resolve_windows(windows):
        actual = tables[target.resolution]
        with run_folder(actual.sparkSession):
            results = materialize(grid_search(actual, target, learner, grid), "results")
            write_best_params(best_params(results, target, grid), params_path)


def run_windows(
    tables: dict[str, DataFrame],
    learner: Learner,
    windows: Sequence[str] | None = None,
    params_path: str | None = None,
    tune_if_missing: bool = False,
    fraction: float = TEST_FRACTION,
    grid: dict[str, list] | None = None,
    configure: Callable[[ForecastWindow], SeriesModel] | None = None,
) -> dict[str, DataFrame]:
    """Forecast and backtest every window from the table of its resolution.

    ``tables`` maps a resolution to its actuals.  Returns ``forecast``,
    ``backtest_forecast``, ``metrics`` and ``overall``, each with a ``window`` column.

    What windows have in common is made once: grids per resolution; per resolution
    and settings one forecast as long as the longest window, whose first steps are the shorter ones,
    and one backtest where it does not depend on the horizon.
    """
    targets = resolve_windows(windows)
    for target in targets:
        if target.resolution not in tables:
            raise FileNotFoundError(f"no {target.resolution} actuals; run ingestion first")

    def configured(target: ForecastWindow) -> SeriesModel:
        actual = tables[target.resolution]
        config = config_for(actual.sparkSession, params_path, target)
        if config is None and tune_if_missing and params_path is not None:
            tune_windows(tables, learner, params_path, [target.key], grid)
            config = config_for(actual.sparkSession, params_path, target)
        if config is None:
            config = configure(target) if configure else model_for(target.resolution)
        return config

    spark = next(iter(tables.values())).sparkSession
    by_split = fraction > 0 and learner.splits
    configs = side_by_side(spark, (partial(configured, target) for target in targets))
    alike: dict[tuple[str, str], list[tuple[ForecastWindow, SeriesModel]]] = {}
    for target, config in zip(targets, configs, strict=True):
        alike.setdefault((target.resolution, repr(config)), []).append((target, config))
    resolutions = list(dict.fromkeys(t.resolution for t in targets))
    steps = [partial(filled_to_the_end, tables[r], r) for r in resolutions]
    if not by_split:
        steps += [partial(materialize, regular_grid(tables[r], KEYS, r), "grid") for r in resolutions]
    made = side_by_side(spark, steps)
    filled, grids = (dict(zip(resolutions, part)) for part in (made, made[len(resolutions) :]))

    def run(group: list[tuple[ForecastWindow, SeriesModel]]) -> list[dict[str, DataFrame]]:
        config, members = group[0][1], [t for t, _ in group]
        actual = tables[config.resolution]
        longest = max(t.horizon for t in members)
        path = forecast_grouped(actual, longest, config, learner, filled=filled[config.resolution])
        # Each row goes to the windows that reach as far, so one plan makes the forecasts of all.
        reached = [F.when(F.col("target_time") <= shift_steps("issue_time", F.lit(t.horizon), config.step_us), t.key) for t in members]
        found = [{"forecast": path.withColumn("window", F.explode(F.array_compact(F.array(*reached))))}]
        if by_split:
            keys = F.array(*[F.lit(t.key) for t in members])
            return [*found, _named(backtest_report(actual, longest, config, learner, fraction), F.explode(keys))]
        for t in members:
            report = backtest_report(actual, t.horizon, config, learner, fraction, grid=grids[config.resolution])
            found.append(_named(report, F.lit(t.key)))
        return found

    parts = [part for group in side_by_side(spark, (partial(run, group) for group in alike.values())) for part in group]
    names = ("forecast", "backtest_forecast", "metrics", "overall")
    return {
        name: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p[name] for p in parts if name in p]) for name in names
    }


def _named(report: Backtest, key: Column) -> dict[str, DataFrame]:
    found = {"backtest_forecast": report.forecast, "metrics": report.by_series, "overall": report.overall}
    return {name: df.withColumn("window", key) for name, df in found.items()}


def write_windows(results: dict[str, DataFrame], root: str) -> None:
    """Store the job's tables, partitioned by window, replacing only the windows they hold.

    Rows of a region lie together in the files, and ``forecast_regions`` lists each window's regions,
    so that a request for one region reads its own row groups (``filter_region``).
    """
    for name, df in results.items():
        grouped = [c for c in ("window", "region") if c in df.columns]
        write_table(df.sortWithinPartitions(*grouped), f"{root}/{name}", ["window"])
    if "forecast" in results:
        stored = read_series(results["forecast"].sparkSession, f"{root}/forecast")
        write_table(stored.select("window", "region").distinct(), f"{root}/forecast_regions", ["window"])
