"""Forecasting, backtesting and tuning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..learners import arima
from ..learners.base import persistence as repeat_last
from ..learners.base import profile_of
from ..learners.boosted import BoostedLearner
from ..learners.linear import LinearLearner
from ..learners.seasonal import SeasonalNaive
from ..learners.seasonal import seasonal_naive as one_season_back
from ..learners.seriestrees import SeriesBoostedLearner, SeriesTreeOptions, fit_series, predict_series
from ..operators import encoding
from ..operators.encoding import FOLDS, WEIGHT
from ..operators.evaluate import best_combo
from ..operators.features import feature_matrix
from ..operators.gridding import regular_grid
from ..plans import backtesting, forecasting, tuning, windows
from ..schemas import KEYS, TREE_GRID, model_for, window
from ..session import materialize
from .data import actuals, shipments
from .registry import query
from .results import backtest_views
from .series import user_series
from .sql import metrics, naive_forecast, with_views

ERRORS = ["mae", "rmse", "mape", "smape"]
HOURLY, DAILY = model_for("hourly"), model_for("daily")
ONE_LAG = model_for("hourly", lags=(24,), roll_windows=(), calendar=False, ridge=0.0)
LAST_STEP = model_for("hourly", lags=(1,), roll_windows=(), calendar=False, ridge=0.0)
SMALL_TREES = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}


@query(
    """WITH pairs AS (
         SELECT upper(event_type) AS region, CAST(user_id AS VARCHAR) AS series, date_trunc('hour', ts) AS period,
                sum(value) AS value FROM events GROUP BY 1, 2, 3)
       SELECT region, series, origin AS issue_time, CAST(s.step_no AS INTEGER) AS step_no,
              origin + s.step_no * INTERVAL 1 HOUR AS target_time, last_value AS yhat
       FROM (SELECT region, series, max(period) AS origin, arg_max(value, period) AS last_value
             FROM pairs GROUP BY region, series),
            (SELECT unnest(generate_series(1, 24)) AS step_no) AS s""",
    ["issue_time", "target_time"],
    ["yhat"],
)
def persistence(spark, sf_dir):
    """One short series per event type and user, each repeating its last value."""
    return repeat_last(profile_of(user_series(spark, sf_dir)), 24)


@query()
def fit_boosted(spark, sf_dir):
    """One boosted model on the daily feature rows and its fit to them."""
    config = model_for("daily", SMALL_TREES)
    rows = materialize(feature_matrix(actuals(spark, sf_dir, "daily"), config), "features")
    fitted = BoostedLearner().fit(rows, config).transform(rows)
    return fitted.select(*KEYS, "period", "y", F.col("z").alias("yhat"))


@query(
    with_views(
        "SELECT region, series, period, y, avg(y) OVER (PARTITION BY is_weekend) AS yhat FROM hfeatures", "hfeatures"
    ),
    ["period"],
    ["y", "yhat"],
    digits=3,
)
def fit_boosted_stumps(spark, sf_dir):
    """Two trees of one split on all hourly rows, where only the weekend column varies.

    The first tree's leaves are the means of both kinds of days, and the second has nothing left to explain.
    """
    trees = {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}
    config = model_for("hourly", trees)
    rows = materialize(feature_matrix(actuals(spark, sf_dir), config), "features")
    plain = rows.withColumns({c: F.lit(0.0) for c in config.feature_cols if c != "is_weekend"})
    fitted = BoostedLearner().fit(plain, config).transform(plain)
    return fitted.select(*KEYS, "period", "y", F.col("z").alias("yhat"))


def _boosting_sql(lags: tuple[int, ...], rounds: int, levels: int, bins: int, rate: float, penalty: float) -> str:
    """Boosting from histograms of equal-width bins, written out round by round and level by level."""
    key, at = "region, series", ", ".join(f"lag_{k}" for k in lags)
    looked = ", ".join(f"lag(value, {k}) OVER (PARTITION BY {key} ORDER BY period) AS lag_{k}" for k in lags)
    value = lambda g, h: f"(-{rate} * {g} / ({h} + {penalty}))"
    score = lambda g, h: f"({g} * {g} / ({h} + {penalty}))"
    parts = [
        f"""seen AS (SELECT {key}, period, y, [{at}] AS xs FROM (SELECT {key}, period, value AS y, {looked} FROM hfilled) WHERE lag_{max(lags)} IS NOT NULL)""",
        f"""edges AS (SELECT {key}, f, k, lo + (hi - lo) * (k / {bins}.0) AS edge FROM (SELECT {key}, f, min(xs[f]) AS lo, max(xs[f]) AS hi
            FROM seen, range(1, {len(lags) + 1}) AS c(f) GROUP BY ALL), range(1, {bins}) AS b(k))""",
        f"p0 AS (SELECT *, avg(y) OVER (PARTITION BY {key}) AS p FROM seen)",
    ]
    for t in range(rounds):
        parts.append(f"n{t}_0 AS (SELECT *, p - y AS g, 1 AS node FROM p{t})")
        for level in range(levels):
            rows = f"n{t}_{level}"
            parts.append(
                f"""s{t}_{level} AS (SELECT {key}, node, f, k, edge, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain
                FROM (SELECT {key}, node, f, k, edge, sum(g) AS g, count(*) AS h, coalesce(sum(g) FILTER (xs[f] <= edge), 0) AS gl, count(*) FILTER (xs[f] <= edge) AS hl
                      FROM {rows} JOIN edges USING ({key}) GROUP BY ALL) WHERE hl >= 1 AND h - hl >= 1 AND node >= {1 << level}),
                b{t}_{level} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}, node ORDER BY gain DESC, f, k) AS place FROM s{t}_{level}) WHERE place = 1 AND gain / 2 > 1e-6),
                n{t}_{level + 1} AS (SELECT {key}, period, y, xs, p, g, CASE WHEN b.f IS NULL THEN r.node WHEN xs[b.f] <= b.edge THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
                FROM {rows} AS r LEFT JOIN b{t}_{level} AS b USING ({key}, node))"""
            )
        leaves = f"n{t}_{levels}"
        parts.append(
            f"p{t + 1} AS (SELECT {key}, period, y, xs, p + {value(f'sum(g) OVER (PARTITION BY {key}, node)', f'count(*) OVER (PARTITION BY {key}, node)')} AS p FROM {leaves})"
        )
    return "\n, " + ",\n".join(parts) + f"\nSELECT {key}, period, y, p AS yhat FROM p{rounds}"


_SERIES_LAGS = (1, 2, 24)


@query(
    with_views(_boosting_sql(_SERIES_LAGS, rounds=2, levels=2, bins=8, rate=0.3, penalty=1.0), "hfilled").replace("\n, seen", ",\nseen"),
    ["period"],
    ["y", "yhat"],
    digits=3,
)
def fit_boosted_series(spark, sf_dir):
    """Two trees of two levels for every series, all series at once."""
    trees = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}
    config = model_for("hourly", trees, lags=_SERIES_LAGS, roll_windows=(), calendar=False)
    options = SeriesTreeOptions(edges="width", bins=8)
    rows = materialize(feature_matrix(actuals(spark, sf_dir), config), "features")
    fitted = predict_series(rows, fit_series(rows, config, options), config, options)
    return fitted.select(*KEYS, "period", "y", F.col("z").alias("yhat"))


@query()
def fit_boosted_default(spark, sf_dir):
    """The default 600 trees of depth 6 on all feature rows, a model for each series."""
    rows = materialize(feature_matrix(actuals(spark, sf_dir), HOURLY), "features")
    fitted = predict_series(rows, fit_series(rows, HOURLY), HOURLY)
    return fitted.select(*KEYS, "period", "y", F.col("z").alias("yhat"))


@query(
    with_views(
        f"""SELECT region, series, period, y,
                   (sum(y) OVER spot - sum(y) OVER own + {WEIGHT} * (sum(y) OVER () - sum(y) OVER fold) / (count(*) OVER () - count(*) OVER fold))
                   / (count(*) OVER spot - count(*) OVER own + {WEIGHT}) AS usual
            FROM (SELECT *, CAST(floor(epoch_us(period) / 86400000000) AS BIGINT) % {FOLDS} AS f FROM hfeatures)
            WINDOW spot AS (PARTITION BY region, series, hour), own AS (PARTITION BY region, series, hour, f), fold AS (PARTITION BY f)""",
        "hfeatures",
    ),
    ["period"],
    ["y", "usual"],
    digits=5,
)
def season_code(spark, sf_dir):
    """What is usual for each series and hour, without the row's own fold."""
    rows = materialize(feature_matrix(actuals(spark, sf_dir), HOURLY), "features")
    return encoding.season_code(rows, encoding.code_sums(rows, HOURLY), HOURLY).select(*KEYS, "period", "y", encoding.CODE)


_LINEAR_COLUMNS = ("hour_sin", "dow_cos", "lag_1", "lag_2", "lag_24", "lag_168", "rollmean_24")


@query(
    with_views(
        f"""SELECT region, series, feature, 0.0 AS balance, count(*) AS n
            FROM hfeatures, (VALUES {", ".join(f"('{c}')" for c in _LINEAR_COLUMNS)}) AS c(feature)
            GROUP BY region, series, feature""",
        "hfeatures",
    ),
    doubles=["balance"],
    digits=5,
)
def linear_normal_equations(spark, sf_dir):
    """The fit on all features and rows: residuals are orthogonal to every feature, as least squares demands."""
    config, learner = model_for("hourly", ridge=0.0), LinearLearner()
    rows = materialize(feature_matrix(actuals(spark, sf_dir), config), "features")
    fitted = learner.predict(rows, learner.fit(rows, config), config).withColumn("rest", F.col("y") - F.col("z"))
    sums = fitted.groupBy(*KEYS).agg(
        *[(F.sum(F.col(c) * F.col("rest")) / F.sum(F.abs(F.col(c) * F.col("y")))).alias(c) for c in _LINEAR_COLUMNS],
        F.count(F.lit(1)).alias("n"),
    )
    # The two ways to write zero are one.
    return sums.unpivot([*KEYS, "n"], list(_LINEAR_COLUMNS), "feature", "balance").withColumn(
        "balance", F.round("balance", 5) + 0.0
    )


_ONE_LAG_SQL = """
    , pairs AS (SELECT region, series, period, y, lag_24,
                       row_number() OVER (PARTITION BY region, series ORDER BY period) AS pos,
                       count(*) OVER (PARTITION BY region, series) AS n
                FROM (SELECT region, series, period, value AS y,
                             lag(value, 24) OVER (PARTITION BY region, series ORDER BY period) AS lag_24 FROM hfilled)
                WHERE lag_24 IS NOT NULL),
    sized AS (SELECT *, n - CAST(round_even(n * 0.2, 0) AS BIGINT) AS n_train FROM pairs),
    model AS (SELECT region, series, regr_slope(y, lag_24) AS slope, regr_intercept(y, lag_24) AS base,
                     max(period) AS issue_time FROM sized WHERE pos <= n_train GROUP BY region, series)
    SELECT region, series, issue_time, period AS target_time, base + slope * lag_24 AS yhat
    FROM sized JOIN model USING (region, series) WHERE pos > n_train"""


@query(
    with_views(_ONE_LAG_SQL, "hfilled").replace("\n, pairs", ",\npairs"), ["issue_time", "target_time"], ["yhat"], digits=3
)
def split_forecast(spark, sf_dir):
    """Chronological split with a one-lag linear model."""
    return backtesting.split_forecast(actuals(spark, sf_dir), 0.2, ONE_LAG, LinearLearner())[0]


@query()
def split_forecast_linear(spark, sf_dir):
    return backtesting.split_forecast(actuals(spark, sf_dir, "daily"), 0.2, DAILY, LinearLearner())[0]


@query()
def split_forecast_boosted(spark, sf_dir):
    config = model_for("hourly", SMALL_TREES)
    return backtesting.split_forecast(actuals(spark, sf_dir), 0.2, config, BoostedLearner())[0]


@query(
    with_views(
        """, pairs AS (SELECT region, series, period, value AS y,
                              lag(value) OVER (PARTITION BY region, series ORDER BY period) AS x FROM hfilled),
           model AS (SELECT region, series, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base,
                            max(period) AS origin, arg_max(y, period) AS last_value
                     FROM pairs GROUP BY region, series),
           path AS (
             SELECT region, series, origin, slope, base, 0 AS step_no, last_value AS yhat FROM model
             UNION ALL
             SELECT region, series, origin, slope, base, step_no + 1, base + slope * yhat FROM path WHERE step_no < 48)
           SELECT region, series, origin AS issue_time, origin + step_no * INTERVAL 1 HOUR AS target_time, yhat
           FROM path WHERE step_no > 0""",
        "hfilled",
    )
    .replace("\n, pairs", ",\npairs")
    .replace("WITH readings", "WITH RECURSIVE readings", 1),
    ["issue_time", "target_time"],
    ["yhat"],
    digits=3,
)
def recursive_forecast(spark, sf_dir):
    """A one-lag linear model that feeds on its own predictions."""
    return forecasting.forecast_grouped(actuals(spark, sf_dir), 48, LAST_STEP, LinearLearner())


@query(
    with_views(
        f"""SELECT region, series, origin AS issue_time, target_time, yhat
            FROM ({naive_forecast('hfilled', 'HOUR', 24, 168)})""",
        "hfilled",
    ),
    ["issue_time", "target_time"],
    ["yhat"],
)
def forecast_grouped(spark, sf_dir):
    return forecasting.forecast_grouped(actuals(spark, sf_dir), 168, HOURLY, SeasonalNaive())


@query()
def forecast_grouped_linear(spark, sf_dir):
    return forecasting.forecast_grouped(actuals(spark, sf_dir), 168, HOURLY, LinearLearner())


@query()
def forecast_grouped_boosted(spark, sf_dir):
    config = model_for("daily", SMALL_TREES)
    return forecasting.forecast_grouped(actuals(spark, sf_dir, "daily"), 90, config, BoostedLearner())


#: Differences only: no coefficients, so every step repeats the last season's change.
PLAIN_ORDER = arima.Order(p=0, q=0, P=0, Q=0)
PLAIN_DAILY = arima.Order(p=0, q=0, P=0, Q=0, season=7)


def _plain_path(filled: str, horizon: int, unit: str = "HOUR", season: int = 24) -> str:
    return f"""SELECT p.region, p.series, p.origin, p.step_no, p.target_time,
                      p.yhat + ceil(p.step_no / {season}.0) * (l.value - b.value) AS yhat
               FROM ({naive_forecast(filled, unit, season, horizon)}) AS p
               JOIN {filled} AS l ON l.region = p.region AND l.series = p.series AND l.period = p.origin
               JOIN {filled} AS b ON b.region = p.region AND b.series = p.series AND b.period = p.origin - INTERVAL {season} {unit}"""


@query(
    with_views(f"SELECT region, series, origin AS issue_time, target_time, yhat FROM ({_plain_path('hfilled', 168)})", "hfilled"),
    ["issue_time", "target_time"],
    ["yhat"],
    digits=4,
)
def seasonal_arima_differences(spark, sf_dir):
    learner = arima.ArimaLearner(PLAIN_ORDER)
    return forecasting.forecast_grouped(actuals(spark, sf_dir), 168, HOURLY, learner)


@query(
    f"""WITH s AS (SELECT l_returnflag AS region, l_returnflag || ' ' || l_linestatus AS series,
                          CAST(l_shipdate AS TIMESTAMP) AS period, sum(l_extendedprice) AS value FROM lineitem GROUP BY ALL),
             ends AS (SELECT region, series, max(period) AS last FROM s GROUP BY ALL),
             dfilled AS (SELECT region, series, period, value FROM s JOIN ends USING (region, series)
                         WHERE period <= last - INTERVAL 28 DAY),
             path AS ({_plain_path('dfilled', 28, 'DAY', 7)}),
             scored AS (SELECT {metrics('region, series', empty='NULL')}
                        FROM (SELECT s.region, s.series, s.value, p.yhat FROM path AS p JOIN s
                                ON s.region = p.region AND s.series = p.series AND s.period = p.target_time)
                        GROUP BY region, series)
        SELECT '{PLAIN_DAILY.label}' AS params, {", ".join(f"avg({e}) AS {e}" for e in ERRORS)}, count(*) AS n_series
        FROM scored WHERE n = 28""",
    doubles=ERRORS,
    digits=3,
)
def arima_grid_search_differences(spark, sf_dir):
    """The search with the order that SQL can repeat, on dense daily shipments."""
    results = tuning.arima_grid_search(shipments(spark, sf_dir), [PLAIN_DAILY], horizon=28, resolution="daily")
    return results.select("params", *ERRORS, "n_series")


@query(
    with_views(
        """, steps AS (SELECT *, value - lag(value) OVER s - lag(value, 24) OVER s + lag(value, 25) OVER s AS w FROM hfilled
                       WINDOW s AS (PARTITION BY region, series ORDER BY period)),
           paired AS (SELECT *, coalesce(lag(w) OVER (PARTITION BY region, series ORDER BY period), 0) AS w1 FROM steps WHERE w IS NOT NULL),
           model AS (SELECT region, series, max(period) AS origin, sum(w * w1) / sum(w1 * w1) AS phi, arg_max(w, period) AS w, arg_max(value, period) AS last
                     FROM paired GROUP BY region, series)
           SELECT m.region, m.series, m.origin AS issue_time, CAST(h AS INTEGER) AS step_no, m.origin + h * INTERVAL 1 HOUR AS target_time,
                  back.value + m.last - season.value + m.w * phi * (1 - power(phi, h)) / (1 - phi) AS yhat
           FROM model AS m, range(1, 25) AS r(h), hfilled AS back, hfilled AS season
           WHERE back.region = m.region AND back.series = m.series AND back.period = m.origin + (h - 24) * INTERVAL 1 HOUR
             AND season.region = m.region AND season.series = m.series AND season.period = m.origin - INTERVAL 24 HOUR""",
        "hfilled",
    ).replace("\n, steps", ",\nsteps"),
    ["issue_time", "target_time"],
    ["yhat"],
    digits=3,
)
def seasonal_arima_ar1(spark, sf_dir):
    """(1,1,0)×(0,1,0,24): the coefficient is a ratio of two sums, and the path its powers."""
    learner = arima.ArimaLearner(arima.Order(p=1, q=0, P=0, Q=0))
    ahead = forecasting.forecast_grouped(actuals(spark, sf_dir), 24, HOURLY, learner)
    hours = (F.unix_timestamp("target_time") - F.unix_timestamp("issue_time")) / 3600
    return ahead.select(*KEYS, "issue_time", hours.cast("int").alias("step_no"), "target_time", "yhat")


@query()
def seasonal_arima(spark, sf_dir):
    return forecasting.forecast_grouped(actuals(spark, sf_dir), 168, HOURLY, arima.ArimaLearner())


@query(
    backtest_views(
        """SELECT b.region, b.series, s.issue_time, b.target_time, b.yhat
           FROM backtest AS b JOIN (
             SELECT region, series, max(period) AS issue_time FROM trained WHERE value IS NOT NULL
             GROUP BY region, series) AS s USING (region, series)"""
    ),
    ["issue_time", "target_time"],
    ["yhat"],
)
def holdout_backtest(spark, sf_dir):
    return backtesting.holdout_backtest(actuals(spark, sf_dir), 168, HOURLY, SeasonalNaive())[0]


@query(
    backtest_views(
        f"""SELECT {metrics('region, series')}, any_value(points) AS train_points
            FROM (SELECT h.region, h.series, h.value, b.yhat, t.points
                  FROM backtest AS b JOIN hourly AS h
                    ON h.region = b.region AND h.series = b.series AND h.period = b.target_time
                  JOIN (SELECT region, series, count(value) AS points FROM trained GROUP BY region, series) AS t
                    ON t.region = b.region AND t.series = b.series)
            GROUP BY region, series"""
    ),
    doubles=ERRORS,
)
def backtest_report(spark, sf_dir):
    report = backtesting.backtest_report(actuals(spark, sf_dir), 168, HOURLY, SeasonalNaive())
    return report.by_series.select(*KEYS, *ERRORS, "n", "train_points")


@query()
def backtest_report_linear(spark, sf_dir):
    report = backtesting.backtest_report(actuals(spark, sf_dir, "daily"), 90, DAILY, LinearLearner())
    return report.by_series


def _held_by_count(horizon: int) -> str:
    """Training rows before the last observed values, their fill and the naive forecast by position."""
    return f"""
    , seen AS (SELECT *, row_number() OVER (PARTITION BY region, series ORDER BY period) AS pos,
                      count(*) OVER (PARTITION BY region, series) AS n FROM hgrid WHERE value IS NOT NULL),
    held AS (SELECT region, series, period, value, pos - n + {horizon} AS step_no
             FROM seen WHERE n >= {horizon} + 96 AND pos > n - {horizon}),
    trained AS (SELECT g.region, g.series, g.period, g.value
                FROM hgrid AS g JOIN (SELECT region, series, min(period) AS test_start FROM held
                                      GROUP BY region, series) AS s USING (region, series)
                WHERE g.period < s.test_start),
    tfilled AS (
        SELECT region, series, period,
               CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
                    ELSE pv + (nv - pv) * (epoch(period) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS value
        FROM (SELECT *,
                     last_value(value IGNORE NULLS) OVER back AS pv,
                     last_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER back AS pt,
                     first_value(value IGNORE NULLS) OVER ahead AS nv,
                     first_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER ahead AS nt
              FROM trained
              WINDOW back AS (PARTITION BY region, series ORDER BY period
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     ahead AS (PARTITION BY region, series ORDER BY period
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
    backtest AS ({naive_forecast('tfilled', 'HOUR', 24, horizon)})
    SELECT {metrics('region, series')}
    FROM (SELECT h.region, h.series, h.value, b.yhat
          FROM held AS h JOIN backtest AS b USING (region, series, step_no))
    GROUP BY region, series"""


@query(with_views(_held_by_count(48), "hgrid").replace("\n, seen", ",\nseen"), doubles=ERRORS)
def refit_backtest(spark, sf_dir):
    report = backtesting.refit_backtest(actuals(spark, sf_dir), 48, HOURLY, SeasonalNaive())
    return report.by_series.select(*KEYS, *ERRORS, "n")


@query()
def refit_backtest_arima(spark, sf_dir):
    return backtesting.refit_backtest(actuals(spark, sf_dir), 48, HOURLY, arima.ArimaLearner()).overall


class DepthSeason(SeasonalNaive):
    """Repeats as many last steps as ``max_depth`` says, so that a parameter changes the forecast."""

    def season(self, config):
        return config.trees.max_depth


def _tuning_sql(horizon: int, minimum: int) -> str:
    fields = ("combo_id", "n_estimators", "max_depth", "learning_rate", "min_child_weight")
    combos = ", ".join("(" + ", ".join(str(c[f]) for f in fields) + ")" for c in tuning.grid_combos())
    paths = " UNION ALL ".join(
        f"SELECT {d} AS max_depth, * FROM ({naive_forecast('trained', 'DAY', d, horizon)})" for d in TREE_GRID["max_depth"]
    )
    return f"""
    , long AS (SELECT region, series FROM daily GROUP BY region, series HAVING count(value) > {horizon} + {minimum}),
    placed AS (SELECT f.*, row_number() OVER (PARTITION BY region, series ORDER BY period) AS pos,
                      count(*) OVER (PARTITION BY region, series) AS n
               FROM dfilled AS f SEMI JOIN long USING (region, series)),
    trained AS (SELECT region, series, period, value FROM placed WHERE pos <= n - {horizon}),
    held AS (SELECT region, series, value, pos - n + {horizon} AS step_no FROM placed WHERE pos > n - {horizon}),
    paths AS ({paths}),
    scored AS (SELECT {metrics('max_depth, region, series', empty='NULL')}
               FROM held JOIN paths USING (region, series, step_no) GROUP BY max_depth, region, series)
    SELECT '3mo' AS "window", {", ".join(f"c.{f}" for f in fields if f != "learning_rate")}, CAST(c.learning_rate AS DOUBLE) AS learning_rate,
           {", ".join(f"avg({e}) AS {e}" for e in ERRORS)}, count(*) AS n_series
    FROM scored AS s JOIN (VALUES {combos}) AS c({", ".join(fields)}) ON s.max_depth = c.max_depth
    GROUP BY {", ".join(f"c.{f}" for f in fields)}"""


@query(with_views(_tuning_sql(90, 60), "daily", "dfilled").replace("\n, long", ",\nlong"), doubles=[*ERRORS, "learning_rate"])
def grid_search(spark, sf_dir):
    """The search over the whole default grid, with a learner whose forecasts SQL can repeat."""
    results = tuning.grid_search(actuals(spark, sf_dir, "daily"), window("3mo"), DepthSeason())
    return results.drop("subsample", "colsample_bytree")


@query()
def grid_search_boosted(spark, sf_dir):
    """The whole default grid with boosted trees, a model for each series; eight fits score all sixteen combinations."""
    results = tuning.grid_search(actuals(spark, sf_dir), window("7d"), SeriesBoostedLearner())
    return best_combo(results)


@query()
def arima_grid_search(spark, sf_dir):
    """All 36 orders on dense daily shipments with a weekly season."""
    orders = arima.order_grid(season=7)
    return tuning.arima_grid_search(shipments(spark, sf_dir), orders, horizon=28, resolution="daily")


def _windows_sql() -> str:
    """Naive holdout backtests of all windows; one block of sub-queries per window."""
    blocks, results = [], []
    for key, grid, unit, season, horizon, actual in (
        ("7d", "hgrid", "HOUR", 24, 168, "hourly"),
        ("14d", "hgrid", "HOUR", 24, 336, "hourly"),
        ("1mo", "hgrid", "HOUR", 24, 720, "hourly"),
        ("3mo", "dgrid", "DAY", 7, 90, "daily"),
        ("6mo", "dgrid", "DAY", 7, 180, "daily"),
        ("1yr", "dgrid", "DAY", 7, 365, "daily"),
    ):
        t = f"w{key}"
        blocks.append(f"""
    {t}_train AS (
        SELECT g.region, g.series, g.period, g.value FROM {grid} AS g JOIN (
            SELECT region, series, max(period) FILTER (value IS NOT NULL) - INTERVAL {horizon - 1} {unit} AS test_start
            FROM {grid} GROUP BY region, series HAVING count(value) > {horizon}) AS e USING (region, series)
        WHERE g.period < e.test_start),
    {t}_filled AS (
        SELECT region, series, period,
               CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
                    ELSE pv + (nv - pv) * (epoch(period) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS value
        FROM (SELECT *,
                     last_value(value IGNORE NULLS) OVER back AS pv,
                     last_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER back AS pt,
                     first_value(value IGNORE NULLS) OVER ahead AS nv,
                     first_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER ahead AS nt
              FROM {t}_train
              WINDOW back AS (PARTITION BY region, series ORDER BY period
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     ahead AS (PARTITION BY region, series ORDER BY period
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
    {t}_path AS ({naive_forecast(f'{t}_filled', unit, season, horizon)})""")
        results.append(f"""
    SELECT '{key}' AS "window", {metrics('region, series')}
    FROM (SELECT a.region, a.series, a.value, p.yhat FROM {t}_path AS p JOIN {actual} AS a
            ON a.region = p.region AND a.series = p.series AND a.period = p.target_time)
    GROUP BY region, series""")
    head = with_views("", "hgrid", "dgrid").rstrip()
    return f"{head},\n{', '.join(blocks)}\n{' UNION ALL '.join(results)}"


@query(_windows_sql(), doubles=ERRORS, digits=6)
def run_windows(spark, sf_dir):
    """Every window forecast and backtested; no series is long enough for the one-month window."""
    tables = {"hourly": actuals(spark, sf_dir), "daily": actuals(spark, sf_dir, "daily")}
    results = windows.run_windows(tables, SeasonalNaive(), fraction=0.0)
    return results["metrics"].select("window", *KEYS, *ERRORS, "n")


_one_lag_parts = _ONE_LAG_SQL.rsplit("SELECT region, series, issue_time", 1)


@query(
    with_views(
        f"""{_one_lag_parts[0].rstrip()},
            ahead AS (SELECT region, series, issue_time{_one_lag_parts[1]})
            SELECT '7d' AS "window", {metrics('region, series')}
            FROM (SELECT h.region, h.series, h.value, a.yhat FROM ahead AS a JOIN hourly AS h
                    ON h.region = a.region AND h.series = a.series AND h.period = a.target_time)
            GROUP BY region, series""",
        "hourly",
        "hfilled",
    ).replace("\n, pairs", ",\npairs"),
    doubles=ERRORS,
    digits=3,
)
def run_windows_split(spark, sf_dir):
    """The job with its default split, for a learner that has one."""
    tables = {"hourly": actuals(spark, sf_dir)}
    results = windows.run_windows(tables, LinearLearner(), ["7d"], configure=lambda _: ONE_LAG)
    return results["metrics"].select("window", *KEYS, *ERRORS, "n")


@query(
    with_views(
        """SELECT region, series, period, value,
                  lag(value, 24) OVER (PARTITION BY region, series ORDER BY period) AS yhat FROM hfilled""",
        "hfilled",
    ),
    ["period"],
    ["value", "yhat"],
)
def seasonal_naive(spark, sf_dir):
    return one_season_back(regular_grid(actuals(spark, sf_dir), fill=True), 24)


_FLAGSHIP_SQL = f"""
    , split AS (SELECT h.*, f.value AS filled FROM hholdout AS h JOIN hfilled AS f USING (region, series, period)),
    naive AS (SELECT *, lag(filled, 24) OVER (PARTITION BY region, series ORDER BY period) AS yhat FROM split)
    SELECT {metrics('region, series')} FROM naive WHERE is_test AND value IS NOT NULL AND yhat IS NOT NULL
    GROUP BY region, series"""


@query(
    with_views(_FLAGSHIP_SQL, "hholdout", "hfilled").replace("\n, split", ",\nsplit"), doubles=ERRORS
)
def score_last_week(spark, sf_dir):
    """Readings to totals, grid, gap fill, seasonal forecast, holdout, join and metrics."""
    from ..operators.evaluate import forecast_metrics, join_actual_forecast
    from ..operators.splits import split_holdout_calendar

    seen = actuals(spark, sf_dir)
    grid = materialize(regular_grid(seen), "grid")
    naive = one_season_back(regular_grid(grid, fill=True), 24)
    held = split_holdout_calendar(grid, 168).where("is_test").select(*KEYS, "period")
    forecast = naive.join(held, [*KEYS, "period"], "left_semi").select(
        *KEYS, F.col("period").alias("target_time"), "yhat"
    )
    return forecast_metrics(join_actual_forecast(seen, forecast))
