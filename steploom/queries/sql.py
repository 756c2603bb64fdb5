"""Named sub-queries shared by the comparison SQL."""

from __future__ import annotations

from .data import DAILY_REGIONS, EVERY_DAILY_REGION, EVERY_HOURLY_REGION, HOURLY_REGIONS


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _grid(source: str, unit: str) -> str:
    return f"""
    SELECT s.region, s.series, s.period, a.value
    FROM (SELECT region, series, unnest(generate_series(min(period), max(period), INTERVAL 1 {unit})) AS period
          FROM {source} GROUP BY region, series) AS s
    LEFT JOIN {source} AS a USING (region, series, period)"""


def _filled(grid: str) -> str:
    return f"""
    SELECT region, series, period,
           CASE WHEN value IS NOT NULL THEN value
                WHEN pv IS NULL THEN nv
                WHEN nv IS NULL THEN pv
                ELSE pv + (nv - pv) * (epoch(period) - epoch(pt)) / (epoch(nt) - epoch(pt)) END AS value
    FROM (SELECT *,
                 last_value(value IGNORE NULLS) OVER back AS pv,
                 last_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER back AS pt,
                 first_value(value IGNORE NULLS) OVER ahead AS nv,
                 first_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER ahead AS nt
          FROM {grid}
          WINDOW back AS (PARTITION BY region, series ORDER BY period
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 ahead AS (PARTITION BY region, series ORDER BY period
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS around"""


def _lookback(source: str, lags, rolls) -> str:
    parts = [f"lag(value, {k}) OVER w AS lag_{k}" for k in lags]
    for r in rolls:
        frame = f"(PARTITION BY region, series ORDER BY period ROWS BETWEEN {r} PRECEDING AND 1 PRECEDING)"
        parts.append(f"CASE WHEN count(value) OVER {frame} = {r} THEN avg(value) OVER {frame} END AS rollmean_{r}")
    return f"""
    SELECT region, series, period, value, {', '.join(parts)}
    FROM {source} WINDOW w AS (PARTITION BY region, series ORDER BY period)"""


CALENDAR_HOURLY = """
    CAST(hour(period) AS INTEGER) AS hour, CAST(isodow(period) - 1 AS INTEGER) AS dayofweek,
    CAST(month(period) AS INTEGER) AS month,
    CASE WHEN isodow(period) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    sin(2 * pi() * hour(period) / 24) AS hour_sin, cos(2 * pi() * hour(period) / 24) AS hour_cos,
    sin(2 * pi() * (isodow(period) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(period) - 1) / 7) AS dow_cos"""
CALENDAR_DAILY = """
    CAST(isodow(period) - 1 AS INTEGER) AS dayofweek, CAST(month(period) AS INTEGER) AS month,
    CAST(dayofyear(period) AS INTEGER) AS dayofyear,
    CASE WHEN isodow(period) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    sin(2 * pi() * (isodow(period) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(period) - 1) / 7) AS dow_cos,
    sin(2 * pi() * dayofyear(period) / 365.25) AS doy_sin, cos(2 * pi() * dayofyear(period) / 365.25) AS doy_cos,
    sin(2 * pi() * month(period) / 12) AS month_sin, cos(2 * pi() * month(period) / 12) AS month_cos"""
HOURLY_LAGS, HOURLY_ROLLS = (1, 2, 3, 24, 25, 48, 168), (24, 168)
DAILY_LAGS, DAILY_ROLLS = (1, 2, 3, 7, 14, 28, 365), (7, 30)


def _features(lookback: str, calendar: str, lags, rolls) -> str:
    names = [f"lag_{k}" for k in lags] + [f"rollmean_{r}" for r in rolls]
    complete = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""
    SELECT region, series, period, value AS y, {calendar}, {', '.join(names)}
    FROM {lookback} WHERE {complete}"""


def _holdout(grid: str, unit: str, horizon: int) -> str:
    return f"""
    SELECT g.region, g.series, g.period, g.value, e.test_start, g.period >= e.test_start AS is_test
    FROM {grid} AS g JOIN (
        SELECT region, series, max(period) FILTER (value IS NOT NULL) AS last_seen,
               max(period) FILTER (value IS NOT NULL) - INTERVAL {horizon - 1} {unit} AS test_start
        FROM {grid} GROUP BY region, series HAVING count(value) > {horizon}) AS e USING (region, series)
    WHERE g.period <= e.last_seen"""


def metrics(group: str = "", actual: str = "value", forecast: str = "yhat", empty: str = "0.0") -> str:
    """Select list of the error measures."""
    y, p = actual, forecast
    lead = f"{group}, " if group else ""
    return f"""{lead}avg(abs({y} - {p})) AS mae, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse,
    coalesce(100 * avg(abs({y} - {p}) / abs({y})) FILTER ({y} <> 0), {empty}) AS mape,
    coalesce(100 * avg(abs({y} - {p}) / ((abs({y}) + abs({p})) / 2)) FILTER (abs({y}) + abs({p}) <> 0), {empty}) AS smape,
    count(*) AS n"""


def naive_forecast(filled: str, unit: str, season: int, horizon: int) -> str:
    """Last season repeated after the end of each filled series."""
    return f"""
    SELECT o.region, o.series, o.origin, s.step_no,
           o.origin + s.step_no * INTERVAL 1 {unit} AS target_time, f.value AS yhat
    FROM (SELECT region, series, max(period) AS origin FROM {filled} GROUP BY region, series
          HAVING count(*) >= {season}) AS o
    CROSS JOIN (SELECT unnest(generate_series(1, {horizon})) AS step_no) AS s
    JOIN {filled} AS f ON f.region = o.region AND f.series = o.series
     AND f.period = o.origin - ({season} - 1 - (s.step_no - 1) % {season}) * INTERVAL 1 {unit}"""


_SEASONS = {"7d": ("hfilled", "hourly", (24, 48, 72, 168)), "3mo": ("dfilled", "daily", (7, 14, 28, 364))}


def _scores() -> str:
    parts = []
    for window, (filled, actual, seasons) in _SEASONS.items():
        for combo, season in enumerate(seasons):
            parts.append(f"""
    SELECT '{window}' AS window_key, {combo} AS combo_id, region, series,
           100 * avg(abs(a.value - f.yhat) / abs(a.value)) FILTER (a.value <> 0) AS mape
    FROM {actual} AS a JOIN (
        SELECT region, series, period, lag(value, {season}) OVER (PARTITION BY region, series ORDER BY period) AS yhat
        FROM {filled}) AS f USING (region, series, period)
    WHERE f.yhat IS NOT NULL GROUP BY region, series""")
    return " UNION ALL ".join(parts)


_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": (
        (),
        """SELECT upper(event_type) AS parent, CAST(user_id AS VARCHAR) AS subba,
                  date_trunc('hour', ts) AS period, value, event_id FROM events""",
    ),
    "hourly": (
        ("readings",),
        f"""SELECT parent AS region, parent || ' total' AS series, period, round(sum(value), 2) AS value
            FROM readings WHERE parent IN ({_names(EVERY_HOURLY_REGION)}) GROUP BY parent, period""",
    ),
    "hourly_allowed": (("hourly",), f"SELECT * FROM hourly WHERE region IN ({_names(HOURLY_REGIONS)})"),
    "dreadings": (
        (),
        """SELECT upper(r_name) AS parent, n_name AS subba, o_orderdate AS period, o_totalprice AS value
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey""",
    ),
    "daily": (
        ("dreadings",),
        f"""SELECT parent AS region, parent || ' total' AS series, period, round(sum(value), 2) AS value
            FROM dreadings WHERE parent IN ({_names(EVERY_DAILY_REGION)}) GROUP BY parent, period""",
    ),
    "daily_allowed": (("daily",), f"SELECT * FROM daily WHERE region IN ({_names(DAILY_REGIONS)})"),
    "hgrid": (("hourly",), _grid("hourly", "HOUR")),
    "dgrid": (("daily",), _grid("daily", "DAY")),
    "hfilled": (("hgrid",), _filled("hgrid")),
    "dfilled": (("dgrid",), _filled("dgrid")),
    "hlook": (("hfilled",), _lookback("hfilled", HOURLY_LAGS, HOURLY_ROLLS)),
    "dlook": (("dfilled",), _lookback("dfilled", DAILY_LAGS, DAILY_ROLLS)),
    "hfeatures": (("hlook",), _features("hlook", CALENDAR_HOURLY, HOURLY_LAGS, HOURLY_ROLLS)),
    "dfeatures": (("dlook",), _features("dlook", CALENDAR_DAILY, DAILY_LAGS, DAILY_ROLLS)),
    "hholdout": (("hgrid",), _holdout("hgrid", "HOUR", 168)),
    "dholdout": (("dgrid",), _holdout("dgrid", "DAY", 90)),
    # Day-ahead forecasts: every value of a day issued at its midnight, from the day before.
    "hforecasts": (
        ("hfilled",),
        """SELECT region, series, date_trunc('day', period) AS issue_time, period AS target_time, yhat
           FROM (SELECT *, lag(value, 24) OVER (PARTITION BY region, series ORDER BY period) AS yhat FROM hfilled)
           WHERE yhat IS NOT NULL""",
    ),
    "dforecasts": (
        ("dfilled",),
        """SELECT region, series, date_trunc('month', period) AS issue_time, period AS target_time, yhat
           FROM (SELECT *, lag(value, 7) OVER (PARTITION BY region, series ORDER BY period) AS yhat FROM dfilled)
           WHERE yhat IS NOT NULL""",
    ),
    "joined": (
        ("hourly", "hforecasts"),
        """SELECT h.region, h.series, h.period, h.value, f.issue_time, f.target_time, f.yhat
           FROM hourly AS h JOIN hforecasts AS f
             ON h.region = f.region AND h.series = f.series AND h.period = f.target_time""",
    ),
    "by_series": (("joined",), f"SELECT {metrics('region, series')} FROM joined GROUP BY region, series"),
    "info": (
        ("hourly",),
        """SELECT region, series, count(*) AS points, count(*) * ln(avg(value * value)) + 2 AS aic,
                  count(*) * ln(avg(value * value)) + ln(count(*)) AS bic
           FROM hourly GROUP BY region, series""",
    ),
    "scores": (("hfilled", "dfilled"), _scores()),
    "combos": (
        ("scores",),
        """SELECT window_key, combo_id, avg(mape) AS mape, count(*) AS n_series
           FROM scores GROUP BY window_key, combo_id""",
    ),
}


def with_views(select: str, *names: str) -> str:
    """``select`` behind the named sub-queries and what they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _VIEWS[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in order) + f"\n{select.strip()}"
