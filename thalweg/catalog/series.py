"""Series: spines, shifts, fills, gaps, deduplication, target."""

from __future__ import annotations

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import oracle
from thalweg.functions.dates import date_spine
from thalweg.operators import series
from thalweg.sources import sinks

STATION_LAGS = [1, 3, 7, 14, 30]
WEATHER_LAGS = [1, 3, 7, 14, 30, 0, -2, -6]


def lag_sql(column: str, lags, window: str = "w") -> str:
    parts = []
    for lag in lags:
        if lag > 0:
            parts.append(f"lag({column}, {lag}) OVER {window} AS lag{lag:02d}__{column}")
        else:
            parts.append(f"lead({column}, {-lag}) OVER {window} AS forecast{1 - lag:02d}__{column}")
    return ", ".join(parts)


def rain_lag_sql(lags) -> str:
    return lag_sql("precipitation_sum", lags) + ", " + lag_sql("precipitation_hours", lags)


W = "WINDOW w AS (PARTITION BY location ORDER BY date)"


@query("date_spine", oracle("levels days", "SELECT location, date FROM (SELECT DISTINCT location FROM levels) CROSS JOIN days"))
def spine(spark, sf):
    return date_spine(fx.levels(spark, sf).select("location").distinct(), fx.BEGIN, fx.END)


@query("station_lags", oracle("levels", f"SELECT *, {lag_sql('level__m', STATION_LAGS)} FROM levels {W}"))
def station_lags(spark, sf):
    return series.station_lags(fx.levels(spark, sf), STATION_LAGS)


@query(
    "station_lags_calendar",
    oracle(
        "levels",
        """SELECT a.location, a.date, b.level__m AS lag01__level__m, c.level__m AS lag07__level__m
FROM levels a LEFT JOIN levels b ON a.location = b.location AND b.date = a.date - 1
  LEFT JOIN levels c ON a.location = c.location AND c.date = a.date - 7""",
    ),
)
def station_lags_calendar(spark, sf):
    return series.station_lags(fx.levels(spark, sf), [1, 7], only_lag_columns=True, calendar=True)


@query("weather_lags_leads", oracle("rain", f"SELECT location, date, {rain_lag_sql(WEATHER_LAGS)} FROM rain {W}"))
def weather_lags_leads(spark, sf):
    return series.weather_shifts(fx.rain(spark, sf), WEATHER_LAGS)


@query("weather_lags_leads_fleet", oracle("fleet", f"SELECT location, date, {rain_lag_sql([7, 1, 0, -2])} FROM fleet {W}"))
def weather_lags_leads_fleet(spark, sf):
    rain = fx.fleet(spark, sf).withColumnRenamed("location_name", "location")
    return series.weather_shifts(rain, [7, 1, 0, -2])


@query("weather_lags_stored_series", oracle("fleet", f"SELECT location, date, {rain_lag_sql(WEATHER_LAGS)} FROM fleet {W}"))
def weather_lags_stored_series(spark, sf):
    """All lags of the fleet over a table stored by location: one shuffle to store it, none to shift it."""
    rain = fx.fleet(spark, sf).withColumnRenamed("location_name", "location")
    return series.weather_shifts(sinks.store_series(rain, 8), WEATHER_LAGS)


@query(
    "ffill_bfill_levels",
    oracle(
        "river_dirty",
        """SELECT location_name, date, coalesce(
    last_value(level_m IGNORE NULLS) OVER (PARTITION BY location_name ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(level_m IGNORE NULLS) OVER (PARTITION BY location_name ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level_m
FROM (SELECT location_name, date, arg_max(level_m, load_seq) FILTER (WHERE level_m IS NOT NULL OR load_seq = 2) AS level_m FROM river_dirty GROUP BY ALL)""",
    ),
)
def ffill_bfill_levels(spark, sf):
    """The correction of a day counts, then holes are filled."""
    dirty = series.dedup_keep_last(fx.river_dirty(spark, sf), ("location_name", "date"), ("load_seq",)).drop("load_seq")
    return series.fill_values(dirty, ["level_m"], key="location_name")


@query(
    "ffill_zero_weather",
    oracle(
        "rain",
        """SELECT location, date, coalesce(last_value(precipitation_sum IGNORE NULLS) OVER w, 0.0) AS precipitation_sum,
  coalesce(last_value(precipitation_hours IGNORE NULLS) OVER w, 0.0) AS precipitation_hours
FROM (SELECT location, date, CASE WHEN month(date) > 2 THEN precipitation_sum END AS precipitation_sum,
        CASE WHEN day(date) > 5 THEN precipitation_hours END AS precipitation_hours FROM rain)
WINDOW w AS (PARTITION BY location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
)
def ffill_zero_weather(spark, sf):
    holes = fx.rain(spark, sf).select(
        "location",
        "date",
        F.when(F.month("date") > 2, F.col("precipitation_sum")).alias("precipitation_sum"),
        F.when(F.dayofmonth("date") > 5, F.col("precipitation_hours")).alias("precipitation_hours"),
    )
    return series.fill_values(holes, list(series.RAIN), leading=0.0)


@query(
    "dedup_keep_last",
    oracle(
        "river_dirty",
        """SELECT location_name, date, level_m, load_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY location_name, date ORDER BY load_seq DESC) AS rn FROM river_dirty) WHERE rn = 1""",
    ),
)
def dedup_keep_last(spark, sf):
    return series.dedup_keep_last(fx.river_dirty(spark, sf), ("location_name", "date"), ("load_seq",))


@query(
    "dedup_latest_of_day",
    oracle(
        "readings",
        """SELECT location, CAST(ts AS DATE) AS date, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY location, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM readings) WHERE rn = 1""",
    ),
)
def dedup_latest_of_day(spark, sf):
    newest = series.dedup_latest_of_day(fx.readings(spark, sf))
    return newest.select("location", F.col("ts").cast("date").alias("date"), "event_id", "value")


@query(
    "duplicate_days",
    oracle("readings", "SELECT location, CAST(ts AS DATE) AS date, count(*) AS n FROM readings GROUP BY ALL HAVING count(*) > 1"),
)
def duplicate_days(spark, sf):
    return series.duplicate_days(fx.readings(spark, sf))


@query(
    "cut_first_k",
    oracle("levels", "SELECT location, date, level__m FROM (SELECT *, row_number() OVER (PARTITION BY location ORDER BY date) AS rn FROM levels) WHERE rn > 30"),
)
def cut_first_k(spark, sf):
    return series.cut_first(fx.levels(spark, sf), 30)


@query(
    "target_y",
    oracle(
        "levels",
        """SELECT location, date, lag01__level__m, ahead AS level__m, ahead - lag01__level__m AS y
FROM (SELECT *, lead(level__m, 6) OVER w AS ahead, lag(level__m, 1) OVER w AS lag01__level__m,
        row_number() OVER (PARTITION BY location ORDER BY date DESC) AS back FROM levels WINDOW w AS (PARTITION BY location ORDER BY date))
WHERE back > 6""",
    ),
)
def target_y(spark, sf):
    return series.target_difference(series.station_lags(fx.levels(spark, sf), [1]), 7)


@query(
    "prev_row_baseline",
    oracle("levels", "SELECT location, date, y, lag(y, 1) OVER (PARTITION BY location ORDER BY date) AS baseline FROM (SELECT location, date, level__m - lag(level__m, 1) OVER (PARTITION BY location ORDER BY date) AS y FROM levels)"),
)
def prev_row_baseline(spark, sf):
    rows = series.target_difference(series.station_lags(fx.levels(spark, sf), [1]), 1)
    return rows.select("location", "date", "y", F.lag("y", 1).over(series.by_day()).alias("baseline"))


GAPS = f"""SELECT l.location, d.date FROM (SELECT DISTINCT location FROM levels) l CROSS JOIN days d
  LEFT JOIN levels v ON v.location = l.location AND v.date = d.date WHERE v.date IS NULL"""


@query("missing_dates", oracle("levels days", GAPS))
def missing_dates(spark, sf):
    return series.missing_dates(fx.levels(spark, sf), fx.BEGIN, fx.END)


@query(
    "missing_dates_overall",
    oracle("levels", "SELECT date FROM days WHERE date NOT IN (SELECT date FROM levels)", days="SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS date"),
)
def missing_dates_overall(spark, sf):
    return series.missing_dates_overall(fx.levels(spark, sf), fx.BEGIN, fx.END)


ISLANDS = """SELECT location, min(date) AS gap_start, max(date) AS gap_end, count(*) AS days
FROM (SELECT *, date - CAST(row_number() OVER (PARTITION BY location ORDER BY date) AS INTEGER) AS run FROM gaps) GROUP BY location, run"""


@query("gap_islands", oracle("levels days", ISLANDS, gaps=GAPS))
def gap_islands(spark, sf):
    return series.gap_islands(series.missing_dates(fx.levels(spark, sf), fx.BEGIN, fx.END))


@query("gaps_between", oracle("levels days", ISLANDS, gaps=GAPS))
def gaps_between(spark, sf):
    return series.gaps_between(fx.levels(spark, sf), fx.BEGIN, fx.END)


@query("fill_missing_days", oracle("levels_filled", "SELECT * FROM levels_filled"))
def fill_missing_days(spark, sf):
    return fx.levels_filled(spark, sf)


@query("fill_missing_days_weather", oracle("rain_filled", "SELECT * FROM rain_filled"))
def fill_missing_days_weather(spark, sf):
    return fx.rain_filled(spark, sf)


@query(
    "fill_missing_days_range",
    oracle(
        "levels",
        """SELECT location, date, coalesce(
    last_value(level__m IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(level__m IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level__m
FROM (SELECT location, date, max(level__m) AS level__m FROM (
        SELECT location, date, CASE WHEN month(date) > 1 THEN level__m END AS level__m FROM levels
        UNION ALL SELECT l.location, CAST(d AS DATE), NULL FROM (SELECT DISTINCT location FROM levels) l
          CROSS JOIN unnest(generate_series(DATE '1994-12-01', DATE '1997-03-31', INTERVAL 1 DAY)) AS t(d))
      GROUP BY location, date)""",
    ),
)
def fill_missing_days_range(spark, sf):
    """A range that begins before the series and ends inside it; rows beyond it stay."""
    holes = fx.levels(spark, sf).withColumn("level__m", F.when(F.month("date") > 1, F.col("level__m")))
    return series.fill_missing_levels(holes, "1994-12-01", "1997-03-31")


@query(
    "history_then_forecast",
    oracle(
        "rain rain_forecast",
        """SELECT location, date, precipitation_sum, precipitation_hours FROM rain_forecast WHERE date >= DATE '2001-06-15'
UNION ALL
SELECT location, date, precipitation_sum, precipitation_hours FROM rain r WHERE date <= DATE '2001-07-01'
  AND NOT EXISTS (SELECT 1 FROM rain_forecast f WHERE f.location = r.location AND f.date = r.date AND f.date >= DATE '2001-06-15')""",
    ),
)
def history_then_forecast(spark, sf):
    history = fx.rain(spark, sf, end="2001-07-01")
    forecast = fx.rain_forecast(spark, sf).filter(F.col("date") >= "2001-06-15")
    return series.history_then_forecast(history, forecast)


@query(
    "placeholder_row",
    oracle("levels", "SELECT location, date, level__m FROM levels WHERE date < DATE '2001-07-01' UNION ALL SELECT location, DATE '2001-07-01', 0.0 FROM (SELECT DISTINCT location FROM levels)"),
)
def placeholder_row(spark, sf):
    levels = fx.levels(spark, sf)
    places = levels.select("location").distinct()
    return series.placeholder_rows(levels.filter(F.col("date") < F.lit(fx.AS_OF)), places, fx.AS_OF)
