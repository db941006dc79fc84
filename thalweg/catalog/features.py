"""Feature tables and the joins under them."""

from __future__ import annotations

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.series import lag_sql, rain_lag_sql
from thalweg.catalog.tables import oracle
from thalweg.operators import features, series

UP, WX = list(features.STATION_LAGS), list(features.WEATHER_LAGS)
LEVEL_LAGS = lag_sql("level__m", UP)
WX_NAMES = [series.shift_name(n, c) for n in WX for c in series.RAIN]
PREFIX = "replace(lower(location), ' ', '_') || '__"

L = f"SELECT *, {LEVEL_LAGS}, row_number() OVER w AS rn FROM {{levels}} WINDOW w AS (PARTITION BY location ORDER BY date)"
R = f"SELECT location, date, {rain_lag_sql(WX)}, row_number() OVER w AS rn FROM {{rain}} WINDOW w AS (PARTITION BY location ORDER BY date)"


def lagged(levels="levels", rain="rain"):
    return {"l": L.format(levels=levels), "r": R.format(rain=rain)}


def lengthen_sql(names, frame):
    """(station, date, feature, value) by one branch per column."""
    return " UNION ALL ".join(f"SELECT station, date, {PREFIX}{n}' AS feature, {n} AS value FROM {frame}" for n in names)


UP_PARTS = f"SELECT station, location, date, {', '.join(series.shift_name(n, 'level__m') for n in UP)} FROM l JOIN edges_up USING (location) WHERE rn > {max(UP)}"
WX_PARTS = f"SELECT station, location, date, {', '.join(WX_NAMES)} FROM r JOIN edges_wx USING (location) WHERE pos = 0 OR rn > {max(WX)}"
UP_NAMES = [series.shift_name(n, "level__m") for n in UP]


@query(
    "join_upstream_levels",
    oracle(
        "levels edges_up",
        f"""SELECT f.station, f.date, f.feature, f.value FROM ({lengthen_sql(UP_NAMES, 'up')}) f
JOIN (SELECT station, date FROM up GROUP BY ALL HAVING count(*) = 2) d ON f.station = d.station AND f.date = d.date
JOIN l ON l.location = f.station AND l.date = f.date""",
        l=L.format(levels="levels"),
        up=UP_PARTS,
    ),
)
def join_upstream_levels(spark, sf):
    """Own rows and upstream rows of every station gathered by day, under the names of the features."""
    mapping, levels = fx.station_mapping(spark, sf), fx.levels(spark, sf)
    joined = features.join_on_date([features.level_rows(levels, features.sources(mapping, weather=False), UP)])
    no_weather = mapping.withColumn("weather_locations", F.array().cast("array<string>"))
    tall = features.lengthen(joined.withColumnRenamed("station", "location"), features.feature_index(no_weather, UP, WX))
    return tall.withColumnRenamed("location", "station").filter(~F.startswith("feature", F.lit("lag")))


@query(
    "join_weather_locations",
    oracle(
        "rain_filled edges_wx",
        f"""SELECT f.station, f.date, f.feature, f.value FROM ({lengthen_sql(WX_NAMES, 'wx')}) f
JOIN (SELECT station, date, count(*) AS n FROM wx GROUP BY ALL) d ON f.station = d.station AND f.date = d.date
WHERE n = (SELECT count(*) FROM edges_wx e WHERE e.station = f.station)""",
        r=R.format(rain="rain_filled"),
        wx=WX_PARTS,
    ),
)
def join_weather_locations(spark, sf):
    mapping = fx.station_mapping(spark, sf)
    rows = features.weather_rows(fx.rain_filled(spark, sf), features.sources(mapping, reference=False, upstream=False), WX)
    joined = features.join_on_date([rows])
    names = features.feature_index(mapping.withColumn("upstream_stations", F.array().cast("array<string>")), UP, WX)
    only = names.withColumn("names", F.slice("names", len(UP) + 1, F.size("names")))
    return features.lengthen(joined.withColumnRenamed("station", "location"), only).withColumnRenamed("location", "station")


def matrix_sql(forecast_days: int, infer: bool = False) -> dict[str, str]:
    """The joined rows, the target and the complete rows as DuckDB tables."""
    wx = f"SELECT station, date, {', '.join(WX_NAMES)}, location FROM wx"
    ups = ", ".join(UP_NAMES)
    target = (
        f"lead(level__m, {forecast_days - 1}) OVER (PARTITION BY station ORDER BY date) AS target, "
        f"row_number() OVER (PARTITION BY station ORDER BY date DESC) AS back"
    )
    nulls = " OR ".join(f"{n} IS NULL" for n in UP_NAMES)
    own = " AND ".join(f"{n} IS NOT NULL" for n in UP_NAMES)
    wx_nulls = " OR ".join(f"{n} IS NULL" for n in WX_NAMES)
    return {
        "up": UP_PARTS,
        "wx": WX_PARTS,
        "whole": f"""SELECT l.location AS station, l.date, level__m, {ups} FROM l
JOIN (SELECT station, date, count(*) AS n, count(*) FILTER (WHERE {nulls}) AS bad FROM up GROUP BY ALL) u ON u.station = l.location AND u.date = l.date
JOIN (SELECT station, date, count(*) AS n, count(*) FILTER (WHERE {wx_nulls}) AS bad FROM ({wx}) GROUP BY ALL) x ON x.station = l.location AND x.date = l.date
WHERE u.n = 2 AND x.n = (SELECT count(*) FROM edges_wx e WHERE e.station = l.location)""",
        "aimed": f"SELECT *, {target} FROM whole",
        "kept": f"""SELECT a.*, target - lag01__level__m AS y FROM aimed a
WHERE back > {forecast_days - 1} AND target IS NOT NULL AND {own}
  AND NOT EXISTS (SELECT 1 FROM up WHERE up.station = a.station AND up.date = a.date AND ({nulls}))
  AND NOT EXISTS (SELECT 1 FROM wx WHERE wx.station = a.station AND wx.date = a.date AND ({wx_nulls}))""",
    }


ENCODED = """CAST(month(k.date) AS INTEGER) AS month, CAST(dayofyear(k.date) AS INTEGER) AS dayofyear,
  round(sin(2 * pi() * (month(k.date) - 1) / 12), 9) AS month_sin, round(cos(2 * pi() * (month(k.date) - 1) / 12), 9) AS month_cos,
  round(sin(2 * pi() * (dayofyear(k.date) - 1) / 365), 9) AS dayofyear_sin, round(cos(2 * pi() * (dayofyear(k.date) - 1) / 365), 9) AS dayofyear_cos"""

N_FEATURES = f"{3 * len(UP)} + {2 * len(WX)} * (SELECT count(*) FROM edges_wx e WHERE e.station = k.station)"


def with_older(rows, value):
    """Every third day a second time, loaded earlier and with another value."""
    older = rows.filter(F.dayofmonth("date") % 3 == 0).withColumn(value, F.col(value) + 1)
    return rows.withColumn("load_seq", F.lit(2)).unionByName(older.withColumn("load_seq", F.lit(1)))


def small_matrix(spark, sf, forecast_days):
    """From inputs with doubled days; the levels have gaps."""
    levels, rain = with_older(fx.levels(spark, sf), "level__m"), with_older(fx.rain_filled(spark, sf), "precipitation_sum")
    return features.feature_matrix(fx.station_mapping(spark, sf), levels, rain, UP, WX, forecast_days, recency=["load_seq"])


@query(
    "feature_matrix",
    oracle(
        "levels rain_filled edges_up edges_wx",
        f"""SELECT k.station AS location, k.date, target AS level__m, y, {ENCODED}, CAST({N_FEATURES} AS INTEGER) AS n_features,
  lag01__level__m, lag03__level__m FROM kept k""",
        **lagged(rain="rain_filled"),
        **matrix_sql(7),
    ),
)
def feature_matrix(spark, sf):
    m = small_matrix(spark, sf, 7)
    return m.select(
        "location", "date", "level__m", "y", "month", "dayofyear",
        *[F.round(c, 9).alias(c) for c in ("month_sin", "month_cos", "dayofyear_sin", "dayofyear_cos")],
        F.size("features").alias("n_features"),
        F.col("features")[0].alias("lag01__level__m"), F.col("features")[1].alias("lag03__level__m"),
    )


LONG = f"""SELECT k.station AS location, k.date, f.feature, f.value FROM kept k
JOIN ({lengthen_sql(UP_NAMES, 'up')} UNION ALL {lengthen_sql(WX_NAMES, 'wx')}
  UNION ALL {" UNION ALL ".join(f"SELECT location, date, '{n}', {n} FROM l" for n in UP_NAMES)}) f ON f.station = k.station AND f.date = k.date"""


@query(
    "feature_matrix_long",
    oracle("levels rain_filled edges_up edges_wx", LONG, **lagged(rain="rain_filled"), **matrix_sql(2)),
)
def feature_matrix_long(spark, sf):
    index = features.feature_index(fx.station_mapping(spark, sf), UP, WX)
    return features.lengthen(small_matrix(spark, sf, 2), index)


@query(
    "join_station_weather",
    oracle("levels rain_filled edges_up edges_wx", LONG.replace("FROM kept k", "FROM whole k"), **lagged(rain="rain_filled"), **matrix_sql(1)),
)
def join_station_weather(spark, sf):
    """Station and weather features of the days on which both are there, incomplete lags included."""
    mapping = fx.station_mapping(spark, sf)
    joined = features.joined_rows(mapping, fx.levels(spark, sf), fx.rain_filled(spark, sf), UP, WX)
    return features.lengthen(joined.withColumnRenamed("station", "location"), features.feature_index(mapping, UP, WX))


CORR = """SELECT location, feature, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 6) AS corr
FROM (SELECT location, feature, corr(y, value) AS c FROM tall GROUP BY ALL)"""
TALL = (
    LONG.replace("f.value FROM", "f.value, k.y FROM")
    + " UNION ALL SELECT station, date, 'month', CAST(month(date) AS DOUBLE), y FROM kept"
    + " UNION ALL SELECT station, date, 'dayofyear', CAST(dayofyear(date) AS DOUBLE), y FROM kept"
    + " UNION ALL SELECT station, date, 'level__m', target, y FROM kept"
    + " UNION ALL SELECT station, date, 'month_sin', sin(2 * pi() * (month(date) - 1) / 12), y FROM kept"
    + " UNION ALL SELECT station, date, 'month_cos', cos(2 * pi() * (month(date) - 1) / 12), y FROM kept"
    + " UNION ALL SELECT station, date, 'dayofyear_sin', sin(2 * pi() * (dayofyear(date) - 1) / 365), y FROM kept"
    + " UNION ALL SELECT station, date, 'dayofyear_cos', cos(2 * pi() * (dayofyear(date) - 1) / 365), y FROM kept"
)
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def correlations(spark, sf):
    index = features.feature_index(fx.station_mapping(spark, sf), UP, WX)
    corr = features.feature_target_corr(small_matrix(spark, sf, 1), index)
    return corr.withColumn("corr", F.round("corr", 6))


@query(
    "feature_target_corr",
    oracle("levels rain_filled edges_up edges_wx", CORR, **lagged(rain="rain_filled"), **matrix_sql(1), tall=TALL),
)
def feature_target_corr(spark, sf):
    return correlations(spark, sf)


@query(
    "feature_corr_table",
    oracle(
        "levels rain_filled edges_up edges_wx",
        "SELECT feature, " + ", ".join(f"max(corr) FILTER (WHERE location = '{r}') AS \"{r}\"" for r in REGIONS) + " FROM corrs GROUP BY feature",
        **lagged(rain="rain_filled"),
        **matrix_sql(1),
        tall=TALL,
        corrs=CORR,
    ),
)
def feature_corr_table(spark, sf):
    """Feature by station: what the correlation chart is drawn from."""
    return features.corr_table(correlations(spark, sf), REGIONS)


@query(
    "completeness_check",
    oracle(
        "levels edges_up days",
        """SELECT e.station, e.location, 91 AS expected, CAST(count(l.date) AS INTEGER) AS found,
  count(l.date) >= 91 AS complete, CAST(91 - count(l.date) AS INTEGER) AS n_missing
FROM edges_up e LEFT JOIN levels l ON l.location = e.location AND l.date BETWEEN DATE '2001-04-02' AND DATE '2001-07-01' GROUP BY ALL""",
    ),
)
def completeness_check(spark, sf):
    mapping = fx.station_mapping(spark, sf)
    done = features.completeness(mapping, "upstream_stations", fx.levels(spark, sf), "2001-04-02", fx.AS_OF)
    return done.withColumn("n_missing", F.size("missing_dates")).drop("missing_dates")


@query("semi_join_locations", oracle("rain edges_wx", "SELECT * FROM rain WHERE location IN (SELECT location FROM edges_wx WHERE station IN ('ASIA', 'EUROPE'))"))
def semi_join_locations(spark, sf):
    wanted = features.edges(fx.station_mapping(spark, sf).filter(F.col("station").isin("ASIA", "EUROPE")), "weather_locations")
    return fx.rain(spark, sf).join(wanted, "location", "left_semi")


@query(
    "circular_encoding",
    oracle("levels", f"SELECT location, k.date, {ENCODED} FROM levels k"),
)
def circular_encoding(spark, sf):
    from thalweg.functions.dates import circular_encoding as encode

    columns = {n: (F.round(e, 9) if "_" in n else e) for n, e in encode("date").items()}
    return fx.levels(spark, sf).select("location", "date", *[e.alias(n) for n, e in columns.items()])
