"""Composite jobs: inference, catch-up, training, reports, streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog import evaluation as ev
from thalweg.catalog.features import PREFIX, UP, WX, lagged, matrix_sql
from thalweg.catalog.registry import query
from thalweg.catalog.tables import AS_OF, BEGIN, END, oracle
from thalweg.operators import features, models, series, trees
from thalweg.plans import inference, operations, training
from thalweg.session import fresh_path, materialise
from thalweg.sources import sinks
from thalweg.streaming import readings as streams

PLACES = "(SELECT DISTINCT location FROM levels)"


@query(
    "inference_levels",
    oracle(
        "levels",
        f"""SELECT location, date, coalesce(
    last_value(level__m IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(level__m IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level__m
FROM (SELECT l.location, CAST(d AS DATE) AS date, v.level__m FROM {PLACES} l
  CROSS JOIN unnest(generate_series(DATE '2001-06-01', DATE '2001-06-30', INTERVAL 1 DAY)) AS t(d)
  LEFT JOIN levels v ON v.location = l.location AND v.date = CAST(d AS DATE))
UNION ALL SELECT location, {AS_OF}, 0.0 FROM {PLACES}""",
    ),
)
def inference_levels(spark, sf):
    mapping = fx.station_mapping(spark, sf)
    return inference.inference_levels(fx.levels(spark, sf), mapping.select("location"), fx.AS_OF)


@query(
    "inference_weather",
    oracle(
        "rain rain_forecast",
        """SELECT location, date, coalesce(last_value(precipitation_sum IGNORE NULLS) OVER w, 0.0) AS precipitation_sum,
  coalesce(last_value(precipitation_hours IGNORE NULLS) OVER w, 0.0) AS precipitation_hours
FROM (SELECT l.location, CAST(d AS DATE) AS date, v.precipitation_sum, v.precipitation_hours FROM (SELECT DISTINCT location FROM merged) l
  CROSS JOIN unnest(generate_series(DATE '2001-06-01', DATE '2001-07-07', INTERVAL 1 DAY)) AS t(d)
  LEFT JOIN merged v ON v.location = l.location AND v.date = CAST(d AS DATE))
WINDOW w AS (PARTITION BY location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        merged="""SELECT * FROM rain WHERE date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
UNION ALL SELECT * FROM rain_forecast WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-07'""",
    ),
)
def inference_weather(spark, sf):
    places = features.edges(fx.station_mapping(spark, sf), "weather_locations")
    return inference.inference_weather(fx.rain(spark, sf), fx.rain_forecast(spark, sf), places, fx.AS_OF)


LOOKED = "FROM levels WHERE date BETWEEN DATE '1996-07-02' AND DATE '2001-07-01'"


@query(
    "modelling_inputs",
    oracle(
        "levels rain",
        f"""SELECT 'levels' AS input, location, count(*) AS "rows", min(date) AS first_date, max(date) AS last_date {LOOKED} GROUP BY ALL
UNION ALL SELECT 'weather', location, count(*), min(date), max(date) {LOOKED.replace('levels', 'rain')} GROUP BY ALL""",
    ),
)
def modelling_inputs(spark, sf):
    levels, weather = training.modelling_inputs(fx.levels(spark, sf), fx.rain(spark, sf), fx.station_mapping(spark, sf), fx.AS_OF)
    size = lambda df, name: df.groupBy("location").agg(
        F.lit(name).alias("input"), F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    return size(levels, "levels").unionByName(size(weather, "weather"))


@query(
    "analyze_features",
    oracle(
        "levels rain_filled edges_up edges_wx",
        """SELECT CAST(d AS DATE) AS date FROM unnest(generate_series((SELECT min(date) FROM kept), (SELECT max(date) FROM kept), INTERVAL 1 DAY)) AS t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT date FROM kept)""",
        **lagged(rain="rain_filled"),
        **matrix_sql(1),
    ),
)
def analyze_features(spark, sf):
    mapping = fx.station_mapping(spark, sf)
    m = features.feature_matrix(mapping, fx.levels(spark, sf), fx.rain_filled(spark, sf), UP, WX, 1)
    return training.analyze_features(m, features.feature_index(mapping, UP, WX))["missing_dates"]


XLAGS, XWX = list(features.STATION_LAGS), list(features.WEATHER_LAGS)
STAND_IN = models.linear_predictor(features.level_names(XLAGS), ev.WEIGHTS, ev.INTERCEPT)


def days_grid(spark, sf, days=31):
    """Every station on the days of June 2001, horizons 1 and 7, one model."""
    stations = fx.station_mapping(spark, sf).select("station")
    grid = inference.inference_grid(stations, [1, 7], ["XGBoost_001"])
    first = F.lit(dt.date(2001, 6, 1))
    return grid.withColumn("as_of", F.explode(F.sequence(first, F.date_add(first, days - 1))))


# Levels of the 30 days before a day, filled within them; the lags are the filled values 1 and 3 days back.
WINDOWED = """SELECT location, as_of, date, coalesce(
    last_value(level__m IGNORE NULLS) OVER (PARTITION BY location, as_of ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(level__m IGNORE NULLS) OVER (PARTITION BY location, as_of ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level__m
FROM (SELECT r.r_name AS location, CAST(a AS DATE) AS as_of, CAST(a AS DATE) - CAST(b AS INTEGER) AS date, v.level__m FROM region r
  CROSS JOIN unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS t(a) CROSS JOIN unnest(generate_series(1, 30)) AS u(b)
  LEFT JOIN levels v ON v.location = r.r_name AND v.date = CAST(a AS DATE) - CAST(b AS INTEGER))"""
LAGGED = """SELECT w1.location, w1.as_of, w1.level__m AS lag01, w3.level__m AS lag03 FROM win w1
JOIN win w3 ON w1.location = w3.location AND w1.as_of = w3.as_of AND w3.date = w1.as_of - 3 WHERE w1.date = w1.as_of - 1"""
# A station can be predicted where each upstream station has a level in its window, and each weather
# location a row both in the history up to yesterday and, if the window reaches today, in the forecast.
USABLE = """SELECT e.station, a.as_of FROM edges_up e CROSS JOIN (SELECT DISTINCT as_of FROM lagged) a
  LEFT JOIN lagged l ON l.location = e.location AND l.as_of = a.as_of GROUP BY ALL HAVING count(*) = count(l.lag01)
INTERSECT
SELECT station, as_of FROM (
  SELECT e.station, a.as_of, a.as_of + 6 >= {today} AS ahead,
    EXISTS (SELECT 1 FROM rain h WHERE h.location = e.location AND h.date >= a.as_of - 30
      AND h.date <= CASE WHEN a.as_of + 6 >= {today} THEN {today} - 1 ELSE a.as_of + 6 END) AS past,
    EXISTS (SELECT 1 FROM rain_forecast f WHERE f.location = e.location AND f.date BETWEEN a.as_of AND a.as_of + 6) AS coming
  FROM edges_wx e CROSS JOIN (SELECT DISTINCT as_of FROM lagged) a) GROUP BY ALL HAVING bool_and(past AND (coming OR NOT ahead))"""


def windowed(first: str, last: str, today: str = "a.as_of") -> dict[str, str]:
    return {"win": WINDOWED.format(first=first, last=last), "lagged": LAGGED, "usable": USABLE.format(today=today)}


INFERRED = """SELECT l.location AS location_name, l.as_of AS date, concat('Preprocessor_001-f', f, '-XGBoost_001-', l.location) AS ml_model_name, f AS forecast_days,
  lag01 + (0.5::DOUBLE + -0.5::DOUBLE * lag01 + 0.25::DOUBLE * lag03) AS level_m
FROM lagged l JOIN usable u ON u.station = l.location AND u.as_of = l.as_of CROSS JOIN (SELECT unnest([1, 7]) AS f)"""


@query("infer_batch", oracle("levels edges_up edges_wx rain rain_forecast", INFERRED, **windowed("DATE '2001-06-01'", "DATE '2001-07-01'")))
def infer_batch(spark, sf):
    return inference.infer_batch(
        fx.station_mapping(spark, sf), days_grid(spark, sf), fx.levels(spark, sf), fx.rain(spark, sf), fx.rain_forecast(spark, sf),
        {"XGBoost_001": STAND_IN}, XLAGS, XWX, between=("2001-06-01", "2001-07-01"),
    )


# The weather around a day, history before it and forecast from it on, filled within the window.
AROUND = """SELECT location, as_of, date, coalesce(last_value(s IGNORE NULLS) OVER w, 0.0) AS precipitation_sum, coalesce(last_value(h IGNORE NULLS) OVER w, 0.0) AS precipitation_hours
FROM (SELECT l.location, a.as_of, a.as_of + CAST(k AS INTEGER) AS date, CASE WHEN k < 0 THEN p.precipitation_sum ELSE f.precipitation_sum END AS s,
    CASE WHEN k < 0 THEN p.precipitation_hours ELSE f.precipitation_hours END AS h
  FROM (SELECT DISTINCT location FROM edges_wx) l CROSS JOIN (SELECT DISTINCT as_of FROM lagged) a CROSS JOIN unnest(generate_series(-30, 6)) AS t(k)
  LEFT JOIN rain p ON p.location = l.location AND p.date = a.as_of + CAST(k AS INTEGER)
  LEFT JOIN rain_forecast f ON f.location = l.location AND f.date = a.as_of + CAST(k AS INTEGER))
WINDOW w AS (PARTITION BY location, as_of ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
LEVEL_SHIFTS = ", ".join(f"({n}, '{series.shift_name(n, 'level__m')}')" for n in XLAGS)
RAIN_SHIFTS = ", ".join(f"({n}, '{series.shift_name(n, 'precipitation')}')" for n in XWX)
INFERRED_LONG = f"""SELECT u.station AS location, u.as_of AS date, feature, value FROM usable u JOIN (
  SELECT location AS station, as_of, name AS feature, level__m AS value FROM win JOIN (VALUES {LEVEL_SHIFTS}) v(n, name) ON win.date = as_of - n
  UNION ALL SELECT station, as_of, {PREFIX}' || name, level__m FROM win JOIN (VALUES {LEVEL_SHIFTS}) v(n, name) ON win.date = as_of - n JOIN edges_up USING (location)
  UNION ALL SELECT station, as_of, {PREFIX}' || name || '_' || part, CASE part WHEN 'sum' THEN precipitation_sum ELSE precipitation_hours END
    FROM around JOIN (VALUES {RAIN_SHIFTS}) v(n, name) ON around.date = as_of - n JOIN edges_wx USING (location) CROSS JOIN (SELECT unnest(['sum', 'hours']) AS part)
) f ON f.station = u.station AND f.as_of = u.as_of"""


@query(
    "inference_features",
    oracle("levels edges_up edges_wx rain rain_forecast", INFERRED_LONG, **windowed("DATE '2001-06-01'", "DATE '2001-07-01'"), around=AROUND),
)
def inference_features(spark, sf):
    """Every feature of every inference of a month, weather included, at the lags models are trained on."""
    mapping, wanted = fx.station_mapping(spark, sf), days_grid(spark, sf).select("station", "as_of").distinct()
    rows = inference.inference_features(
        mapping, wanted, fx.levels(spark, sf), fx.rain(spark, sf), fx.rain_forecast(spark, sf), XLAGS, XWX, between=("2001-06-01", "2001-07-01")
    )
    return features.lengthen(rows, features.feature_index(mapping, XLAGS, XWX))


GAPS_2001 = """SELECT r.r_name AS location, CAST(d AS DATE) AS date FROM region r CROSS JOIN unnest(generate_series(DATE '2001-05-01', DATE '2001-06-30', INTERVAL 1 DAY)) AS t(d)
WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p.location_name = r.r_name AND p.date = CAST(d AS DATE) AND p.level_m IS NOT NULL)"""


@query(
    "catchup_predictions",
    oracle(
        "preds",
        """SELECT g.location, g.gap_start, g.gap_end, g.days, l.last_date FROM (
  SELECT location, min(date) AS gap_start, max(date) AS gap_end, count(*) AS days
  FROM (SELECT *, date - CAST(row_number() OVER (PARTITION BY location ORDER BY date) AS INTEGER) AS run FROM gaps) GROUP BY location, run) g
LEFT JOIN (SELECT location_name, max(date) AS last_date FROM preds WHERE level_m IS NOT NULL GROUP BY ALL) l ON l.location_name = g.location""",
        gaps=GAPS_2001,
    ),
)
def catchup_predictions(spark, sf):
    return inference.catchup_report(fx.predictions(spark, sf), fx.station_mapping(spark, sf).select("station"), "2001-05-01", "2001-06-30")


@query(
    "catchup_run",
    oracle(
        "levels preds edges_up edges_wx rain rain_forecast stations",
        """SELECT i.location_name, i.date, i.ml_model_name, i.level_m, CASE WHEN level_m < moderate THEN 'low' WHEN level_m < high THEN 'moderate'
  WHEN level_m < full_level THEN 'high' ELSE 'full' END AS risk_level
FROM inferred i JOIN gaps g ON g.location = i.location_name AND g.date = i.date JOIN stations s ON s.station_name = i.location_name WHERE forecast_days = 7""",
        gaps=GAPS_2001,
        **windowed("DATE '2001-05-01'", "DATE '2001-06-30'", AS_OF),
        inferred=INFERRED,
    ),
)
def catchup_run(spark, sf):
    """The work list of the catch-up, predicted and assessed in one job."""
    made = operations.catchup_predictions(
        fx.predictions(spark, sf), fx.station_mapping(spark, sf), fx.stations(spark, sf), fx.levels(spark, sf), fx.rain(spark, sf),
        fx.rain_forecast(spark, sf), {"XGBoost_001": STAND_IN}, "2001-05-01", "2001-06-30", 7, XLAGS, XWX, today="2001-07-01",
    )
    return made.drop("forecast_days")


BACKFILL = """SELECT g.location, count(*) AS missing_days, count(s.reading) AS filled_days, count(*) - count(s.reading) AS still_missing
FROM (SELECT l.location, d.date FROM (SELECT DISTINCT location_name AS location FROM river_gappy) l CROSS JOIN days d
  WHERE NOT EXISTS (SELECT 1 FROM river_gappy v WHERE v.location_name = l.location AND v.date = d.date)) g
JOIN region ON r_name = g.location LEFT JOIN secondary s ON s.station_id = r_regionkey AND s.reading_date = g.date GROUP BY ALL"""


def station_ids(spark, sf):
    return fx.stations(spark, sf).select(F.col("station_name").alias("location"), F.substring("station_number", 3, 9).cast("int").alias("station_id"))


@query("backfill_levels", oracle("river_gappy secondary days", BACKFILL))
def backfill_levels(spark, sf):
    _, report = operations.backfill_levels(fx.river_gappy(spark, sf), station_ids(spark, sf), fx.secondary(spark, sf), fx.BEGIN, fx.END)
    return report


@query(
    "backfill_inserted",
    oracle(
        "river_gappy secondary",
        f"""SELECT location_name, date, level_m FROM river_gappy UNION ALL SELECT r_name, reading_date, reading FROM secondary JOIN region ON r_regionkey = station_id
WHERE reading IS NOT NULL AND reading_date BETWEEN {BEGIN} AND {END} AND NOT EXISTS (SELECT 1 FROM river_gappy g WHERE g.location_name = r_name AND g.date = reading_date)""",
    ),
)
def backfill_inserted(spark, sf):
    """The level table after the backfill."""
    table, _ = operations.backfill_table(fx.river_gappy(spark, sf), station_ids(spark, sf), fx.secondary(spark, sf), fx.BEGIN, fx.END)
    return table


@query(
    "availability_report",
    oracle(
        "fleet",
        """SELECT a.*, CAST(date_range + 1 AS BIGINT) AS expected_days, date_range + 1 - distinct_days AS gap_days, date_range < 30 AS limited,
  DATE '2001-10-30' - last_date > 7 AS stale, (SELECT max(first_date) FROM a) AS safe_start, (SELECT min(last_date) FROM a) AS safe_end FROM a""",
        a="""SELECT location AS location_name, min(date) AS first_date, max(date) AS last_date, count(*) AS records, count(DISTINCT date) AS distinct_days,
  CAST(max(date) - min(date) AS INTEGER) AS date_range FROM fleet GROUP BY ALL""",
    ),
)
def availability_report(spark, sf):
    return operations.availability_report(fx.fleet(spark, sf), "2001-10-30")


@query(
    "forecast_diagnostics",
    oracle(
        "edges_wx rain_forecast",
        f"""SELECT w.location, count(r.date) AS n, min(r.date) AS first_date, max(r.date) AS last_date, count(r.date) FILTER (WHERE r.date >= {AS_OF} - 7) AS recent,
  count(r.date) FILTER (WHERE r.date > {AS_OF}) AS future, CASE WHEN count(r.date) > 0 THEN 'OK' ELSE 'MISSING' END AS status
FROM (SELECT DISTINCT location FROM edges_wx) w LEFT JOIN rain_forecast r ON r.location = w.location GROUP BY ALL""",
    ),
)
def forecast_diagnostics(spark, sf):
    return operations.forecast_diagnostics(fx.station_mapping(spark, sf), fx.rain_forecast(spark, sf), fx.AS_OF)


@query("input_sizes", oracle("levels rain", """SELECT 'levels' AS input, count(*) AS "rows", 30 AS needed, count(*) >= 30 AS enough FROM levels UNION ALL SELECT 'weather', count(*), 30, count(*) >= 30 FROM rain"""))
def input_sizes(spark, sf):
    return training.input_sizes(fx.levels(spark, sf), fx.rain(spark, sf), training.ForecastConfig())


@query(
    "station_input_sizes",
    oracle(
        "levels rain edges_up edges_wx",
        """SELECT station, 'levels' AS input, count(date) AS "rows", 30 AS needed, count(date) >= 30 AS enough FROM edges_up LEFT JOIN levels USING (location) GROUP BY ALL
UNION ALL SELECT station, 'weather', count(date), 30, count(date) >= 30 FROM edges_wx LEFT JOIN rain USING (location) GROUP BY ALL""",
    ),
)
def station_input_sizes(spark, sf):
    return training.station_sizes(fx.station_mapping(spark, sf), fx.levels(spark, sf), fx.rain(spark, sf), training.ForecastConfig())


# --- models
# A prediction has no SQL counterpart.  Checked are the rows a model is fitted on and the rows it scores,
# scores that do not depend on the model, and what must hold of any fit.


SPLIT = "DATE '2000-01-01'"


def kept_sql(horizons, station_lags=XLAGS, weather_lags=XWX):
    """The rows of the training matrix, and those scored after the split, as DuckDB tables."""
    top, first, ahead = max(station_lags), max(weather_lags), -min(min(weather_lags), 0)
    aimed = """SELECT station AS location, date, {h} AS forecast_days, lag1, target - lag1 AS y
FROM (SELECT *, lead(level__m, {h} - 1) OVER (PARTITION BY station ORDER BY date) AS target FROM joined) WHERE whole AND target IS NOT NULL"""
    return {
        "lv": "SELECT *, lag(level__m, 1) OVER w AS lag1, row_number() OVER w AS rn FROM levels_filled WINDOW w AS (PARTITION BY location ORDER BY date)",
        "wv": "SELECT location, date, row_number() OVER (PARTITION BY location ORDER BY date) AS rn, count(*) OVER (PARTITION BY location) AS n FROM rain_filled",
        "us": f"SELECT station, date FROM lv JOIN edges_up USING (location) GROUP BY ALL HAVING bool_and(rn > {top}) AND count(*) = 2",
        "ws": f"""SELECT station, date, bool_and(rn > {first} AND rn + {ahead} <= n) AS whole FROM wv JOIN edges_wx USING (location)
JOIN (SELECT station, count(*) AS parts FROM edges_wx GROUP BY ALL) USING (station) GROUP BY station, date, parts HAVING bool_and(pos = 0 OR rn > {first}) AND count(*) = parts""",
        "joined": "SELECT station, date, level__m, lag1, whole FROM us JOIN ws USING (station, date) JOIN lv ON lv.location = station AND lv.date = us.date",
        "kept": " UNION ALL ".join(aimed.format(h=h) for h in horizons),
        "train": f"SELECT * FROM kept WHERE date < {SPLIT}",
        "test": f"SELECT * FROM kept WHERE date >= {SPLIT}",
        "scored": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location, forecast_days ORDER BY date) AS late FROM test) WHERE late > {max(top, first)}""",
        "bases": """SELECT location, forecast_days, count(*) AS n, round(sqrt(avg(d * d)), 6) AS baseline_rmse
FROM (SELECT *, lag(y, 1) OVER (PARTITION BY location, forecast_days ORDER BY date) - y AS d FROM scored) GROUP BY ALL""",
    }


def model_oracle(body, horizons=(1,)):
    return oracle("levels_filled rain_filled edges_up edges_wx", body, **kept_sql(horizons))


def training_inputs(spark, sf):
    """Mapping and series are stored: guards, matrices and models read a row per location and day, the raw tables are read once."""
    made = {"mapping": fx.station_mapping, "levels": fx.levels_filled, "rain": fx.rain_filled}
    return *(materialise(make(spark, sf), name) for name, make in made.items()), fx.stations(spark, sf)


def config(kind, horizons=(1,), **options):
    return training.ForecastConfig(tuple(XLAGS), tuple(XWX), horizons, "2000-01-01", kind, options)


def split_matrix(spark, sf, config):
    """(rows before the split, rows after it) for all stations; they don't depend on the kind of model."""
    mapping, levels, weather, _ = training_inputs(spark, sf)
    m = training.stored_matrix(mapping, levels, weather, config)
    return m.filter("date < '2000-01-01'"), m.filter("date >= '2000-01-01'")


def fit_all(spark, sf, config):
    """(models, rows they were fitted on, rows after the split) for all stations."""
    train, test = split_matrix(spark, sf, config)
    return training.fit_models(train, config), train, test


TREES = """SELECT location, count(*) AS "rows", CAST({n} AS BIGINT) AS trees, true AS within_depth, true AS binary FROM train GROUP BY ALL"""
SCORED = "SELECT location, date, lag1 AS lag01__level__m, true AS agrees{more} FROM test"


def tree_sizes(fitted, depth):
    """Rows fitted on and trees grown per station; a binary tree has an odd number of nodes."""
    return fitted.groupBy("location").agg(
        F.max("rows").alias("rows"), F.count("*").alias("trees"), F.bool_and(F.col("depth") <= depth).alias("within_depth"), F.bool_and(F.size("value") % 2 == 1).alias("binary")
    )


def beside_single_trees(fitted, test, predict, total, *more):
    """Scored rows, each compared with what its single trees say one by one."""
    single = trees.tree_values(fitted, test, features.feature_vector()).groupBy("location", "date").agg(total("value").alias("pred"))
    agrees = (F.abs(F.col("y") - F.col("pred")) < 1e-9).alias("agrees")
    return predict(fitted, test).join(single, ["location", "date"]).select("location", "date", features.LAG1, agrees, *more)


@query("rf_train", model_oracle(TREES.format(n=100)))
def rf_train(spark, sf):
    """The whole forest of every station."""
    return tree_sizes(fit_all(spark, sf, config("RandomForestRegressor_001"))[0], 30)


@query("rf_infer", model_oracle(SCORED.format(more=", true AS spread")))
def rf_infer(spark, sf):
    """The mean of the single trees is the forest's prediction, their spread no less than 0, for all days after the split."""
    fitted, _, test = fit_all(spark, sf, config("RandomForestRegressor_001"))
    return beside_single_trees(fitted, test, models.forest_predict, F.avg, (F.col("y_var") >= 0).alias("spread"))


@query("gbt_train", model_oracle(TREES.format(n=1000)))
def gbt_train(spark, sf):
    """All 1,000 rounds on all stations."""
    return tree_sizes(fit_all(spark, sf, config("XGBoost_001"))[0], 7)


@query("gbt_infer", model_oracle(SCORED.format(more="")))
def gbt_infer(spark, sf):
    fitted, _, test = fit_all(spark, sf, config("XGBoost_001"))
    return beside_single_trees(fitted, test, models.boosted_predict, F.sum)


def additive_matrix(spark, sf, horizons):
    return split_matrix(spark, sf, config("Prophet_001", horizons))


@query(
    "seasonal_regression",
    model_oracle(
        """SELECT location, forecast_days, count(*) FILTER (WHERE date < DATE '2000-01-01') AS train_rows, count(*) FILTER (WHERE date >= DATE '2000-01-01') AS test_rows,
  count(*) AS predicted, true AS unbiased, true AS no_worse_than_mean FROM kept GROUP BY ALL""",
        (1, 7),
    ),
)
def seasonal_regression(spark, sf):
    """Every station and horizon fitted in one job; a fit with an intercept leaves no mean error and no more than the mean does."""
    train, test = additive_matrix(spark, sf, (1, 7))
    truth = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).withColumn("truth", F.col("y"))
    scored = models.additive_predict(models.fit_additive(train), truth)
    old, e = F.col("part") == "train", F.col("truth") - F.col("y")
    return scored.groupBy("location", "forecast_days").agg(
        F.count_if(old).alias("train_rows"),
        F.count_if(~old).alias("test_rows"),
        F.count("y").alias("predicted"),
        (F.abs(F.avg(F.when(old, e))) < 1e-6).alias("unbiased"),
        (F.avg(F.when(old, e * e)) <= F.var_pop(F.when(old, F.col("truth"))) + 1e-9).alias("no_worse_than_mean"),
    )


KINDS = ", ".join(f"'{kind}'" for kind in models.REGISTRY)


@query("model_registry", model_oracle(f"SELECT kind, location, n, baseline_rmse, true AS scored FROM bases, (SELECT unnest([{KINDS}]) AS kind)"))
def model_registry(spark, sf):
    """Every registered kind fitted on all stations, in its full size, and scored through the registry."""
    out, inputs = None, training_inputs(spark, sf)
    for kind in models.REGISTRY:
        run = training.build_models(*inputs, config(kind))
        part = run.scores.select(F.lit(kind).alias("kind"), "location", "n", F.round("baseline_rmse", 6).alias("baseline_rmse"), (F.col("rmse") > 0).alias("scored"))
        out = part if out is None else out.unionByName(part)
    return out


@query("persist_load_model", model_oracle(f"SELECT kind, location, count(*) AS n, 0 AS differing FROM test, (SELECT unnest([{KINDS}]) AS kind) GROUP BY ALL"))
def persist_load_model(spark, sf):
    """A stored model of any kind predicts what the fitted one does: (predictions, differing predictions)."""
    out, root = None, fresh_path(spark, "models")
    train, test = split_matrix(spark, sf, config(next(iter(models.REGISTRY))))
    for kind in models.REGISTRY:
        fitted = training.fit_models(train, config(kind))
        one = training.TrainedModels(kind, fitted, test)
        one.save(root)
        two = training.TrainedModels(kind, training.load_models(spark, root, kind), test)
        score = lambda run, name: run.predictor(test).select("location", "date", F.round("y", 9).alias(name))
        both = score(one, "a").join(score(two, "b"), ["location", "date"])
        part = both.groupBy(F.lit(kind).alias("kind"), "location").agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("differing"))
        out = part if out is None else out.unionByName(part)
    return out


@query("build_model", model_oracle("SELECT location, forecast_days, n, baseline_rmse, true AS scored, n AS staged, 1 AS configs FROM bases", (1, 7)))
def build_model(spark, sf):
    """A whole run: its scores, the eval stage as it was scored, and the configuration beside it."""
    root = fresh_path(spark, "run")
    run = training.build_models(*training_inputs(spark, sf), config("Prophet_001", (1, 7)), root)
    held = sinks.read_artifact(spark, root, "eval").groupBy(F.col("station").alias("location"), "forecast_days").agg(F.count("*").alias("staged"))
    ok = (F.col("rmse") > 0) & (F.col("weighted_rmse") > 0)
    scores = run.scores.select("location", "forecast_days", "n", F.round("baseline_rmse", 6).alias("baseline_rmse"), ok.alias("scored"))
    configs = spark.read.text(f"{root}/config").agg(F.count("*")).scalar()
    return scores.join(held, ["location", "forecast_days"]).withColumn("configs", configs)


@query(
    "infer_batch_models",
    oracle(
        "levels edges_up edges_wx rain rain_forecast",
        f"SELECT location_name, date, ml_model_name, forecast_days, true AS finite FROM ({INFERRED.replace('XGBoost_001', 'Prophet_001')})",
        **windowed("DATE '2001-06-01'", "DATE '2001-07-01'"),
    ),
)
def infer_batch_models(spark, sf):
    """Models fitted on history, then a month of predictions for all stations and two horizons."""
    mapping, levels, weather, dim = training_inputs(spark, sf)
    run = training.build_models(mapping, levels, weather, dim, config("Prophet_001", (1, 7)))
    grid = days_grid(spark, sf).withColumn("model_type", F.lit("Prophet_001"))
    made = inference.infer_batch(
        mapping, grid, fx.levels(spark, sf), fx.rain(spark, sf), fx.rain_forecast(spark, sf), {"Prophet_001": run.predictor}, XLAGS, XWX
    )
    return made.withColumn("finite", F.abs("level_m") < 100.0).drop("level_m")


# What landed on the day of the run; the tables hold the rest, and an older forecast.
LANDED = {
    "levels": "SELECT * FROM levels WHERE date BETWEEN DATE '2001-06-20' AND DATE '2001-06-30'",
    "history": "SELECT * FROM rain WHERE date BETWEEN DATE '2001-06-20' AND DATE '2001-06-30'",
    "forecast": "SELECT * FROM rain_forecast",
}


def run_day(spark, sf):
    """The daily job over tables that lack the last days; half of the landed levels are there already."""
    inputs = {"levels": fx.levels(spark, sf), "history": fx.rain(spark, sf, end="2001-06-30"), "forecast": fx.rain_forecast(spark, sf)}
    recent = F.col("date").between("2001-06-20", "2001-06-30")
    tables = operations.daily_tables(spark, fresh_path(spark, "daily"))
    same = lambda old, new: new
    tables.levels.merge(inputs["levels"].filter(~recent | (F.dayofmonth("date") % 2 == 0)).filter("date < '2001-07-01'"), same)
    tables.history.merge(inputs["history"].filter(~recent), same)
    tables.forecast.merge(inputs["forecast"].withColumn("precipitation_sum", F.col("precipitation_sum") + 9), same)
    landed = {name: rows if name == "forecast" else rows.filter(recent) for name, rows in inputs.items()}
    return operations.daily_pipeline(
        tables, landed, fx.station_mapping(spark, sf), fx.stations(spark, sf), {"XGBoost_001": STAND_IN}, [1, 7], fx.AS_OF, XLAGS, XWX, alert="low"
    )


BAND = "CASE WHEN level_m < moderate THEN 'low' WHEN level_m < high THEN 'moderate' WHEN level_m < full_level THEN 'high' ELSE 'full' END"
LACKING = f"""SELECT station, e.location, CAST(d AS DATE) AS date FROM edges_up e CROSS JOIN unnest(generate_series({AS_OF} - 30, {AS_OF} - 1, INTERVAL 1 DAY)) AS t(d)
    WHERE NOT EXISTS (SELECT 1 FROM levels v WHERE v.location = e.location AND v.date = CAST(d AS DATE))
  UNION ALL SELECT station, e.location, CAST(d AS DATE) FROM edges_wx e CROSS JOIN unnest(generate_series({AS_OF} - 30, {AS_OF} - 1, INTERVAL 1 DAY)) AS t(d)
    WHERE NOT EXISTS (SELECT 1 FROM rain v WHERE v.location = e.location AND v.date = CAST(d AS DATE))
  UNION ALL SELECT station, e.location, CAST(d AS DATE) FROM edges_wx e CROSS JOIN unnest(generate_series({AS_OF}, {AS_OF} + 6, INTERVAL 1 DAY)) AS t(d)
    WHERE NOT EXISTS (SELECT 1 FROM rain_forecast v WHERE v.location = e.location AND v.date = CAST(d AS DATE))"""


@query(
    "daily_pipeline",
    oracle(
        "levels edges_up edges_wx rain rain_forecast stations",
        f"""SELECT 'predict' AS phase, location_name AS item, 'ok' AS outcome, count(*) AS n FROM inferred GROUP BY ALL
UNION ALL SELECT 'risk', {BAND}, 'assessed', count(*) FROM inferred JOIN stations ON station_name = location_name GROUP BY ALL
UNION ALL SELECT 'predict', r_name, 'failed', 2 FROM region WHERE r_name NOT IN (SELECT location_name FROM inferred)
UNION ALL SELECT 'inputs', station, 'days missing', count(*) FROM ({LACKING}) GROUP BY ALL
UNION ALL SELECT 'inputs', location, 'no rows', count(DISTINCT station) FROM (
  SELECT station, location FROM ({LACKING}) WHERE date < {AS_OF} AND location IN (SELECT location FROM edges_up) GROUP BY ALL HAVING count(*) = 30
  UNION ALL SELECT station, location FROM ({LACKING}) WHERE date < {AS_OF} AND location IN (SELECT location FROM edges_wx) GROUP BY ALL HAVING count(*) = 30
  UNION ALL SELECT station, location FROM ({LACKING}) WHERE date >= {AS_OF} GROUP BY ALL HAVING count(*) = 7) GROUP BY ALL
"""
        + "".join(f"UNION ALL SELECT 'ingest', '{name}', 'ok', count(*) FROM ({rows})\n" for name, rows in LANDED.items()),
        **windowed("DATE '2001-07-01'", "DATE '2001-07-01'"),
        inferred=INFERRED,
    ),
)
def daily_pipeline(spark, sf):
    return run_day(spark, sf)[0]


@query(
    "daily_alerts",
    oracle(
        "levels edges_up edges_wx rain rain_forecast stations",
        f"""SELECT location_name AS "Station", 'low' AS "Flood risk", level_m AS "Water level (m)", date AS "Prediction date", date + forecast_days - 1 AS "Target date"
FROM inferred JOIN stations ON station_name = location_name WHERE {BAND} = 'low'""",
        **windowed("DATE '2001-07-01'", "DATE '2001-07-01'"),
        inferred=INFERRED,
    ),
)
def daily_alerts(spark, sf):
    """The alerts of the daily job; at the mildest band, as made-up levels seldom reach the others."""
    return run_day(spark, sf)[1]


# --- streams


#: Slices end here; the first and the last are open.
CUTS = ("2024-01-11", "2024-01-21")


def slices(rows):
    """Readings in the order in which they land, 12 hours around a cut twice; a seventh of the first slice comes last of all."""
    ts, late = F.col("ts"), (F.col("ts") < F.lit(CUTS[0]).cast("timestamp")) & (F.col("event_id") % 7 == 0)
    at = [F.lit(c).cast("timestamp") for c in CUTS]
    until = [c + F.expr("INTERVAL 12 HOURS") for c in at]
    yield rows.filter(ts.isNull() | (ts < until[0])).filter(~F.coalesce(late, F.lit(False)))
    yield rows.filter((ts >= at[0]) & (ts < until[1]))
    yield rows.filter(ts >= at[1])
    yield rows.filter(late)


@query("stream_readings_ingest", oracle("readings", "SELECT location, event_id, value FROM readings"))
def stream_readings_ingest(spark, sf):
    rows, folder, path = fx.readings(spark, sf), fresh_path(spark, "landing"), fresh_path(spark, "ingested")
    for part in slices(rows):
        part.write.mode("append").parquet(folder)
        streams.ingest_readings(streams.read_landing(spark, folder, rows.schema), path, ("location", "ts", "event_id")).awaitTermination()
    return streams.read_ingested(spark, path, rows.schema).drop("ts")


@query(
    "stream_risk_alerts",
    oracle("banded", "SELECT location_name, date, level_m, band AS risk_level FROM banded WHERE band = 'full'"),
)
def stream_risk_alerts(spark, sf):
    river = fx.river(spark, sf)
    folder, path = fresh_path(spark, "predicted"), fresh_path(spark, "alerts")
    newer = F.coalesce(F.col("date") >= "2000-01-01", F.lit(False))
    for part in (river.filter(~newer), river.filter(newer)):
        part.write.mode("append").parquet(folder)
        streams.stream_alerts(streams.read_landing(spark, folder, river.schema), fx.stations(spark, sf), path).awaitTermination()
    return spark.read.schema("location_name string, date date, level_m double, risk_level string").parquet(path)


@query(
    "stream_daily_rollup",
    oracle("readings", "SELECT location, CAST(ts AS DATE) AS date, count(*) AS n, round(sum(value), 4) AS total, max(value) AS highest FROM readings GROUP BY ALL"),
)
def stream_daily_rollup(spark, sf):
    rows = fx.readings(spark, sf)
    folder, path = fresh_path(spark, "landing"), fresh_path(spark, "rollup")
    for part in slices(rows):
        part.write.mode("append").parquet(folder)
        streams.stream_daily_rollup(streams.read_landing(spark, folder, rows.schema), path, ("location", "ts", "event_id")).awaitTermination()
    return streams.read_rollup(spark, path).withColumn("total", F.round("total", 4))
