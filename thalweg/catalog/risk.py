"""Risk bands, summaries, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import AS_OF, oracle
from thalweg.operators import risk

BAND = "CASE WHEN level_m < moderate THEN 'low' WHEN level_m < high THEN 'moderate' WHEN level_m < full_level THEN 'high' ELSE 'full' END"


@query("station_risk_days", oracle("banded", "SELECT location_name, band AS risk_level, count(*) AS days FROM banded GROUP BY ALL"))
def station_risk_days(spark, sf):
    return risk.risk_counts(fx.river(spark, sf), fx.stations(spark, sf))


@query(
    "risk_classify",
    oracle(
        "preds stations",
        f"""SELECT p.id, p.location_name, p.date, p.level_m, coalesce(risk_level, {BAND}) AS risk_level
FROM preds p JOIN stations s ON p.location_name = s.station_name""",
    ),
)
def risk_classify(spark, sf):
    done = risk.classify(fx.predictions(spark, sf), fx.stations(spark, sf))
    return done.select("id", "location_name", "date", "level_m", "risk_level")


@query(
    "risk_bands_join",
    oracle(
        "river stations",
        f"SELECT location_name, {BAND} AS risk_level, count(*) AS days, max(level_m) AS highest FROM river JOIN stations ON location_name = station_name GROUP BY ALL",
    ),
)
def risk_bands_join(spark, sf):
    """The same bands by an equi join with a residual range on a table of bands."""
    bands = risk.band_table(fx.stations(spark, sf))
    river = fx.river(spark, sf)
    inside = (F.col("level_m") >= F.col("lo")) & (F.col("level_m") < F.col("hi"))
    joined = river.join(bands, (river["location_name"] == bands["station_name"]) & inside)
    return joined.groupBy("location_name", "risk_level").agg(F.count("*").alias("days"), F.max("level_m").alias("highest"))


@query(
    "null_risk_only",
    oracle(
        "preds stations",
        f"""SELECT {BAND} AS assigned, count(*) AS n FROM preds JOIN stations ON location_name = station_name
WHERE risk_level IS NULL GROUP BY ALL""",
    ),
)
def null_risk_only(spark, sf):
    rows = fx.predictions(spark, sf)
    done = risk.classify(rows.filter(F.col("risk_level").isNull()), fx.stations(spark, sf))
    return done.groupBy(F.col("risk_level").alias("assigned")).agg(F.count("*").alias("n"))


@query(
    "risk_summary",
    oracle(
        "preds",
        f"""SELECT location_name, station_number, count(*) AS total_predictions,
  count(*) FILTER (WHERE upper(risk_level) = 'FULL') AS full_risk_count,
  count(*) FILTER (WHERE upper(risk_level) = 'HIGH') AS high_risk_count,
  count(*) FILTER (WHERE upper(risk_level) = 'MODERATE') AS moderate_risk_count,
  count(*) FILTER (WHERE upper(risk_level) = 'LOW') AS low_risk_count,
  max(date) AS latest_prediction_date, round(avg(level_m), 6) AS avg_predicted_level
FROM preds WHERE date > {AS_OF} GROUP BY ALL""",
    ),
)
def risk_summary(spark, sf):
    out = risk.risk_summary(fx.predictions(spark, sf), fx.AS_OF)
    return out.withColumn("avg_predicted_level", F.round("avg_predicted_level", 6))


@query(
    "latest_predictions",
    oracle(
        "preds stations",
        f"""SELECT p.id, p.location_name, p.date, p.level_m, p.station_number, p.ml_model_name, p.forecast_days, p.risk_level,
  s.station_name, s.moderate, s.high, s.full_level
FROM preds p LEFT JOIN stations s ON p.station_number = s.station_number WHERE p.date > {AS_OF}""",
    ),
)
def latest_predictions(spark, sf):
    rows = fx.predictions(spark, sf).drop("created_at", "updated_at")
    return risk.latest_predictions(rows, fx.stations(spark, sf), fx.AS_OF)


@query("future_only", oracle("preds", f"SELECT id, location_name, date, level_m FROM preds WHERE date > {AS_OF}"))
def future_only(spark, sf):
    rows = fx.predictions(spark, sf).select("id", "location_name", "date", "level_m")
    return rows.filter(F.col("date") > F.lit(fx.AS_OF))


STATUS = """SELECT location_name AS "Station", risk_level AS "Flood risk", level_m AS "Water level (m)", date AS "Prediction date",
  CAST(date + (forecast_days - 1) AS DATE) AS "Target date" """


@query("flood_status_filter", oracle("preds", STATUS + f"FROM preds WHERE date >= {AS_OF} AND risk_level ILIKE 'full'"))
def flood_status_filter(spark, sf):
    return risk.flood_status(fx.predictions(spark, sf), fx.AS_OF)


@query(
    "assess_risk",
    oracle(
        "preds stations",
        f"""SELECT location_name, ml_model_name, coalesce(risk_level, {BAND}) AS risk_level, count(*) AS n, max(date) AS last_date
FROM preds JOIN stations ON location_name = station_name GROUP BY ALL""",
    ),
)
def assess_risk(spark, sf):
    done = risk.classify(fx.predictions(spark, sf), fx.stations(spark, sf))
    return done.groupBy("location_name", "ml_model_name", "risk_level").agg(F.count("*").alias("n"), F.max("date").alias("last_date"))


ASSESSED = f"""SELECT p.* EXCLUDE (risk_level), coalesce(p.risk_level, {BAND}) AS risk_level
FROM preds p JOIN stations s ON p.location_name = s.station_name"""


@query(
    "flood_alerts",
    oracle(
        "preds stations",
        STATUS.replace("level_m AS", "level_m AS")
        + """FROM assessed WHERE date = (SELECT max(date) FROM assessed) AND risk_level ILIKE 'moderate'
  AND (SELECT max(date) FROM assessed) >= DATE '2001-08-02' - 2""",
        assessed=ASSESSED,
    ),
)
def flood_alerts(spark, sf):
    done = risk.classify(fx.predictions(spark, sf), fx.stations(spark, sf))
    return risk.flood_alerts(done, "2001-08-02", risk="moderate")


@query(
    "forecast_freshness",
    oracle(
        "rain_forecast preds",
        f"""SELECT (SELECT max(date) FROM rain_forecast) AS last_forecast_date,
  (SELECT max(date) FROM rain_forecast) >= {AS_OF} + 5 AS forecast_fresh,
  (SELECT max(date) FROM preds) AS last_prediction_date, (SELECT max(date) FROM preds) >= {AS_OF} - 2 AS predictions_fresh""",
    ),
)
def forecast_freshness(spark, sf):
    return risk.forecast_freshness(fx.rain_forecast(spark, sf), fx.predictions(spark, sf), fx.AS_OF)


@query(
    "weekly_station_status",
    oracle(
        "river stations",
        """SELECT w.*, moderate, high, full_level, CASE WHEN reading < moderate THEN 'safe' WHEN reading < high THEN 'moderate'
  WHEN reading < full_level THEN 'high' ELSE 'full' END AS status
FROM (SELECT location_name, CAST(isoyear(date) AS INTEGER) AS week_year, CAST(weekofyear(date) AS INTEGER) AS week_number,
        max(level_m) AS reading, max(date) AS reading_date FROM river GROUP BY ALL) w
  LEFT JOIN stations ON location_name = station_name""",
    ),
)
def weekly_station_status(spark, sf):
    return risk.weekly_status(fx.river(spark, sf), fx.stations(spark, sf))
