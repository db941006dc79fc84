"""Flood-risk bands, risk summaries and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date, target_date

# The risk bands, mildest first.
RISK_LEVELS = ("low", "moderate", "high", "full")


def risk_band(level, moderate="moderate", high="high", full="full_level") -> Column:
    """The half-open band a level falls in; NULL for a NULL level or a band without bounds."""
    level, moderate, high, full = (F.col(c) if isinstance(c, str) else c for c in (level, moderate, high, full))
    return (
        F.when(level < moderate, "low")
        .when((level >= moderate) & (level < high), "moderate")
        .when((level >= high) & (level < full), "high")
        .when(level >= full, "full")
    )


def band_table(stations: DataFrame) -> DataFrame:
    """Thresholds as rows (station_name, risk_level, lo, hi), open ends infinite."""
    inf = F.lit(float("inf"))
    edges = [-inf, F.col("moderate"), F.col("high"), F.col("full_level"), inf]
    bands = [F.struct(F.lit(n).alias("risk_level"), edges[i].alias("lo"), edges[i + 1].alias("hi")) for i, n in enumerate(RISK_LEVELS)]
    return stations.select("station_name", F.inline(F.array(*bands)))


def classify(predictions: DataFrame, stations: DataFrame, reassess: bool = False) -> DataFrame:
    """Set ``risk_level`` where it is NULL (everywhere with ``reassess``).

    One equi join with the thresholds and one expression.  The join carries no hint: Catalyst
    broadcasts the stations while they are below its size limit, and beyond it merges, where
    adaptive execution splits a hot station's partition.  Rows of unknown stations stay as they are.
    """
    bounds = stations.select("station_name", "moderate", "high", "full_level")
    joined = predictions.join(bounds, predictions["location_name"] == bounds["station_name"], "left")
    band = risk_band("level_m")
    new = F.coalesce(band, F.col("risk_level")) if reassess else F.coalesce(F.col("risk_level"), band)
    return joined.select(*[new.alias(c) if c == "risk_level" else F.col(c) for c in predictions.columns])


def risk_counts(levels: DataFrame, stations: DataFrame) -> DataFrame:
    """Days every station spent in every band."""
    bounds = stations.select("station_name", "moderate", "high", "full_level")
    banded = levels.join(bounds, levels["location_name"] == bounds["station_name"]).withColumn("risk_level", risk_band("level_m"))
    return banded.groupBy("location_name", "risk_level").agg(F.count("*").alias("days"))


def risk_summary(predictions: DataFrame, as_of, literal: bool = False) -> DataFrame:
    """Future predictions per location: counts by band, latest day, mean level.

    Bands are compared without regard to case and ``full`` is counted too; ``literal=True``
    compares with the upper-case names only.
    """
    risk = F.col("risk_level") if literal else F.upper("risk_level")
    count = lambda name: F.count(F.when(risk == name, 1))
    future = predictions.filter(F.col("date") > as_date(as_of))
    return future.groupBy("location_name", "station_number").agg(
        F.count("*").alias("total_predictions"),
        count("FULL").alias("full_risk_count"),
        count("HIGH").alias("high_risk_count"),
        count("MODERATE").alias("moderate_risk_count"),
        count("LOW").alias("low_risk_count"),
        F.max("date").alias("latest_prediction_date"),
        F.avg("level_m").alias("avg_predicted_level"),
    )


def latest_predictions(predictions: DataFrame, stations: DataFrame, as_of) -> DataFrame:
    """Future predictions with what is known of their station."""
    extra = [c for c in stations.columns if c not in predictions.columns and c != "station_number"]
    dim = stations.select("station_number", *extra)
    return predictions.filter(F.col("date") > as_date(as_of)).join(dim, "station_number", "left")


def flood_status(predictions: DataFrame, begin, risk: str = "full") -> DataFrame:
    """Predictions from ``begin`` on at one risk level, under display names.

    The stored day is the reference day; the day the forecast is about is given beside it.
    """
    rows = predictions.filter((F.col("date") >= as_date(begin)) & F.col("risk_level").ilike(risk))
    return rows.select(
        F.col("location_name").alias("Station"),
        F.col("risk_level").alias("Flood risk"),
        F.col("level_m").alias("Water level (m)"),
        F.col("date").alias("Prediction date"),
        target_date("date", F.col("forecast_days")).alias("Target date"),
    )


def max_date(df: DataFrame, date: str = "date") -> Column:
    """The latest day of a table, as a scalar subquery: one row by construction."""
    return df.agg(F.max(date)).scalar()


def flood_alerts(predictions: DataFrame, as_of, max_age_days: int = 2, risk: str = "full") -> DataFrame:
    """Alerts of the latest prediction day; none where that day is more than ``max_age_days`` old."""
    latest = predictions.agg(F.max("date").alias("date"))
    recent = latest.filter(F.col("date") >= F.date_sub(as_date(as_of), max_age_days))
    return flood_status(predictions.join(recent, "date", "left_semi"), "0001-01-01", risk)


def forecast_freshness(forecast: DataFrame, predictions: DataFrame, as_of, ahead: int = 5, max_age_days: int = 2) -> DataFrame:
    """Whether the weather reaches far enough ahead and the predictions are recent enough."""
    day = as_date(as_of)
    reach = forecast.agg(F.max("date").alias("last_forecast_date"))
    return reach.select(
        "last_forecast_date",
        (F.col("last_forecast_date") >= F.date_add(day, ahead)).alias("forecast_fresh"),
        max_date(predictions).alias("last_prediction_date"),
        (max_date(predictions) >= F.date_sub(day, max_age_days)).alias("predictions_fresh"),
    )


def weekly_status(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """The week's highest reading per station, its band, and the band's thresholds."""
    weekly = readings.groupBy(
        "location_name",
        F.extract(F.lit("YEAROFWEEK"), F.col("date")).cast("int").alias("week_year"),
        F.weekofyear("date").alias("week_number"),
    ).agg(F.max("level_m").alias("reading"), F.max("date").alias("reading_date"))
    bounds = stations.select("station_name", "moderate", "high", "full_level")
    joined = weekly.join(bounds, weekly["location_name"] == bounds["station_name"], "left").drop("station_name")
    return joined.withColumn("status", F.when(F.col("reading") < F.col("moderate"), "safe").otherwise(risk_band("reading")))
