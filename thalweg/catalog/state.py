"""Upserts, inserts and duplicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import oracle
from thalweg.operators import series, state
from thalweg.session import fresh_path

BATCH = "SELECT location_name, date, level_m + 1 AS level_m FROM river WHERE day(date) IN (1, 2) UNION ALL SELECT location_name, date + 3000, level_m FROM river WHERE day(date) = 3"


def batch(spark, sf):
    """New levels: corrections of days on record and days the table does not have."""
    river = fx.river(spark, sf)
    changed = river.filter(F.dayofmonth("date").isin(1, 2)).withColumn("level_m", F.col("level_m") + 1)
    added = river.filter(F.dayofmonth("date") == 3).withColumn("date", F.date_add("date", 3000))
    return changed.unionByName(added)


@query(
    "upsert_weather",
    oracle(
        "rain rain_forecast",
        """SELECT location AS location_name, date, precipitation_sum, precipitation_hours FROM rain_forecast
UNION ALL SELECT location, date, precipitation_sum, precipitation_hours FROM rain r WHERE date <= DATE '2001-07-01'
  AND NOT EXISTS (SELECT 1 FROM rain_forecast f WHERE f.location = r.location AND f.date = r.date)""",
    ),
)
def upsert_weather(spark, sf):
    """Through a table by year: the history is merged into nothing, the forecast into its year."""
    old = fx.weather(spark, sf, end="2001-07-01")
    new = fx.rain_forecast(spark, sf).withColumnRenamed("location", "location_name")
    new = new.withColumns({"forecast_latitude": F.lit(0.0), "forecast_longitude": F.lit(0.0)})
    store = state.PeriodTable(spark, fresh_path(spark, "weather"), old.schema, unit="year")
    store.merge(old, state.upsert_weather)
    store.merge(new, state.upsert_weather)
    return store.read()


@query(
    "insert_if_absent",
    oracle(
        "river",
        "SELECT * FROM river UNION ALL SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM river r WHERE r.location_name = b.location_name AND r.date = b.date)",
        batch=BATCH,
    ),
)
def insert_if_absent(spark, sf):
    return state.insert_if_absent(fx.river(spark, sf), batch(spark, sf))


@query(
    "conflict_report",
    oracle(
        "river",
        """SELECT b.location_name, b.date, r.level_m AS existing, b.level_m AS incoming FROM river r JOIN batch b USING (location_name, date)
WHERE r.level_m IS DISTINCT FROM b.level_m""",
        batch=BATCH,
    ),
)
def conflict_report(spark, sf):
    return state.conflict_report(fx.river(spark, sf), batch(spark, sf))


@query(
    "upsert_prediction",
    oracle(
        "preds",
        """SELECT o.id, coalesce(o.location_name, n.location_name) AS location_name, coalesce(o.date, n.date) AS date,
  coalesce(n.level_m, o.level_m) AS level_m, o.station_number, coalesce(o.ml_model_name, n.ml_model_name) AS ml_model_name,
  coalesce(n.forecast_days, o.forecast_days) AS forecast_days, o.risk_level,
  CASE WHEN o.id IS NULL THEN DATE '2001-09-01' ELSE o.created_at END AS created_at,
  CASE WHEN n.level_m IS NOT NULL THEN DATE '2001-09-01' ELSE o.updated_at END AS updated_at
FROM preds o FULL JOIN fresh n ON o.location_name = n.location_name AND o.date = n.date AND o.ml_model_name = n.ml_model_name""",
        fresh="""SELECT location_name, date, ml_model_name, level_m + 2 AS level_m, 5 AS forecast_days FROM preds WHERE month(date) = 3
UNION ALL SELECT location_name, date + 400, ml_model_name, level_m, 7 FROM preds WHERE month(date) = 5""",
    ),
)
def upsert_prediction(spark, sf):
    old = fx.predictions(spark, sf)
    key = ["location_name", "date", "ml_model_name"]
    again = old.filter(F.month("date") == 3).select(*key, (F.col("level_m") + 2).alias("level_m"), F.lit(5).alias("forecast_days"))
    ahead = old.filter(F.month("date") == 5).withColumn("date", F.date_add("date", 400)).select(*key, "level_m", "forecast_days")
    return state.upsert_predictions(old, again.unionByName(ahead), dt.date(2001, 9, 1))


@query(
    "insert_ignore",
    oracle(
        "secondary",
        """SELECT * FROM secondary WHERE year(reading_date) < 1998
UNION ALL SELECT station_id, reading_date, max(reading) FROM secondary WHERE year(reading_date) >= 1998 GROUP BY ALL""",
    ),
)
def insert_ignore(spark, sf):
    """A batch that repeats old rows and holds every new row twice."""
    rows = fx.secondary(spark, sf)
    old = rows.filter(F.year("reading_date") < 1998)
    late = rows.filter(F.year("reading_date") >= 1997)
    return state.insert_ignore(old, late.unionByName(late))


@query(
    "table_by_month_range",
    oracle("rain", "SELECT location AS location_name, date, precipitation_sum, precipitation_hours FROM rain WHERE date BETWEEN DATE '1999-01-15' AND DATE '1999-03-10'"),
)
def table_by_month_range(spark, sf):
    """Rows of some days from a table by month, after the same batch came twice."""
    rows = fx.weather(spark, sf, "1998-12-01", "1999-05-31")
    store = state.PeriodTable(spark, fresh_path(spark, "weather"), rows.schema)
    for _ in range(2):
        store.merge(rows, state.insert_if_absent)
    return store.read("1999-01-15", "1999-03-10")


@query("full_refresh", oracle("rain", "SELECT location AS location_name, date, precipitation_sum, precipitation_hours FROM rain WHERE year(date) = 2001"))
def full_refresh(spark, sf):
    old, new = fx.weather(spark, sf, end="2000-12-31"), fx.weather(spark, sf, "2001-01-01", "2001-12-31")
    store = state.SnapshotTable(spark, fresh_path(spark, "refresh"), old.schema)
    store.commit(old)
    store.commit(state.upsert_weather(store.read(), new, clear_existing=True))
    return store.read()


@query(
    "delete_older_duplicates",
    oracle(
        "preds",
        "SELECT max(id) AS id, location_name, date, ml_model_name FROM (SELECT id, location_name, date, ml_model_name FROM preds UNION ALL SELECT id + 1000000, location_name, date, ml_model_name FROM preds WHERE id % 3 = 0) GROUP BY ALL",
    ),
)
def delete_older_duplicates(spark, sf):
    rows = fx.predictions(spark, sf).select("id", "location_name", "date", "ml_model_name")
    copies = rows.filter("id % 3 = 0").withColumn("id", F.col("id") + 1000000)
    return state.delete_older_duplicates(rows.unionByName(copies))


@query(
    "gap_fill_from_source",
    oracle(
        "river_gappy secondary days",
        """SELECT r_name AS location_name, reading_date AS date, reading AS level_m FROM secondary JOIN region ON station_id = r_regionkey
WHERE reading IS NOT NULL AND NOT EXISTS (SELECT 1 FROM river_gappy g WHERE g.location_name = r_name AND g.date = reading_date)""",
    ),
)
def gap_fill_from_source(spark, sf):
    gappy = fx.river_gappy(spark, sf).withColumnRenamed("location_name", "location")
    ids = fx.stations(spark, sf).select(F.col("station_name").alias("location"), F.substring("station_number", 3, 9).cast("int").alias("station_id"))
    lacking = series.missing_dates(gappy, fx.BEGIN, fx.END)
    return state.gap_fill_rows(lacking, ids, fx.secondary(spark, sf))
