"""Availability, gaps, duplicates, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import AS_OF, oracle
from thalweg.operators import quality

AVAIL = """SELECT location_name, min(date) AS first_date, max(date) AS last_date, count(*) AS records,
  count(DISTINCT date) AS distinct_days, CAST(max(date) - min(date) AS INTEGER) AS date_range FROM river_dirty GROUP BY ALL"""


@query(
    "high_water_mark",
    oracle(
        "rain",
        f"""SELECT max_date, CAST(max_date + 1 AS DATE) AS start_date, CAST(DATE '2001-12-01' - 1 AS DATE) AS end_date,
  max_date + 1 <= DATE '2001-12-01' - 1 AS needed FROM (SELECT max(date) AS max_date FROM rain)""",
    ),
)
def high_water_mark(spark, sf):
    return quality.fetch_window(fx.rain(spark, sf), "2001-12-01")


@query(
    "table_extent",
    oracle("river_dirty", "SELECT count(*) AS records, min(date) AS first_date, max(date) AS last_date, count(DISTINCT location_name) AS locations FROM river_dirty"),
)
def table_extent(spark, sf):
    return quality.table_extent(fx.river_dirty(spark, sf))


@query("availability_by_location", oracle("river_dirty", AVAIL))
def availability_by_location(spark, sf):
    return quality.availability(fx.river_dirty(spark, sf))


@query(
    "gap_count",
    oracle(
        "river_dirty",
        "SELECT location_name, first_date, last_date, CAST(date_range + 1 AS BIGINT) AS expected_days, date_range + 1 - distinct_days AS gap_days FROM a",
        a=AVAIL,
    ),
)
def gap_count(spark, sf):
    gaps = quality.gap_counts(quality.availability(fx.river_dirty(spark, sf)))
    return gaps.select("location_name", "first_date", "last_date", "expected_days", "gap_days")


@query("safe_common_range", oracle("river_dirty", "SELECT max(first_date) AS safe_start, min(last_date) AS safe_end FROM a", a=AVAIL))
def safe_common_range(spark, sf):
    return quality.common_range(quality.availability(fx.river_dirty(spark, sf)))


@query(
    "limited_or_stale",
    oracle(
        "fleet",
        """SELECT location_name, last_date, CAST(DATE '2001-10-30' - last_date AS INTEGER) AS days_old, date_range < 2370 AS limited,
  DATE '2001-10-30' - last_date > 7 AS stale FROM a WHERE date_range < 2370 OR DATE '2001-10-30' - last_date > 7""",
        a=AVAIL.replace("river_dirty", "fleet").replace("SELECT location_name", "SELECT location AS location_name"),
    ),
)
def limited_or_stale(spark, sf):
    found = quality.limited_or_stale(quality.availability(fx.fleet(spark, sf)), "2001-10-30", min_days=2370)
    return found.select("location_name", "last_date", "days_old", "limited", "stale")


@query("last_date_per_location", oracle("river_dirty", "SELECT location_name, max(date) AS last_date FROM river_dirty WHERE level_m IS NOT NULL GROUP BY ALL"))
def last_date_per_location(spark, sf):
    return quality.last_date_per_location(fx.river_dirty(spark, sf), "level_m")


@query("duplicate_keys", oracle("river_dirty", "SELECT location_name, date, count(*) AS n FROM river_dirty GROUP BY ALL HAVING count(*) > 1"))
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(fx.river_dirty(spark, sf), ("location_name", "date"))


@query(
    "null_profile",
    oracle(
        "sensors",
        """SELECT 'firmware' AS "column", count(*) FILTER (WHERE firmware IS NULL) AS nulls FROM sensors""",
    ),
)
def null_profile(spark, sf):
    return quality.null_profile(fx.sensors(spark, sf))


@query(
    "duplicate_row_count",
    oracle("", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS duplicate_rows FROM t", t="SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem"),
)
def duplicate_row_count(spark, sf):
    return quality.duplicate_rows(fx.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"))


Z = """SELECT '{c}' AS "column", count(*) FILTER (WHERE abs(({c} - m) / s) > 3) AS outliers FROM {t}, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {t})"""


@query(
    "zscore_outliers",
    " UNION ALL ".join(Z.format(c=c, t=t) for c, t in [("event_id", "events"), ("user_id", "events"), ("value", "events")]),
)
def zscore_outliers(spark, sf):
    return quality.zscore_outliers(fx.table(spark, sf, "events"))


@query(
    "sensor_sentinels",
    oracle(
        "sensors",
        """SELECT 'rows' AS "check", count(*) AS n FROM sensors
UNION ALL SELECT 'null_value', count(*) FROM sensors WHERE value IS NULL
UNION ALL SELECT 'sentinel_value', count(*) FROM sensors WHERE value IN ('---', '', 'NULL')
UNION ALL SELECT 'zero_value', count(*) FROM sensors WHERE trim(value) = '0'
UNION ALL SELECT 'timestamp_out_of_bounds', count(*) FROM sensors WHERE reading_ts < TIMESTAMP '1900-01-01' OR reading_ts > TIMESTAMP '2030-01-01'
UNION ALL SELECT 'null_firmware', count(*) FROM sensors WHERE firmware IS NULL""",
    ),
)
def sensor_sentinels(spark, sf):
    return quality.sensor_checks(fx.sensors(spark, sf))


@query(
    "year_coverage",
    oracle(
        "portal",
        """SELECT count(*) FILTER (WHERE year(date) = 2001) AS current_year, count(*) FILTER (WHERE year(date) = 2000) AS past_year,
  count(*) FILTER (WHERE year(date) = 1999) AS year_before, count(DISTINCT date) AS distinct_dates, min(date) AS first_date, max(date) AS last_date FROM portal""",
    ),
)
def year_coverage(spark, sf):
    return quality.year_coverage(fx.portal(spark, sf), 2001)


@query(
    "missing_locations",
    "SELECT CAST(c_custkey AS VARCHAR) AS location FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
)
def missing_locations(spark, sf):
    """Customers without an event."""
    keys = lambda name, key: fx.table(spark, sf, name).select(F.col(key).cast("string").alias("location"))
    return quality.missing_locations(keys("customer", "c_custkey"), keys("events", "user_id"))


COVERAGE = """SELECT w.location, count(r.date) AS n, max(r.date) AS last_date, CASE WHEN count(r.date) > 0 THEN 'OK' ELSE 'MISSING' END AS status
FROM (SELECT n_name AS location FROM nation) w LEFT JOIN rain_forecast r
  ON r.location = w.location GROUP BY ALL"""


@query("coverage_status", oracle("rain_forecast", COVERAGE))
def coverage_status(spark, sf):
    wanted = fx.table(spark, sf, "nation").select(F.col("n_name").alias("location"))
    return quality.coverage_status(wanted, fx.rain_forecast(spark, sf))


@query("recent_window", oracle("rain_forecast", f"SELECT location, count(*) AS n FROM rain_forecast WHERE date >= {AS_OF} - 7 GROUP BY ALL"))
def recent_window(spark, sf):
    return quality.recent_counts(fx.rain_forecast(spark, sf), fx.AS_OF)


@query("distinct_prediction_locations", oracle("preds", "SELECT DISTINCT location_name FROM preds ORDER BY 1"))
def distinct_prediction_locations(spark, sf):
    return fx.predictions(spark, sf).select("location_name").distinct().orderBy("location_name")


@query(
    "table_quality_report",
    oracle(
        "river_dirty",
        """SELECT 'nulls' AS "check", 'level_m' AS "column", count(*) FILTER (WHERE level_m IS NULL) AS n FROM t
UNION ALL SELECT 'duplicate_rows', NULL, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) FROM t
UNION ALL SELECT 'outliers', 'level_m', count(*) FROM t, (SELECT avg(level_m) AS m, stddev_samp(level_m) AS s FROM t) WHERE abs((level_m - m) / s) > 3 HAVING count(*) > 0""",
        t="SELECT location_name, date, level_m, load_seq FROM river_dirty UNION ALL SELECT * FROM river_dirty WHERE load_seq = 2",
    ),
)
def table_quality_report(spark, sf):
    dirty = fx.river_dirty(spark, sf)
    return quality.table_quality_report(dirty.unionByName(dirty.filter("load_seq = 2")), ["level_m"])
