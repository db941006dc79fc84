"""The derived tables of ``thalweg.fixtures`` as DuckDB texts, for the oracle side only."""

from __future__ import annotations

AS_OF = "DATE '2001-07-01'"
BEGIN, END = "DATE '1995-01-01'", "DATE '2001-08-01'"


def _weather(place: str) -> str:
    return f"""
SELECT {place} AS location, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS precipitation_sum,
  CAST(least(24, count(*)) AS DOUBLE) AS precipitation_hours
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY {place}, CAST(l_shipdate AS DATE)"""


def _rain_filled(days: str) -> str:
    return f"""
SELECT location, date,
  coalesce(last_value(precipitation_sum IGNORE NULLS) OVER w, 0.0) AS precipitation_sum,
  coalesce(last_value(precipitation_hours IGNORE NULLS) OVER w, 0.0) AS precipitation_hours
FROM (SELECT location, date, max(precipitation_sum) AS precipitation_sum, max(precipitation_hours) AS precipitation_hours FROM (
        SELECT location, date, precipitation_sum, precipitation_hours FROM rain
        UNION ALL SELECT l.location, d.date, NULL, NULL FROM (SELECT DISTINCT location FROM rain) l CROSS JOIN {days} d)
      GROUP BY location, date)
WINDOW w AS (PARTITION BY location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "river": (
        (),
        """
SELECT r_name AS location_name, CAST(o_orderdate AS DATE) AS date,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1e7 AS level_m
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, CAST(o_orderdate AS DATE)""",
    ),
    "levels": (("river",), "SELECT location_name AS location, date, level_m AS level__m FROM river"),
    "rain": ((), _weather("n_name")),
    "fleet": ((), _weather("s_name")),
    "stations": (
        (),
        """
SELECT r_name AS station_name, concat('ST', CAST(r_regionkey AS VARCHAR)) AS station_number,
  CAST(2.5 AS DOUBLE) + CAST(0.1 AS DOUBLE) * r_regionkey AS moderate,
  CAST(3.5 AS DOUBLE) + CAST(0.1 AS DOUBLE) * r_regionkey AS high,
  CAST(4.0 AS DOUBLE) + CAST(0.1 AS DOUBLE) * r_regionkey AS full_level
FROM region""",
    ),
    "edges_up": (
        (),
        """
SELECT a.r_name AS station, b.r_name AS location, CASE WHEN a.r_regionkey = b.r_regionkey THEN 0 ELSE 1 END AS pos
FROM region a JOIN region b ON b.r_regionkey = a.r_regionkey OR b.r_regionkey = (a.r_regionkey + 1) % (SELECT count(*) FROM region)""",
    ),
    "edges_wx": (
        (),
        """
SELECT r_name AS station, n_name AS location,
  CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1 AS INTEGER) AS pos
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""",
    ),
    "river_dirty": (
        ("river",),
        """
SELECT location_name, date, CASE WHEN day(date) <> 13 THEN level_m END AS level_m, 1 AS load_seq FROM river
UNION ALL
SELECT location_name, date, level_m + 0.5, 2 FROM river WHERE dayofyear(date) % 50 = 0""",
    ),
    "days": ((), f"SELECT CAST(unnest(generate_series({BEGIN}, {END}, INTERVAL 1 DAY)) AS DATE) AS date"),
    "levels_filled": (
        ("levels", "days"),
        """
SELECT location, date, coalesce(
    last_value(level__m IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(level__m IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level__m
FROM (SELECT location, date, max(level__m) AS level__m FROM (
        SELECT location, date, level__m FROM levels
        UNION ALL SELECT l.location, d.date, NULL FROM (SELECT DISTINCT location FROM levels) l CROSS JOIN days d)
      GROUP BY location, date)""",
    ),
    "rain_filled": (("rain", "days"), _rain_filled("days")),
    "weather_days": (
        ("rain",),
        f"SELECT CAST(d AS DATE) AS date FROM (SELECT max(date) AS last FROM rain), unnest(generate_series({BEGIN}, last, INTERVAL 1 DAY)) AS t(d)",
    ),
    "rain_daily": (("rain", "weather_days"), _rain_filled("weather_days")),
    "rain_forecast": (
        ("rain",),
        """
SELECT location, date, precipitation_sum + 1 AS precipitation_sum, precipitation_hours
FROM rain WHERE date >= DATE '2001-06-01'""",
    ),
    "banded": (
        ("river", "stations"),
        """
SELECT r.*, s.station_number, CASE WHEN level_m < moderate THEN 'low' WHEN level_m < high THEN 'moderate'
  WHEN level_m < full_level THEN 'high' ELSE 'full' END AS band
FROM river r JOIN stations s ON location_name = station_name""",
    ),
    "preds": (
        ("banded",),
        f"""
SELECT CAST(substr(station_number, 3) AS BIGINT) * 100000 + datediff('day', {BEGIN}, date) AS id, location_name, date, level_m, station_number,
  concat('Preprocessor_001-f7-', CASE WHEN dayofyear(date) % 2 = 0 THEN 'XGBoost_001' ELSE 'Prophet_001' END, '-', location_name) AS ml_model_name,
  7 AS forecast_days,
  CASE WHEN day(date) % 2 = 0 THEN NULL WHEN day(date) % 3 = 0 THEN upper(band) ELSE band END AS risk_level,
  DATE '2001-01-01' AS created_at, DATE '2001-01-01' AS updated_at
FROM banded""",
    ),
    "river_gappy": (("river",), "SELECT * FROM river WHERE dayofyear(date) % 3 <> 0"),
    "secondary": (
        ("river",),
        """
SELECT r_regionkey AS station_id, date AS reading_date, CASE WHEN day(date) <> 20 THEN level_m END AS reading
FROM river JOIN region ON location_name = r_name WHERE day(date) <= 25""",
    ),
    "sensors": (
        (),
        """
SELECT event_id, CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '---' WHEN event_id % 50 = 0 THEN ' 0'
    WHEN event_id % 71 = 0 THEN '' WHEN event_id % 73 = 0 THEN 'NULL' ELSE CAST(event_id AS VARCHAR) END AS value,
  ts AS reading_ts, CASE WHEN event_id % 7 <> 0 THEN concat('fw', CAST(event_id % 4 AS VARCHAR)) END AS firmware
FROM events""",
    ),
    "readings": ((), "SELECT event_type AS location, ts, event_id, value FROM events"),
    "portal": (
        ("river",),
        """
SELECT n.location_name, n.date, b.previousreadingvalue, n.level_m AS readingvalue
FROM river n LEFT JOIN (
  SELECT location_name, CAST(date + INTERVAL 12 MONTH AS DATE) AS date, max(level_m) AS previousreadingvalue FROM river GROUP BY 1, 2) b
  ON n.location_name = b.location_name AND n.date = b.date""",
    ),
}


def _ordered(names, done: list[str]) -> list[str]:
    for name in names:
        needs, _ = TABLES[name]
        _ordered(needs, done)
        if name not in done:
            done.append(name)
    return done


def oracle(names: str, body: str, **extra: str) -> str:
    """``body`` behind the named tables and what they need; ``extra`` adds tables of its own."""
    parts = [f"{n} AS ({TABLES[n][1]})" for n in _ordered(names.split(), [])]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body
