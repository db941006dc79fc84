"""Readers, parsers and writers.

Landed files and service answers are made from the given tables first, written to the shared folder
where the reader needs files, and read back by the operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import oracle
from thalweg.operators import series, state
from thalweg.schema import DAILY_MEASURES, FORECAST_MEASURES, HOURLY_MEASURES, STATION_SERIES, WEATHER_SERIES, conform
from thalweg.session import fresh_path
from thalweg.sources import payloads, sinks, tables


def land_csv(df, name: str, **options) -> str:
    path = fresh_path(df.sparkSession, name)
    df.write.option("header", "true").options(**options).csv(path)
    return path


PLACES = ["ASIA", "EUROPE"]
IN_PLACES = "location IN ('ASIA', 'EUROPE')"


@query(
    "scan_river_csv",
    oracle("levels", f"SELECT * FROM levels WHERE {IN_PLACES} AND date BETWEEN DATE '1996-02-01' AND DATE '1999-12-31'"),
)
def scan_river_csv(spark, sf):
    text = fx.levels(spark, sf).select("location", F.date_format("date", "dd/MM/yyyy").alias("date"), F.lit("x").alias("note"), "level__m")
    return tables.scan_river_csv(spark, land_csv(text, "river-csv"), PLACES, "1996-02-01", "1999-12-31")


@query("scan_weather_csv", oracle("rain", "SELECT * FROM rain WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'"))
def scan_weather_csv(spark, sf):
    """The files hold 01:30 at +03:00 of the next day, which is 22:30 UTC of the day itself."""
    stamp = F.concat(F.date_format(F.date_add("date", 1), "yyyy-MM-dd"), F.lit(" 01:30:00+03:00"))
    text = fx.rain(spark, sf).select(stamp.alias("date"), "location", F.lit(1).alias("rain_sum"), *series.RAIN)
    return tables.scan_weather_csv(spark, land_csv(text, "weather-csv"), None, "1997-01-01", "1998-06-30")


STORED = """SELECT location AS location_name, CAST(date AS TIMESTAMP) AS date, CASE WHEN day(date) <> 7 THEN precipitation_sum END AS precipitation_sum,
  precipitation_hours, 1 AS id FROM rain
UNION ALL SELECT location, CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR, precipitation_sum + 2, NULL, 2 FROM rain WHERE dayofyear(date) % 10 = 0"""


def stored_weather(spark, sf):
    """Weather as a database holds it: time stamps, NULLs, later corrections at noon."""
    rain = fx.rain(spark, sf).withColumnRenamed("location", "location_name")
    rain = rain.withColumn("date", F.col("date").cast("timestamp"))
    first = rain.withColumn("precipitation_sum", F.when(F.dayofmonth("date") != 7, F.col("precipitation_sum"))).withColumn("id", F.lit(1))
    noon = rain.filter(F.dayofyear("date") % 10 == 0).select(
        "location_name",
        (F.col("date") + F.expr("INTERVAL 12 HOURS")).alias("date"),
        (F.col("precipitation_sum") + 2).alias("precipitation_sum"),
        F.lit(None).cast("double").alias("precipitation_hours"),
        F.lit(2).alias("id"),
    )
    return first.unionByName(noon)


def loaded_sql(value: str, where: str) -> str:
    return f"""SELECT location_name AS location, CAST(date AS DATE) AS date, {value.format(c='precipitation_sum')} AS precipitation_sum,
  {value.format(c='precipitation_hours')} AS precipitation_hours
FROM (SELECT *, row_number() OVER (PARTITION BY location_name, CAST(date AS DATE) ORDER BY id DESC) AS rn FROM stored WHERE {where}) WHERE rn = 1"""


NATIONS = ["NATION_1", "NATION_7", "NATION_16", "NATION_24"]
IN_NATIONS = "location_name IN ('NATION_1', 'NATION_7', 'NATION_16', 'NATION_24')"


@query(
    "load_history_weather",
    oracle("rain", loaded_sql("coalesce({c}, 0.0)", f"{IN_NATIONS} AND date >= TIMESTAMP '1998-01-01' AND date < TIMESTAMP '2001-01-01'"), stored=STORED),
)
def load_history_weather(spark, sf):
    return tables.load_history_weather(stored_weather(spark, sf), NATIONS, "1998-01-01", "2000-12-31")


@query(
    "load_forecast_weather",
    oracle("rain", loaded_sql("{c}", f"{IN_NATIONS} AND date >= TIMESTAMP '2001-06-01' AND date < TIMESTAMP '2001-08-02'"), stored=STORED),
)
def load_forecast_weather(spark, sf):
    return tables.load_forecast_weather(stored_weather(spark, sf), NATIONS, "2001-06-01", "2001-08-01")


@query(
    "load_river_level",
    oracle(
        "river_dirty",
        """SELECT location_name AS location, date, level_m AS level__m FROM (
  SELECT *, row_number() OVER (PARTITION BY location_name, date ORDER BY load_seq DESC) AS rn FROM river_dirty
  WHERE location_name IN ('ASIA', 'EUROPE') AND date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30') WHERE rn = 1 AND level_m IS NOT NULL""",
    ),
)
def load_river_level(spark, sf):
    return tables.load_river_level(fx.river_dirty(spark, sf), PLACES, "1996-01-01", "2000-06-30", recency=("load_seq",))


@query("source_dispatch", oracle("levels", "SELECT 'csv' AS kind, count(*) AS n FROM levels UNION ALL SELECT k, count(*) FROM levels, (SELECT unnest(['parquet', 'orc', 'json']) AS k) GROUP BY k"))
def source_dispatch(spark, sf):
    """The same table through every file format the dispatcher knows."""
    levels = fx.levels(spark, sf)
    out = None
    for kind in ("csv", "parquet", "orc", "json"):
        path = fresh_path(spark, f"levels-{kind}")
        writer = levels.write.format(kind)
        (writer.option("header", "true") if kind == "csv" else writer).save(path)
        counted = tables.read_source(spark, kind, path, STATION_SERIES).agg(F.lit(kind).alias("kind"), F.count("level__m").alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


def _epoch(date):
    return F.unix_date(date).cast("long") * 86400


def daily_payloads(spark, sf, forecast: bool):
    """One answer per location and year, as the weather service gives them."""
    measures = FORECAST_MEASURES if forecast else DAILY_MEASURES
    values = {m: F.col("precipitation_sum") + i for i, m in enumerate(measures)}
    values["precipitation_hours"] = F.col("precipitation_hours")
    rows = fx.rain_daily(spark, sf).select(F.col("location").alias("location_name"), "date", *[values[m].alias(m) for m in measures])
    years = rows.groupBy("location_name", F.year("date")).agg(F.sort_array(F.collect_list(F.struct("date", *measures))).alias("d"))
    block = F.struct(
        _epoch(F.element_at("d", 1)["date"]).alias("start"),
        (_epoch(F.element_at("d", -1)["date"]) + 86400).alias("end"),
        F.lit(86400).alias("interval"),
        *[F.col(f"d.{m}").alias(m) for m in measures],
    )
    doc = F.to_json(F.struct(F.lit(1.5).alias("latitude"), F.lit(42.5).alias("longitude"), block.alias("daily")))
    return years.select("location_name", doc.alias("payload"))


def daily_sql(measures) -> str:
    exprs = [("precipitation_hours" if m == "precipitation_hours" else f"precipitation_sum + {i}") + f" AS {m}" for i, m in enumerate(measures)]
    return f"SELECT location AS location_name, date, 1.5::DOUBLE AS forecast_latitude, 42.5::DOUBLE AS forecast_longitude, {', '.join(exprs)} FROM rain_daily"


@query("weather_payload_daily", oracle("rain_daily", daily_sql(DAILY_MEASURES)))
def weather_payload_daily(spark, sf):
    return payloads.weather_daily(daily_payloads(spark, sf, False))


@query("weather_payload_daily_forecast", oracle("rain_daily", daily_sql(FORECAST_MEASURES)))
def weather_payload_daily_forecast(spark, sf):
    return payloads.weather_daily(daily_payloads(spark, sf, True), forecast=True)


def landed_answers(spark, sf):
    """The daily answers of all years, those of three years in five broken in one way each."""
    rows = daily_payloads(spark, sf, False).withColumn("y", F.year(F.timestamp_seconds(F.get_json_object("payload", "$.daily.start").cast("long"))))
    nth = F.col("y") % 5
    broken = F.when(nth == 0, F.substring("payload", 1, 200)).when(nth == 1, F.lit('{"error": true}')).when(nth == 2, F.replace("payload", F.lit('"interval":86400'), F.lit('"interval":0')))
    return rows.withColumn("payload", F.coalesce(broken, F.col("payload")))


@query("weather_payload_kept", oracle("rain_daily", f"SELECT * FROM ({daily_sql(DAILY_MEASURES)}) WHERE year(date) % 5 > 2"))
def weather_payload_kept(spark, sf):
    """The rows of the answers that can be read, beside ones that can't."""
    return payloads.weather_daily(landed_answers(spark, sf))


@query(
    "weather_payload_rejected",
    oracle(
        "rain_daily",
        """SELECT DISTINCT location AS location_name, CAST(year(date) AS INTEGER) AS y, CASE year(date) % 5 WHEN 0 THEN 'no JSON' WHEN 1 THEN 'no daily block' ELSE 'no time axis' END AS reason
FROM rain_daily WHERE year(date) % 5 < 3""",
    ),
)
def weather_payload_rejected(spark, sf):
    return payloads.rejected_weather(landed_answers(spark, sf), ("location_name", "y"))


HOURS = """SELECT location, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS h, max(value) AS temperature_2m, min(value) AS precipitation_probability,
  CAST(count(*) AS DOUBLE) AS precipitation FROM readings GROUP BY ALL"""


@query(
    "weather_payload_hourly",
    oracle(
        "readings",
        """SELECT d.location AS location_name, CAST(epoch(CAST(d.day AS TIMESTAMP)) AS BIGINT) + x.h * 3600 AS epoch, 1.5::DOUBLE AS forecast_latitude, 42.5::DOUBLE AS forecast_longitude,
  temperature_2m, precipitation_probability, precipitation, upper(d.location) AS station_name
FROM (SELECT DISTINCT location, day FROM hours) d CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS h) x
LEFT JOIN hours o ON o.location = d.location AND o.day = d.day AND o.h = x.h""",
        hours=HOURS,
    ),
)
def weather_payload_hourly(spark, sf):
    hours = (
        fx.readings(spark, sf)
        .groupBy(F.col("location").alias("location_name"), F.col("ts").cast("date").alias("day"), F.hour("ts").alias("h"))
        .agg(
            F.max("value").alias("temperature_2m"),
            F.min("value").alias("precipitation_probability"),
            F.count("*").cast("double").alias("precipitation"),
        )
    )
    days = hours.groupBy("location_name", "day").agg(F.map_from_entries(F.collect_list(F.struct("h", F.struct(*HOURLY_MEASURES)))).alias("m"))

    def by_hour(measure):
        return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("m", h)[measure]).alias(measure)

    arrays = [by_hour(m) for m in HOURLY_MEASURES]
    block = F.struct(_epoch("day").alias("start"), (_epoch("day") + 86400).alias("end"), F.lit(3600).alias("interval"), *arrays)
    doc = F.to_json(F.struct(F.lit(1.5).alias("latitude"), F.lit(42.5).alias("longitude"), block.alias("hourly")))
    names = fx.readings(spark, sf).select(F.col("location").alias("location_name")).distinct().withColumn("station_name", F.upper("location_name"))
    rows = payloads.weather_hourly(days.select("location_name", doc.alias("payload")), attributes=names)
    return rows.withColumn("epoch", F.unix_timestamp("ts")).drop("ts")


CHART_SQL = """SELECT p.location, p.shown, moved AS date, full_level AS bankfull, high AS highfloodrisk,
  moderate AS moderatefloodrisk, NULL::DOUBLE AS longtermmean, p.level__m AS previousreadingvalue, c.level__m AS readingvalue
FROM (SELECT *, CAST(year(date) + 1 AS INTEGER) AS shown, try_cast(concat(year(date) + 1, strftime(date, '-%m-%d')) AS DATE) AS moved FROM levels) p
JOIN stations ON p.location = station_name
LEFT JOIN levels c ON c.location = p.location AND c.date = moved
WHERE moved IS NOT NULL AND EXISTS (SELECT 1 FROM levels k WHERE k.location = p.location AND year(k.date) = p.shown)"""


def chart_payloads(spark, sf):
    """One chart answer per station and year: the year as a list, the one before as a map by date text."""
    text = F.col("level__m").cast("string")
    entry = F.struct(text.alias("readingValue"), F.lit(None).cast("string").alias("longtermMean"), F.date_format("date", "dd-MM-yyyy").alias("dateOfReadingStr"))
    year = F.year("date")
    rows = fx.levels(spark, sf).select("location", entry.alias("e"), year.alias("y"))
    rows = rows.withColumn("shown", F.explode(F.array("y", F.col("y") + 1)))
    now = F.col("y") == F.col("shown")
    lists = rows.groupBy("location", "shown").agg(
        F.collect_list(F.when(now, F.col("e"))).alias("gaugeReadingList"),
        F.map_from_entries(F.collect_list(F.when(~now, F.struct(F.col("e.dateOfReadingStr"), F.col("e"))))).alias("before"),
    )
    dim = fx.stations(spark, sf).select(
        F.col("station_name").alias("location"),
        F.struct(
            F.col("moderate").cast("string").alias("moderateRiskLevelVal"),
            F.col("high").cast("string").alias("highRiskLevelVal"),
            F.col("full_level").cast("string").alias("bankFullVal"),
        ).alias("indicator"),
    )
    doc = F.to_json(F.struct("gaugeReadingList", "indicator", F.struct(F.col("before").alias("gaugeReadingList")).alias("previous_year")))
    return lists.join(dim, "location").select("location", "shown", doc.alias("payload"))


@query("gauge_chart_json", oracle("levels stations", CHART_SQL))
def gauge_chart_json(spark, sf):
    return payloads.gauge_chart(chart_payloads(spark, sf), ("location", "shown"))


@query(
    "year_over_year_join",
    oracle(
        "levels",
        """SELECT p.location, CAST(make_date(2000, CAST(month(p.date) AS INTEGER), CAST(day(p.date) AS INTEGER)) AS DATE) AS date, p.level__m AS previous, c.level__m AS current
FROM (SELECT * FROM levels WHERE year(date) = 1999) p
LEFT JOIN (SELECT * FROM levels WHERE year(date) = 2000) c ON c.location = p.location AND month(c.date) = month(p.date) AND day(c.date) = day(p.date)""",
    ),
)
def year_over_year_join(spark, sf):
    return series.year_over_year(fx.levels(spark, sf), 2000)


@query(
    "gauge_html_table",
    oracle(
        "river",
        """SELECT strftime(date, '%Y%m%d') AS page_id, location_name, date, CASE WHEN day(date) <> 13 THEN level_m END AS level_m
FROM river""",
    ),
)
def gauge_html_table(spark, sf):
    """Pages made from the river: unknown stations first, then all stations, then all of them again."""
    shown = F.when(F.dayofmonth("date") != 13, F.col("level_m").cast("string")).otherwise("no reading")
    line = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit('<td class="c"> '), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))
    day = F.date_format("date", "dd-MM-yyyy")
    pages = fx.river(spark, sf).groupBy("date").agg(
        F.sort_array(F.collect_list(F.struct("location_name", line(F.lit("<b>x</b>"), F.col("location_name"), shown, day).alias("tr")))).alias("rows"),
    )
    body = F.array_join("rows.tr", "")
    unknown = F.repeat(line(F.lit("x"), F.lit("NOWHERE"), F.lit("1.0"), day), F.when(F.dayofmonth("date") % 10 == 0, 5).otherwise(1))
    head = F.lit("<tr><th>#</th><th>Station</th><th>Observed River Level (m)</th><th>Date</th></tr>")
    other = F.lit("<html><table id='x'><tr><td>no</td></tr></table>")
    html = F.concat(other, F.lit('<table class="t" id="maps-data-grid">'), head, unknown, body, body, F.lit("</table></html>"))
    made = pages.select(F.date_format("date", "yyyyMMdd").alias("page_id"), html.alias("html"))
    return payloads.gauge_table(made, fx.stations(spark, sf))


@query(
    "json_records",
    oracle("secondary", "SELECT station_id, reading_date, reading FROM secondary"),
)
def json_records(spark, sf):
    record = F.struct(
        F.coalesce(F.col("reading").cast("string"), F.lit("n/a")).alias("readingValue"),
        F.date_format("reading_date", "dd-MM-yyyy").alias("dateOfReadingStr"),
        F.lit("2").alias("riverId"),
    )
    years = fx.secondary(spark, sf).groupBy("station_id", F.year("reading_date")).agg(F.collect_list(record).alias("gaugeReadingList"))
    docs = years.select("station_id", F.to_json(F.struct("gaugeReadingList")).alias("payload"))
    rows = payloads.json_records(docs, "gaugeReadingList", {"readingValue": "number", "dateOfReadingStr": "dash"}, ["station_id"])
    return rows.select("station_id", F.col("dateOfReadingStr").alias("reading_date"), F.col("readingValue").alias("reading"))


@query(
    "map_array_json",
    oracle(
        "levels",
        """SELECT location, CAST(year(date) AS INTEGER) AS shown, 'current' AS list, date, level__m AS reading FROM levels
UNION ALL SELECT location, CAST(year(date) + 1 AS INTEGER), 'previous', date, level__m FROM levels""",
    ),
)
def map_array_json(spark, sf):
    return payloads.chart_entries(chart_payloads(spark, sf), ("location", "shown"))


@query(
    "station_mapping_edges",
    oracle("edges_up edges_wx", "SELECT station, 'upstream' AS role, pos, location FROM edges_up UNION ALL SELECT station, 'weather', pos, location FROM edges_wx"),
)
def station_mapping_edges(spark, sf):
    """Mapping documents written as text, read back, unfolded into edges."""
    m = fx.station_mapping(spark, sf)
    docs = m.select(F.to_json(F.create_map("station", F.struct("location", "river", "upstream_stations", "weather_locations"))).alias("value"))
    path = fresh_path(spark, "mapping")
    docs.write.text(path)
    return tables.mapping_edges(tables.parse_mapping(spark.read.text(path)))


@query(
    "scan_archive_csv",
    oracle("river_dirty", "SELECT date, location_name AS location, level_m AS level__m FROM river_dirty WHERE level_m IS NOT NULL"),
)
def scan_archive_csv(spark, sf):
    text = fx.river_dirty(spark, sf).select(
        F.lit(1).alias("id"), F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit("S").alias("station_number"),
        F.coalesce(F.col("level_m").cast("string"), F.lit("---")).alias("level(m)"), F.col("location_name").alias("location"),
    )
    return tables.scan_archive_csv(spark, land_csv(text, "archive"))


def portal_csv(spark, sf):
    p = fx.portal(spark, sf)
    return p.select(
        F.col("location_name").alias("location"), F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit("6.0").alias("bankfull"),
        F.coalesce(F.col("previousreadingvalue").cast("string"), F.lit("")).alias("previousreadingvalue"), F.col("readingvalue").cast("string"),
    )


UNPIVOT = """SELECT date, location_name AS location, readingvalue AS level__m, 1 AS portal_rank FROM portal
UNION ALL SELECT CAST(date - INTERVAL 12 MONTH AS DATE), location_name, previousreadingvalue, 2 FROM portal WHERE previousreadingvalue IS NOT NULL"""


@query("scan_portal_csv_unpivot", oracle("portal", UNPIVOT))
def scan_portal_csv_unpivot(spark, sf):
    return tables.scan_portal_csv(spark, land_csv(portal_csv(spark, sf), "portal"))


ARCHIVE_PART = "SELECT location_name AS location, date, level_m + 1 AS level__m FROM river WHERE day(date) <= 20"
RECONCILED = """SELECT location, date, level__m FROM (SELECT *, row_number() OVER (PARTITION BY location, date ORDER BY src DESC, portal_rank DESC, level__m DESC) AS rn
  FROM (SELECT location, date, level__m, 1 AS src, 0 AS portal_rank FROM archive UNION ALL SELECT location, date, level__m, 2, portal_rank FROM tall)) WHERE rn = 1"""


def two_sources(spark, sf):
    archive = fx.levels(spark, sf).filter(F.dayofmonth("date") <= 20).withColumn("level__m", F.col("level__m") + 1)
    portal = fx.portal(spark, sf).withColumnRenamed("location_name", "location")
    return archive, tables.unpivot_portal(portal)


@query("reconcile_sources", oracle("river portal", RECONCILED, archive=ARCHIVE_PART, tall=UNPIVOT))
def reconcile_sources(spark, sf):
    return tables.reconcile(*two_sources(spark, sf))


@query(
    "latest_file_per_location",
    oracle("levels", "SELECT DISTINCT replace(lower(location), ' ', '_') AS location, '20010801' AS as_at FROM levels"),
)
def latest_file_per_location(spark, sf):
    """Two exports per location, the newer written last; only the listing decides."""
    folder = fresh_path(spark, "exports")
    levels = fx.levels(spark, sf)
    for stamp, end in (("20000801", "2000-08-01"), ("20010801", "2001-08-01")):
        name = F.concat(F.replace(F.lower("location"), F.lit(" "), F.lit("_")), F.lit(f"_river_levels_as_at_{stamp}"))
        rows = levels.filter(F.col("date") <= end).withColumn("export", name)
        rows.write.mode("append").partitionBy("export").option("header", "true").csv(folder)
    newest = tables.latest_file_per_location(spark, folder, r"/export=([a-z_]+?)_river_levels_as_at_[^/]*")
    return newest.select("location", F.regexp_extract("path", r"_as_at_(\d+)", 1).alias("as_at"))


@query(
    "station_dim",
    oracle("stations", "SELECT CAST(substr(station_number, 3) AS INTEGER) AS id, station_name AS name, moderate, high, CASE WHEN station_name <> 'ASIA' THEN full_level END AS \"full\" FROM stations"),
)
def station_dim(spark, sf):
    rows = fx.stations(spark, sf).select(
        F.substring("station_number", 3, 9).alias("id"), F.col("station_name").alias("name"), "moderate", "high",
        F.when(F.col("station_name") == "ASIA", "-").otherwise(F.col("full_level").cast("string")).alias("full"),
    )
    return tables.station_dim(spark, land_csv(rows, "stations"))


@query(
    "location_dim",
    oracle("", "SELECT n_name AS label, r_name AS region, CAST(n_nationkey AS DOUBLE) / 2 AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM nation JOIN region ON n_regionkey = r_regionkey"),
)
def location_dim(spark, sf):
    nation = fx.table(spark, sf, "nation").join(fx.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nation.select(F.col("n_name").alias("label"), F.col("r_name").alias("region"), (F.col("n_nationkey") / 2).alias("latitude"), F.lit("-").alias("longitude"))
    return tables.location_dim(spark, land_csv(rows, "locations"))


@query("sink_csv_dated", oracle("levels", "SELECT location, date, level__m FROM levels"))
def sink_csv_dated(spark, sf):
    path = sinks.save_csv_dated(fx.levels(spark, sf), fresh_path(spark, "levels"), fx.AS_OF)
    return tables.read_source(spark, "csv", path, STATION_SERIES)


@query("table_export", oracle("levels", "SELECT location, date, level__m FROM levels WHERE location = 'ASIA' AND level__m > 3"))
def table_export(spark, sf):
    """A second export without force leaves the first one alone."""
    path = fresh_path(spark, "export")
    sinks.export_table(fx.levels(spark, sf), path, "location = 'ASIA' AND level__m > 3")
    sinks.export_table(fx.levels(spark, sf), path, "location = 'EUROPE'")
    return tables.read_source(spark, "csv", path, STATION_SERIES)


@query("stage_artifacts", oracle("levels", "SELECT location AS station, 7 AS forecast_days, date, level__m FROM levels"))
def stage_artifacts(spark, sf):
    root = fresh_path(spark, "artifacts")
    rows = fx.levels(spark, sf).select(F.col("location").alias("station"), F.lit(7).alias("forecast_days"), "date", "level__m")
    sinks.stage_artifact(rows, root, "preprocessed")
    return sinks.read_artifact(spark, root, "preprocessed", "station string, forecast_days int, date date, level__m double")


@query("conform_schema", oracle("rain", "SELECT location, CAST(date AS DATE) AS date, precipitation_sum, precipitation_hours FROM rain"))
def conform_schema(spark, sf):
    rows = fx.rain(spark, sf).select(
        F.col("precipitation_hours").cast("int").alias("precipitation_hours"), "precipitation_sum", F.col("date").cast("timestamp").alias("date"), "location"
    )
    return conform(rows, WEATHER_SERIES)


@query("filter_locations_dates", oracle("river", "SELECT * FROM river WHERE location_name IN ('ASIA', 'EUROPE') AND date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'"))
def filter_locations_dates(spark, sf):
    return tables.filter_locations_dates(fx.river(spark, sf, "1997-03-01", "1997-09-30"), PLACES, "1997-03-01", "1997-09-30")


@query("project_rename", oracle("rain", "SELECT location, date, precipitation_sum, precipitation_hours FROM rain"))
def project_rename(spark, sf):
    return fx.weather(spark, sf).select(F.col("location_name").alias("location"), "date", *series.RAIN)


@query("fill_null_const", oracle("river_dirty", "SELECT location_name, date, coalesce(level_m, 0.0) AS level_m, load_seq FROM river_dirty"))
def fill_null_const(spark, sf):
    return fx.river_dirty(spark, sf).fillna({"level_m": 0.0})


@query("drop_null_rows", oracle("river_dirty", "SELECT * FROM river_dirty WHERE level_m IS NOT NULL"))
def drop_null_rows(spark, sf):
    return fx.river_dirty(spark, sf).dropna(subset=["level_m"])


@query("utc_calendar_date", oracle("readings", "SELECT location, CAST(ts AS DATE) AS day, CAST(ts + INTERVAL 3 HOUR AS DATE) AS local_day, count(*) AS n FROM readings GROUP BY ALL"))
def utc_calendar_date(spark, sf):
    from thalweg.functions.dates import utc_calendar_date as day

    r = fx.readings(spark, sf)
    return r.groupBy("location", day("ts").alias("day"), day("ts", "Africa/Nairobi").alias("local_day")).agg(F.count("*").alias("n"))


@query(
    "reconcile_archive",
    oracle(
        "river portal river_gappy",
        """SELECT location AS location_name, date, level__m AS level_m FROM merged m WHERE NOT EXISTS (SELECT 1 FROM river_gappy r WHERE r.location_name = m.location AND r.date = m.date)
UNION ALL SELECT location_name, date, level_m FROM river_gappy""",
        archive=ARCHIVE_PART,
        tall=UNPIVOT,
        merged=RECONCILED,
    ),
)
def reconcile_archive(spark, sf):
    """Archive and portal files read, reconciled, and what the table lacks inserted."""
    archive, _ = two_sources(spark, sf)
    text = archive.select(F.lit(1).alias("id"), F.date_format("date", "yyyy-MM-dd").alias("date"), F.lit("S").alias("station_number"), F.col("level__m").alias("level(m)"), "location")
    a = tables.scan_archive_csv(spark, land_csv(text, "archive"))
    p = tables.scan_portal_csv(spark, land_csv(portal_csv(spark, sf), "portal"))
    merged = tables.reconcile(a, p).select(F.col("location").alias("location_name"), "date", F.col("level__m").alias("level_m"))
    return state.insert_if_absent(fx.river_gappy(spark, sf), merged)
