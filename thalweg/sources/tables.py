"""Reading stored and landed tables into series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date, parse_date, previous_year
from thalweg.functions.numbers import nan_to_null, numeric_or_null
from thalweg.functions.text import normalise_name
from thalweg.operators import quality, series
from thalweg.operators.features import edges

FORMATS = ("csv", "parquet", "orc", "json", "jdbc")


def read_source(spark: SparkSession, kind: str, location: str, schema=None, options: Mapping[str, str] | None = None) -> DataFrame:
    """One reader for all storage kinds; ``location`` is a path, or for jdbc a table name."""
    if kind not in FORMATS:
        raise ValueError(f"unsupported data source type {kind!r}, expected one of {FORMATS}")
    options = dict(options or {})
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        options = {"header": "true", **options}
    if kind == "jdbc":
        return reader.options(dbtable=location, **options).load()
    return reader.options(**options).load(location)


def keep_locations(df: DataFrame, locations, key: str) -> DataFrame:
    """Rows of the wanted locations: a list becomes a pushed-down IN, a frame a semi join."""
    if locations is None:
        return df
    if isinstance(locations, DataFrame):
        wanted = locations.select(F.col(locations.columns[0]).alias(key)).distinct()
        return df.join(wanted, key, "left_semi")
    return df.filter(F.col(key).isin(list(locations)))


def _as_frame(spark: SparkSession, locations) -> DataFrame:
    if isinstance(locations, DataFrame):
        return locations.select(F.col(locations.columns[0]).alias("location"))
    return spark.createDataFrame([(x,) for x in locations], "location string")


def filter_locations_dates(df: DataFrame, locations, begin, end, key: str = "location_name", date: str = "date", inclusive_next_midnight: bool = False) -> DataFrame:
    """Rows of the locations from ``begin`` to the end of day ``end``.

    The bounds are put on the stored column itself, so that file and database scans can use them.
    ``inclusive_next_midnight`` also takes a stamp at 00:00 of the day after.
    """
    rows = keep_locations(df, locations, key)
    kind = df.schema[date].dataType.typeName()
    edge = lambda d: as_date(d).cast(kind)
    if begin is not None:
        rows = rows.filter(F.col(date) >= edge(begin))
    if end is not None:
        after = F.date_add(as_date(end), 1).cast(kind)
        rows = rows.filter(F.col(date) <= after if inclusive_next_midnight and kind != "date" else F.col(date) < after)
    return rows


def _normalised(df: DataFrame, recency: Sequence[str], fill_zero: bool, inclusive_next_midnight, locations, begin, end) -> DataFrame:
    rows = filter_locations_dates(df, locations, begin, end, inclusive_next_midnight=inclusive_next_midnight)
    values = {c: F.coalesce(c, F.lit(0.0)) if fill_zero else F.col(c) for c in series.RAIN}
    order = [F.col(c).alias(f"_r{i}") for i, c in enumerate(recency)]
    plain = rows.select(
        F.col("location_name").alias("location"),
        F.col("date").cast("date").alias("date"),
        *[e.cast("double").alias(c) for c, e in values.items()],
        *order,
    )
    one = series.dedup_keep_last(plain, ("location", "date"), [f"_r{i}" for i in range(len(recency))])
    return one.select("location", "date", *series.RAIN)


def load_history_weather(table: DataFrame, locations, begin, end, recency=("id",), check: bool = False, inclusive_next_midnight: bool = False) -> DataFrame:
    """Stored history as a weather series: missing precipitation counts as none, the latest row of
    a day is kept.  ``check`` raises where a location has no row at all."""
    out = _normalised(table, recency, True, inclusive_next_midnight, locations, begin, end)
    if check:
        quality.require_locations(_as_frame(table.sparkSession, locations), out)
    return out


def load_forecast_weather(table: DataFrame, locations, begin, end, recency=("id",), check: bool = False) -> DataFrame:
    """Stored forecast as a weather series; missing values stay missing.

    ``check`` raises where a location has no row in the range, naming the last day on record.
    """
    out = _normalised(table, recency, False, False, locations, begin, end)
    if check:
        wanted = _as_frame(table.sparkSession, locations)
        stored = table.withColumnRenamed("location_name", "location").withColumn("date", F.col("date").cast("date"))
        ends = quality.last_date_per_location(stored, key="location")
        lacking = quality.missing_locations(wanted, out).join(ends, "location", "left").limit(5).collect()
        if lacking:
            raise ValueError("no forecast in the range for: " + ", ".join(f"{r['location']} (last day {r['last_date']})" for r in lacking))
    return out


def load_river_level(table: DataFrame, locations, begin, end, fill_missing_dates: bool = False, recency=(), check: bool = False) -> DataFrame:
    """Stored levels as a series; rows without a level are dropped, holes filled on request."""
    rows = filter_locations_dates(table, locations, begin, end)
    order = [F.col(c).alias(f"_r{i}") for i, c in enumerate(recency)]
    plain = rows.select(
        F.col("location_name").alias("location"), F.col("date").cast("date").alias("date"), nan_to_null(F.col("level_m")).alias(series.LEVEL), *order
    )
    one = series.dedup_keep_last(plain, ("location", "date"), [f"_r{i}" for i in range(len(recency))])
    out = one.select("location", "date", series.LEVEL).dropna()
    if check:
        quality.require_locations(_as_frame(table.sparkSession, locations), out)
    return series.fill_missing_levels(out, begin, end) if fill_missing_dates else out


def _bounded(df: DataFrame, locations, begin, end) -> DataFrame:
    if begin is not None:
        df = df.filter(F.col("date") >= as_date(begin))
    if end is not None:
        df = df.filter(F.col("date") <= as_date(end))
    return keep_locations(df, locations, "location")


def scan_river_csv(spark, path: str, locations=None, begin=None, end=None) -> DataFrame:
    """Gauge CSV (location, date as dd/MM/yyyy, level__m) as a level series."""
    raw = read_source(spark, "csv", path)
    rows = raw.select("location", parse_date("date", "slash").alias("date"), numeric_or_null(series.LEVEL).alias(series.LEVEL))
    return _bounded(rows, locations, begin, end)


def scan_weather_csv(spark, path: str, locations=None, begin=None, end=None) -> DataFrame:
    """Weather CSV with offset time stamps as a weather series on UTC days."""
    raw = read_source(spark, "csv", path)
    rows = raw.select(
        "location", parse_date("date", "offset_timestamp").alias("date"), *[numeric_or_null(c).alias(c) for c in series.RAIN]
    )
    return _bounded(rows, locations, begin, end)


def scan_archive_csv(spark, path: str, location: str | None = None) -> DataFrame:
    """Archive CSV (id, date, station_number, level(m)) of one location, or with its own ``location`` column."""
    raw = read_source(spark, "csv", path)
    place = F.lit(location) if location is not None else F.col("location")
    rows = raw.select(
        parse_date("date", "iso").alias("date"), place.alias("location"), numeric_or_null(F.col("`level(m)`")).alias(series.LEVEL)
    )
    return rows.dropna()


def unpivot_portal(portal: DataFrame) -> DataFrame:
    """(date, location, level__m, portal_rank): each export row gives this year's reading and last
    year's, the latter a year earlier.  Where both speak of one day the year-shifted row ranks higher."""
    pairs = F.array(
        F.struct(F.col("date").alias("date"), F.col("readingvalue").alias(series.LEVEL), F.lit(1).alias("portal_rank")),
        F.struct(previous_year("date").alias("date"), F.col("previousreadingvalue").alias(series.LEVEL), F.lit(2).alias("portal_rank")),
    )
    rows = portal.select("location", F.explode(pairs).alias("p")).select("p.date", "location", f"p.{series.LEVEL}", "p.portal_rank")
    return rows.dropna(subset=["date", series.LEVEL])


def scan_portal_csv(spark, path: str, location: str | None = None) -> DataFrame:
    """Portal CSV in the form of ``unpivot_portal``."""
    raw = read_source(spark, "csv", path)
    place = F.lit(location) if location is not None else F.col("location")
    typed = raw.select(
        place.alias("location"),
        parse_date("date", "iso").alias("date"),
        *[numeric_or_null(c).alias(c) for c in ("readingvalue", "previousreadingvalue")],
    )
    return unpivot_portal(typed)


def reconcile(archive: DataFrame, portal: DataFrame, archive_rank: int = 1, portal_rank: int = 2) -> DataFrame:
    """One level per (location, date) from two sources; the higher rank wins, by default the portal."""
    a = archive.select("date", "location", series.LEVEL, F.lit(archive_rank).alias("_source"), F.lit(0).alias("_inner"))
    inner = F.col("portal_rank") if "portal_rank" in portal.columns else F.lit(0)
    p = portal.select("date", "location", series.LEVEL, F.lit(portal_rank).alias("_source"), inner.alias("_inner"))
    return series.dedup_keep_last(a.unionByName(p), ("location", "date"), ("_source", "_inner")).select("location", "date", series.LEVEL)


def latest_file_per_location(spark, folder: str, pattern: str) -> DataFrame:
    """(location, path, modified) of the newest file of each location.

    ``pattern`` is a regex over the path with one group for the location.  Only the file listing is
    read, not the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime")
    named = files.withColumn("location", F.regexp_extract("path", pattern, 1)).filter("location <> ''")
    newest = named.groupBy("location").agg(F.max(F.struct("modificationTime", "path")).alias("f"))
    return newest.select("location", "f.path", F.col("f.modificationTime").alias("modified"))


def portal_file_pattern(location: str | None = None) -> str:
    return f"/({normalise_name(location) if location else '[a-z0-9_]+?'})_river_levels_as_at_[^/]*"


def archive_file_pattern(location: str | None = None, prefix: str = "archive_level_data") -> str:
    return f"/{prefix}-({normalise_name(location) if location else '[a-z0-9_]+?'})-[^/]*"


MAPPING_SCHEMA = "map<string, struct<location: string, river: string, upstream_stations: array<string>, weather_locations: array<string>>>"


def parse_mapping(documents: DataFrame, column: str = "value") -> DataFrame:
    """Station mapping documents (JSON objects keyed by station) as one row per station."""
    entries = documents.select(F.explode(F.from_json(column, MAPPING_SCHEMA)).alias("station", "m"))
    return entries.select("station", "m.location", "m.river", "m.upstream_stations", "m.weather_locations")


def mapping_edges(mapping: DataFrame) -> DataFrame:
    """(station, role, pos, location) for both lists of a mapping."""
    up = edges(mapping, "upstream_stations").withColumn("role", F.lit("upstream"))
    return up.unionByName(edges(mapping, "weather_locations").withColumn("role", F.lit("weather")))


def station_dim(spark, path: str) -> DataFrame:
    """Stations CSV with thresholds; ``-`` and other non-numbers become NULL."""
    raw = read_source(spark, "csv", path)
    numbers = [c for c in ("latitude", "longitude", "moderate", "high", "full") if c in raw.columns]
    out = raw.withColumns({c: numeric_or_null(c) for c in numbers})
    return out.withColumn("id", F.col("id").try_cast("int")) if "id" in raw.columns else out


def location_dim(spark, path: str) -> DataFrame:
    """Weather locations CSV (label, region, district, latitude, longitude, remarks)."""
    raw = read_source(spark, "csv", path)
    return raw.withColumns({c: numeric_or_null(c) for c in ("latitude", "longitude")})


def lookup(dim: DataFrame, name: str, key: str = "name") -> DataFrame:
    """The row of one name; ValueError where there is none."""
    found = dim.filter(F.col(key) == name)
    if found.isEmpty():
        raise ValueError(f"{name} is not among the {key}s")
    return found
