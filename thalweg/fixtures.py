"""Hydrological tables derived from a star schema (regions, orders, line items, events).

Regions act as gauging stations, nations and suppliers as weather locations.  Sums are taken over
whole numbers, so no result depends on the order of addition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from thalweg.functions.dates import as_date
from thalweg.operators import risk, series
from thalweg.functions.text import model_name

AS_OF = dt.date(2001, 7, 1)
BEGIN, END = dt.date(1995, 1, 1), dt.date(2001, 8, 1)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table.  Its schema is read from the files once, as that takes a job of its own."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _bounded(df: DataFrame, ts: str, begin, end) -> DataFrame:
    """Bounds on the stored timestamp itself, where the file scan can use them."""
    if begin is not None:
        df = df.filter(F.col(ts) >= as_date(begin).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(ts) < F.date_add(as_date(end), 1).cast("timestamp_ntz"))
    return df


def river(spark, sf_dir, begin=None, end=None) -> DataFrame:
    """(location_name, date, level_m): a gappy daily series per region.

    Orders are brought to a region's number and summed; names join the sums.
    """
    orders = _bounded(table(spark, sf_dir, "orders"), "o_orderdate", begin, end)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    daily = (
        orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("date"), cents.alias("cents"))
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey", "date")
        .agg(F.sum("cents").alias("cents"), F.count("*").alias("n"))
    )
    named = daily.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    level = F.col("cents").cast("double") / F.col("n").cast("double") / F.lit(1e7)
    return named.select(F.col("r_name").alias("location_name"), "date", level.alias("level_m"))


def _rain(items: DataFrame, place: str) -> DataFrame:
    return items.groupBy(place, "date").agg(
        F.sum("l_quantity").alias("precipitation_sum"), F.least(F.lit(24), F.count("*")).cast("double").alias("precipitation_hours")
    )


def _shipped(spark, sf_dir, begin, end) -> DataFrame:
    items = _bounded(table(spark, sf_dir, "lineitem"), "l_shipdate", begin, end)
    return items.select("l_suppkey", "l_quantity", F.col("l_shipdate").cast("date").alias("date"))


def weather(spark, sf_dir, begin=None, end=None) -> DataFrame:
    """(location_name, date, precipitation_sum, precipitation_hours) per supplier nation."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    daily = _rain(_shipped(spark, sf_dir, begin, end).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")), "s_nationkey")
    names = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("location_name"))
    return daily.join(names, F.col("s_nationkey") == F.col("n_nationkey")).select("location_name", "date", *series.RAIN)


def fleet(spark, sf_dir, begin=None, end=None) -> DataFrame:
    """The same per supplier: the number of series grows with the data."""
    daily = _rain(_shipped(spark, sf_dir, begin, end), "l_suppkey")
    names = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("location_name"))
    return daily.join(names, F.col("l_suppkey") == F.col("s_suppkey")).select("location_name", "date", *series.RAIN)


def levels(spark, sf_dir, begin=None, end=None) -> DataFrame:
    """The river under the names of the modelling side."""
    return river(spark, sf_dir, begin, end).select(F.col("location_name").alias("location"), "date", F.col("level_m").alias("level__m"))


def rain(spark, sf_dir, begin=None, end=None) -> DataFrame:
    return weather(spark, sf_dir, begin, end).withColumnRenamed("location_name", "location")


def stations(spark, sf_dir) -> DataFrame:
    k = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("station_name"),
        F.concat(F.lit("ST"), k.cast("string")).alias("station_number"),
        (F.lit(2.5) + F.lit(0.1) * k).alias("moderate"),
        (F.lit(3.5) + F.lit(0.1) * k).alias("high"),
        (F.lit(4.0) + F.lit(0.1) * k).alias("full_level"),
    )


def station_mapping(spark, sf_dir) -> DataFrame:
    """(station, location, river, upstream_stations, weather_locations), both lists in order.

    A region lies below itself and the next region; its weather comes from those of its nations
    that have a supplier.
    """
    region = table(spark, sf_dir, "region")
    n = region.count()
    upstream = region.select(((F.col("r_regionkey") + n - 1) % n).alias("k"), F.col("r_name").alias("next_name"))
    supplied = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").join(supplied, "n_nationkey", "left_semi")
    places = nation.groupBy(F.col("n_regionkey").alias("k")).agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("places"))
    named = region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("station"))
    return (
        named.join(upstream, "k")
        .join(places, "k")
        .select(
            "station",
            F.col("station").alias("location"),
            F.concat(F.lit("river "), (F.col("k") % 2).cast("string")).alias("river"),
            F.array("station", "next_name").alias("upstream_stations"),
            F.col("places.n_name").alias("weather_locations"),
        )
    )


def river_dirty(spark, sf_dir) -> DataFrame:
    """The river with NULL levels on every 13th and doubled rows, later by load_seq, every 50 days."""
    base = river(spark, sf_dir)
    level = F.when(F.dayofmonth("date") != 13, F.col("level_m"))
    copies = base.filter(F.dayofyear("date") % 50 == 0)
    return base.select("location_name", "date", level.alias("level_m"), F.lit(1).alias("load_seq")).unionByName(
        copies.select("location_name", "date", (F.col("level_m") + 0.5).alias("level_m"), F.lit(2).alias("load_seq"))
    )


def levels_filled(spark, sf_dir) -> DataFrame:
    return series.fill_missing_levels(levels(spark, sf_dir), BEGIN, END)


def rain_filled(spark, sf_dir) -> DataFrame:
    return series.fill_missing_weather(rain(spark, sf_dir), BEGIN, END)


def rain_daily(spark, sf_dir) -> DataFrame:
    """The weather without holes up to the last day on record."""
    rows = rain(spark, sf_dir)
    last = rows.agg(F.max("date")).first()[0]
    return series.fill_missing_weather(rows, BEGIN, last or END)


def rain_forecast(spark, sf_dir) -> DataFrame:
    """Weather from 2001-06-01 on with sums one higher, as a forecast."""
    rows = rain(spark, sf_dir, begin="2001-06-01")
    return rows.withColumn("precipitation_sum", F.col("precipitation_sum") + 1)


def predictions(spark, sf_dir) -> DataFrame:
    """Predictions for every day by two model types, horizon 7; risk known on odd days, partly in capitals."""
    days = river(spark, sf_dir)
    dim = stations(spark, sf_dir)
    day = F.dayofmonth("date")
    kind = F.when(F.dayofyear("date") % 2 == 0, "XGBoost_001").otherwise("Prophet_001")
    band = risk.risk_band("level_m")
    known = F.when(day % 2 == 0, F.lit(None)).when(day % 3 == 0, F.upper(band)).otherwise(band)
    offset = F.substring("station_number", 3, 9).cast("long") * 100000
    return days.join(dim, F.col("location_name") == F.col("station_name")).select(
        (offset + F.datediff("date", F.lit(BEGIN))).alias("id"),
        "location_name",
        "date",
        "level_m",
        "station_number",
        model_name(F.lit("Preprocessor_001"), F.lit(7), kind, F.col("location_name")).alias("ml_model_name"),
        F.lit(7).alias("forecast_days"),
        known.alias("risk_level"),
        F.lit(dt.date(2001, 1, 1)).alias("created_at"),
        F.lit(dt.date(2001, 1, 1)).alias("updated_at"),
    )


def river_gappy(spark, sf_dir) -> DataFrame:
    """The river without every third day of the year."""
    return river(spark, sf_dir).filter(F.dayofyear("date") % 3 != 0)


def secondary(spark, sf_dir) -> DataFrame:
    """A second source keyed by station id, without the last days of a month, partly NULL."""
    dim = stations(spark, sf_dir).select("station_name", F.substring("station_number", 3, 9).cast("int").alias("station_id"))
    rows = river(spark, sf_dir).filter(F.dayofmonth("date") <= 25)
    return rows.join(dim, F.col("location_name") == F.col("station_name")).select(
        "station_id", F.col("date").alias("reading_date"), F.when(F.dayofmonth("date") != 20, F.col("level_m")).alias("reading")
    )


def sensors(spark, sf_dir) -> DataFrame:
    """Text sensor values with the usual placeholders."""
    e = table(spark, sf_dir, "events")
    value = (
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), "---")
        .when(F.col("event_id") % 50 == 0, " 0")
        .when(F.col("event_id") % 71 == 0, "")
        .when(F.col("event_id") % 73 == 0, "NULL")
        .otherwise(F.col("event_id").cast("string"))
    )
    firmware = F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("fw"), (F.col("event_id") % 4).cast("string")))
    return e.select("event_id", value.alias("value"), F.col("ts").cast("timestamp").alias("reading_ts"), firmware.alias("firmware"))


def readings(spark, sf_dir) -> DataFrame:
    """Events as raw readings: several per series and day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("location"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value"
    )


def portal(spark, sf_dir) -> DataFrame:
    """Gauge portal export: a day's reading beside the one a year before."""
    now = river(spark, sf_dir)
    before = now.select("location_name", F.add_months("date", 12).alias("date"), F.col("level_m").alias("previousreadingvalue"))
    before = before.groupBy("location_name", "date").agg(F.max("previousreadingvalue").alias("previousreadingvalue"))
    return now.join(before, ["location_name", "date"], "left").select(
        "location_name", "date", "previousreadingvalue", F.col("level_m").alias("readingvalue")
    )
