"""Scalar functions, orderings, set operations, indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import oracle
from thalweg.functions import dates, numbers, text
from thalweg.operators import features, indicators, quality, series, state
from thalweg.sources import tables


@query("sort_location_date", oracle("levels", "SELECT * FROM levels ORDER BY location, date"))
def sort_location_date(spark, sf):
    return fx.levels(spark, sf).orderBy("location", "date")


@query(
    "first_n_rows",
    oracle("levels", "SELECT location, date, level__m FROM (SELECT *, row_number() OVER (PARTITION BY location ORDER BY date) AS rn FROM levels) WHERE rn <= 7"),
)
def first_n_rows(spark, sf):
    ranked = fx.levels(spark, sf).withColumn("rn", F.row_number().over(series.by_day()))
    return ranked.filter("rn <= 7").drop("rn")


@query(
    "latest_entry",
    oracle("rain", "SELECT location, max(date) AS date, arg_max(precipitation_sum, date) AS precipitation_sum FROM rain GROUP BY ALL"),
)
def latest_entry(spark, sf):
    return fx.rain(spark, sf).groupBy("location").agg(F.max("date").alias("date"), F.max_by("precipitation_sum", "date").alias("precipitation_sum"))


@query("capped_scan", oracle("sensors", "SELECT count(*) AS rows_checked, count(*) FILTER (WHERE firmware IS NULL) AS null_firmware FROM sensors"))
def capped_scan(spark, sf):
    """The validator without its cap: every row is looked at, in one pass."""
    return fx.sensors(spark, sf).agg(F.count("*").alias("rows_checked"), F.count_if(F.col("firmware").isNull()).alias("null_firmware"))


@query("ordered_listing", oracle("preds", "SELECT DISTINCT location_name, forecast_days, split_part(ml_model_name, '-', 3) AS model_type FROM preds ORDER BY ALL"))
def ordered_listing(spark, sf):
    parts = text.parse_model_name("ml_model_name")
    rows = fx.predictions(spark, sf).select("location_name", parts["forecast_days"].alias("forecast_days"), parts["model_type"].alias("model_type"))
    return rows.distinct().orderBy("location_name", "forecast_days", "model_type")


@query("union_frames", oracle("levels", "SELECT location, date, level__m FROM levels WHERE year(date) <= 1999 UNION ALL SELECT location, date, level__m FROM levels WHERE year(date) > 1999"))
def union_frames(spark, sf):
    levels = fx.levels(spark, sf)
    late = levels.filter(F.year("date") > 1999).select("level__m", "date", "location")
    return levels.filter(F.year("date") <= 1999).unionByName(late)


@query("set_difference", oracle("rain levels", "SELECT DISTINCT date FROM rain EXCEPT SELECT date FROM levels"))
def set_difference(spark, sf):
    present = fx.levels(spark, sf).select("date").distinct()
    return fx.rain(spark, sf).select("date").distinct().join(present, "date", "left_anti")


@query("distinct_values", oracle("edges_wx", "SELECT DISTINCT location FROM edges_wx"))
def distinct_values(spark, sf):
    return features.edges(fx.station_mapping(spark, sf), "weather_locations").select("location").distinct()


@query(
    "inference_grid",
    oracle(
        "stations",
        """SELECT station_name AS station, forecast_days, model_type FROM stations CROSS JOIN (SELECT unnest([1, 3, 7]) AS forecast_days)
CROSS JOIN (SELECT unnest(['XGBoost_001', 'Prophet_001']) AS model_type)""",
    ),
)
def inference_grid(spark, sf):
    from thalweg.plans.inference import inference_grid as grid

    return grid(fx.stations(spark, sf).select(F.col("station_name").alias("station")), [1, 3, 7], ["XGBoost_001", "Prophet_001"])


@query(
    "attach_attributes",
    oracle(
        "rain",
        """SELECT location AS location_name, date, precipitation_sum, r_name AS region FROM rain JOIN nation ON n_name = location JOIN region ON n_regionkey = r_regionkey""",
    ),
)
def attach_attributes(spark, sf):
    from thalweg.sources.payloads import attach_attributes as attach

    nation = fx.table(spark, sf, "nation").join(fx.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = nation.select(F.col("n_name").alias("location_name"), F.col("r_name").alias("region"))
    return attach(fx.weather(spark, sf).drop("precipitation_hours"), names)


@query(
    "date_parse_formats",
    oracle(
        "levels",
        """SELECT location, date, CASE CAST(day(date) AS INTEGER) % 6 WHEN 4 THEN CAST(date_trunc('month', date) AS DATE) WHEN 5 THEN NULL ELSE date END AS parsed FROM levels""",
    ),
)
def date_parse_formats(spark, sf):
    """Dates written in every known format, and one that is no date, read back."""
    kind = F.dayofmonth("date") % 6
    written = (
        F.when(kind == 0, F.date_format("date", "yyyy-MM-dd"))
        .when(kind == 1, F.date_format("date", "dd/MM/yyyy"))
        .when(kind == 2, F.date_format("date", "dd-MM-yyyy"))
        .when(kind == 3, F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 21:00:00+00:00")))
        .when(kind == 4, F.date_format("date", "MMM-yyyy"))
        .otherwise("31-02-2001")
    )
    return fx.levels(spark, sf).select("location", "date", dates.parse_date_any(written).alias("parsed"))


@query(
    "date_arithmetic",
    oracle(
        "levels",
        """SELECT location, date, CAST(date + 6 AS DATE) AS target, CAST(date - INTERVAL 12 MONTH AS DATE) AS year_before,
  CAST(date_trunc('month', CAST(date_trunc('month', date) AS DATE) - 182) AS DATE) AS half_year_before, CAST(date - 7 AS DATE) AS week_before FROM levels""",
    ),
)
def date_arithmetic(spark, sf):
    return fx.levels(spark, sf).select(
        "location",
        "date",
        dates.target_date("date", 7).alias("target"),
        dates.previous_year("date").alias("year_before"),
        dates.half_year_before(F.trunc("date", "month")).alias("half_year_before"),
        F.date_sub("date", 7).alias("week_before"),
    )


@query("normalise_name", oracle("levels", "SELECT DISTINCT location, replace(lower(location), ' ', '_') AS prefix FROM levels"))
def normalise_name(spark, sf):
    return fx.levels(spark, sf).select("location", text.normalise_name(F.col("location")).alias("prefix")).distinct()


@query(
    "year_rewrite",
    oracle(
        "levels",
        "SELECT location, date, strftime(date, '%d-%m-') || '2001' AS text, try_cast('2001' || strftime(date, '-%m-%d') AS DATE) AS rewritten FROM levels",
    ),
)
def year_rewrite(spark, sf):
    moved = dates.rewrite_year(F.date_format("date", "dd-MM-yyyy"), F.lit(2001))
    return fx.levels(spark, sf).select("location", "date", moved.alias("text"), dates.parse_date(moved, "dash").alias("rewritten"))


@query("numeric_or_null", oracle("sensors", "SELECT event_id, try_cast(trim(value) AS DOUBLE) AS number FROM sensors"))
def numeric_or_null(spark, sf):
    return fx.sensors(spark, sf).select("event_id", numbers.numeric_or_null("value").alias("number"))


@query(
    "iso_week",
    oracle("levels", "SELECT location, CAST(weekofyear(date) AS INTEGER) AS week_number, CAST(isoyear(date) AS INTEGER) AS week_year, count(*) AS days FROM levels GROUP BY ALL"),
)
def iso_week(spark, sf):
    week = dates.iso_week("date")
    return fx.levels(spark, sf).groupBy("location", *[e.cast("int").alias(n) for n, e in week.items()]).agg(F.count("*").alias("days"))


@query(
    "model_name_codec",
    oracle(
        "preds",
        """SELECT 'Preprocessor_001' AS preprocessor_type, 7 AS forecast_days, split_part(ml_model_name, '-', 3) AS model_type, location_name AS station,
  ml_model_name AS rebuilt, count(*) AS n FROM preds GROUP BY ALL""",
    ),
)
def model_name_codec(spark, sf):
    named = fx.predictions(spark, sf).withColumn("file", F.concat("ml_model_name", F.lit(".joblib")))
    parts = text.parse_model_name("file")
    rows = named.select(*[e.alias(n) for n, e in parts.items()])
    rebuilt = text.model_name(*[F.col(c) for c in ("preprocessor_type", "forecast_days", "model_type", "station")])
    return rows.withColumn("rebuilt", rebuilt).groupBy(*rows.columns, "rebuilt").agg(F.count("*").alias("n"))


@query(
    "direction_text",
    oracle(
        "levels",
        """SELECT direction, count(*) AS n FROM (SELECT CASE WHEN y > 0.5 THEN 'up' WHEN y < -0.5 THEN 'down' WHEN y IS NOT NULL THEN 'unchanged' END AS direction FROM (
  SELECT level__m - lag(level__m, 1) OVER (PARTITION BY location ORDER BY date) AS y FROM levels)) GROUP BY ALL""",
    ),
)
def direction_text(spark, sf):
    """Differences to the nearest metre and more, in words; the sign word is counted."""
    rows = series.target_difference(series.station_lags(fx.levels(spark, sf), [1]), 1)
    step = F.when(F.abs("y") <= 0.5, 0.0).otherwise(F.col("y"))
    words = rows.select(F.split(text.direction_text(step), " ")[0].alias("direction"))
    return words.groupBy("direction").agg(F.count("*").alias("n"))


@query(
    "sigmoid_weight",
    oracle(
        "river stations",
        """SELECT location_name, date, round(CASE WHEN level_m >= high THEN 1.0 ELSE 1 / (1 + exp(-2.0 * (level_m - moderate))) END, 9) AS weight
FROM river JOIN stations ON location_name = station_name""",
    ),
)
def sigmoid_weight(spark, sf):
    river, dim = fx.river(spark, sf), fx.stations(spark, sf)
    joined = river.join(dim, river["location_name"] == dim["station_name"])
    return joined.select("location_name", "date", F.round(numbers.sigmoid_weight("level_m", "moderate", "high"), 9).alias("weight"))


MONTHLY = """SELECT r_name AS region, location AS district, CAST(date_trunc('month', date) AS DATE) AS month, sum(precipitation_sum) AS value
FROM rain JOIN nation ON n_name = location JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


def month_labels(first, last):
    """The names of all months from one day's to another's, in order."""
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    return [dt.date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1).strftime("%b-%Y") for i in range(count)]


def monthly(spark, sf, begin=None, end=None):
    nation = fx.table(spark, sf, "nation").join(fx.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = fx.rain(spark, sf, begin, end).join(nation, F.col("location") == F.col("n_name"))
    return rows.groupBy(F.col("r_name").alias("region"), F.col("location").alias("district"), F.trunc("date", "month").alias("month")).agg(
        F.sum("precipitation_sum").alias("value")
    )


TURN = dt.date(2001, 1, 1)


def month_span(spark, sf):
    """The first and the last day on record, the turn of 2001 among them."""
    span = fx.rain(spark, sf).agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    return min(span["first"] or TURN, TURN), max(span["last"] or TURN, TURN)


def period_tables(spark, sf):
    """All months in two tables that overlap in one, the newer one first; its copy differs."""
    first, last = month_span(spark, sf)
    late = indicators.pivot_months(monthly(spark, sf, TURN), month_labels(TURN, last))
    early = monthly(spark, sf, end="2001-01-31")
    early = early.withColumn("value", F.when(F.col("month") < "2001-01-01", F.col("value")).otherwise(F.lit(-1.0)))
    return late, indicators.pivot_months(early, month_labels(first, TURN))


INDICATOR = """SELECT region, district, value, month, 'rainfall' AS indicator FROM monthly"""


@query("unpivot_months", oracle("rain", INDICATOR, monthly=MONTHLY))
def unpivot_months(spark, sf):
    wide = indicators.pivot_months(monthly(spark, sf), month_labels(*month_span(spark, sf)))
    return indicators.unpivot_months(wide, "rainfall")


@query("outer_merge_periods", oracle("rain", INDICATOR, monthly=MONTHLY))
def outer_merge_periods(spark, sf):
    return indicators.merge_periods(period_tables(spark, sf), "rainfall")


@query("region_filter", oracle("rain", INDICATOR + " WHERE region IN ('ASIA', 'EUROPE', 'AFRICA')", monthly=MONTHLY))
def region_filter(spark, sf):
    return indicators.keep_regions(indicators.merge_periods(period_tables(spark, sf), "rainfall"), ["ASIA", "EUROPE", "AFRICA"])


@query(
    "column_select_by_pattern",
    oracle(
        "rain",
        "SELECT region, district, sum(value) FILTER (WHERE month = DATE '2001-01-01') AS \"Jan-2001\", sum(value) FILTER (WHERE month = DATE '2001-02-01') AS \"Feb-2001\" FROM monthly WHERE month >= DATE '2001-01-01' GROUP BY ALL",
        monthly=MONTHLY,
    ),
)
def column_select_by_pattern(spark, sf):
    wide = period_tables(spark, sf)[0].select("district", "region", "`Feb-2001`", "`Jan-2001`", F.col("`Mar-2001`").alias("Mar-2001_old"))
    return indicators.select_months(wide)


@query(
    "indicator_history",
    oracle(
        "rain",
        "SELECT region, district, value, month, indicator FROM (" + INDICATOR + ") WHERE region IN ('ASIA', 'EUROPE')",
        monthly=MONTHLY,
    ),
)
def indicator_history(spark, sf):
    """Merge the periods, keep regions, insert with conflicts ignored over what was stored before."""
    rows = indicators.keep_regions(indicators.merge_periods(period_tables(spark, sf), "rainfall"), ["ASIA", "EUROPE"])
    stored = rows.filter(F.col("month") >= "2001-01-01")
    return state.insert_ignore(stored, rows, state.INDICATOR_KEY)


@query("date_slice_eval", oracle("levels", "SELECT * FROM levels WHERE (date >= DATE '2000-10-01' AND date < DATE '2000-12-01') OR (date >= DATE '2001-04-01' AND date < DATE '2001-06-01')"))
def date_slice_eval(spark, sf):
    from thalweg.operators.evaluation import date_slice

    levels = fx.levels(spark, sf)
    return date_slice(levels, "2000-10-01", "2000-12-01").unionByName(date_slice(levels, "2001-04-01", "2001-06-01"))
