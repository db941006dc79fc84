"""Landed JSON and HTML answers of weather and gauge services as rows.

Each answer is one input row and is unfolded where it lies, and the rows of one answer are bounded by
what the service puts in it (days of a year, rows of a page).  Answers are read as VARIANT: one that is
cut off, empty or of another shape gives no rows, stops no other, and is named with a reason by the
``rejected_…`` operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.functions.dates import parse_date, rewrite_year, utc_calendar_date
from thalweg.functions.numbers import nan_to_null, numeric_or_null
from thalweg.schema import DAILY_MEASURES, FORECAST_MEASURES, HOURLY_MEASURES


def parsed(column: str) -> Column:
    """The answer as a VARIANT, NULL where it is no JSON.  Services write NaN for a missing number, which JSON has no word for."""
    return F.coalesce(F.try_parse_json(column), F.try_parse_json(F.regexp_replace(column, r"(?<=[\[,:\s])NaN(?=[\],}\s])", "null")))


#: Steps of a time axis that an answer may have: a century of days, or eleven years of hours.
LONGEST_AXIS = 100_000


def _answers(payloads: DataFrame, keys: Sequence[str], block: str, measures: Sequence[str], column: str) -> DataFrame:
    """(keys, the answer's parts, reason): what is wrong with an answer, NULL where nothing is."""
    v = payloads.select(*keys, F.col(column).alias("_text"), parsed(column).alias("_v"))
    get = lambda path, kind: F.try_variant_get("_v", path, kind)
    parts = {"latitude": get("$.latitude", "double"), "longitude": get("$.longitude", "double"), "_block": get(f"$.{block}", "variant")}
    parts |= {f"_{name}": get(f"$.{block}.{name}", "bigint") for name in ("start", "end", "interval")}
    parts |= {m: get(f"$.{block}.{m}", "array<double>") for m in measures}
    opened = v.select(*keys, "_text", F.col("_v").isNotNull().alias("_json"), *[e.alias(n) for n, e in parts.items()])
    start, end, step = F.col("_start"), F.col("_end"), F.col("_interval")
    steps = F.when(step > 0, F.ceil((end - start) / step)).alias("_steps")
    sized = opened.select("*", steps)
    uneven = F.exists(F.array(*[F.size(m) for m in measures]), lambda n: n > F.col("_steps"))
    reason = (
        F.when(F.coalesce(F.trim("_text"), F.lit("")) == "", "empty")
        .when(~F.col("_json"), "no JSON")
        .when(F.col("_block").isNull(), f"no {block} block")
        .when(start.isNull() | end.isNull() | F.coalesce(step <= 0, F.lit(True)) | (end <= start), "no time axis")
        .when(F.col("_steps") > LONGEST_AXIS, "time axis too long")
        .when(uneven, "more values than times")
    )
    return sized.withColumn("reason", reason)


def rejected_weather(payloads: DataFrame, keys: Sequence[str] = ("location_name",), block: str = "daily", forecast: bool = False, column: str = "payload") -> DataFrame:
    """(keys, reason) of the weather answers that give no rows; they stop no other answer."""
    measures = HOURLY_MEASURES if block == "hourly" else FORECAST_MEASURES if forecast else DAILY_MEASURES
    return _answers(payloads, keys, block, measures, column).filter("reason IS NOT NULL").select(*keys, "reason")


def _unfold(payloads: DataFrame, keys: Sequence[str], block: str, measures: Sequence[str], column: str) -> DataFrame:
    """Parallel arrays over a time axis start..end, end left out, as rows; answers that can't be read give none."""
    # Not a filter: pushed below, it would read each answer again for every part of its reason.
    axis = F.when(F.col("reason").isNull(), F.sequence("_start", F.col("_end") - 1, F.col("_interval")))
    # A measure the answer lacks is NULL throughout.
    values = [F.coalesce(F.col(m), F.array().cast("array<double>")).alias(m) for m in measures]
    rows = _answers(payloads, keys, block, measures, column).select(
        *keys,
        F.col("latitude").alias("forecast_latitude"),
        F.col("longitude").alias("forecast_longitude"),
        F.inline(F.when(axis.isNotNull(), F.arrays_zip(axis.alias("at"), *values))),
    )
    stamped = rows.withColumn("ts", F.timestamp_seconds("at"))
    return stamped.select(*keys, "ts", "forecast_latitude", "forecast_longitude", *[nan_to_null(F.col(m)).alias(m) for m in measures])


def weather_daily(payloads: DataFrame, keys: Sequence[str] = ("location_name",), forecast: bool = False, column: str = "payload", tz: str | None = None) -> DataFrame:
    """Daily answers as rows by location and calendar day (UTC, or ``tz``).

    An answer carries the name of its location; the position in a batch has no meaning here.
    """
    measures = FORECAST_MEASURES if forecast else DAILY_MEASURES
    rows = _unfold(payloads, keys, "daily", measures, column)
    return rows.withColumn("date", utc_calendar_date("ts", tz)).select(*keys, "date", "forecast_latitude", "forecast_longitude", *measures)


def weather_hourly(payloads: DataFrame, keys: Sequence[str] = ("location_name",), attributes: DataFrame | None = None, column: str = "payload") -> DataFrame:
    """Hourly answers as rows, with the attributes of their station or district joined by name."""
    rows = _unfold(payloads, keys, "hourly", HOURLY_MEASURES, column)
    return rows if attributes is None else attach_attributes(rows, attributes, keys)


def attach_attributes(rows: DataFrame, attributes: DataFrame, keys: Sequence[str] = ("location_name",)) -> DataFrame:
    return rows.join(attributes, list(keys), "left")


# The field names of the chart answer.
_READING = "struct<readingValue: string, longtermMean: string, dateOfReadingStr: string>"
CHART_SCHEMA = (
    f"gaugeReadingList array<{_READING}>, "
    "indicator struct<moderateRiskLevelVal: string, highRiskLevelVal: string, bankFullVal: string>, "
    f"previous_year struct<gaugeReadingList: map<string, {_READING}>>"
)


def _chart(payloads: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, p, reason): the parsed chart, and what is wrong with it."""
    v = payloads.select(*keys, F.col(column).alias("_text"), parsed(column).alias("_v"))
    opened = v.select(*keys, "_text", F.col("_v").isNotNull().alias("_json"), F.try_variant_get("_v", "$", f"struct<{CHART_SCHEMA}>").alias("p"))
    now, before = F.col("p.gaugeReadingList"), F.col("p.previous_year.gaugeReadingList")
    reason = (
        F.when(F.coalesce(F.trim("_text"), F.lit("")) == "", "empty")
        .when(~F.col("_json"), "no JSON")
        .when(now.isNull() & before.isNull(), "no readings")
    )
    return opened.select(*keys, "p", reason.alias("reason"))


def rejected_charts(payloads: DataFrame, keys: Sequence[str] = ("location",), column: str = "payload") -> DataFrame:
    """(keys, reason) of the chart answers without anything to read."""
    return _chart(payloads, keys, column).filter("reason IS NOT NULL").select(*keys, "reason")


def gauge_chart(payloads: DataFrame, keys: Sequence[str] = ("location",), column: str = "payload") -> DataFrame:
    """Chart answers: each day of last year beside the same day of the current one.

    Last year's days drive, one row a day; the current year's reading is the last one of its day, or
    NULL.  Days that do not exist in the current year (29 February) are left out.  A year bounds both
    lists, so the match is made inside the row: both lists are sorted by day as one, and a day of last
    year looks at its neighbour.
    """
    charts = _chart(payloads, keys, column).filter("reason IS NULL")
    current = F.coalesce("p.gaugeReadingList", F.array().cast(f"array<{_READING}>"))
    previous = F.coalesce(F.map_values("p.previous_year.gaugeReadingList"), F.array().cast(f"array<{_READING}>"))
    year = F.get(F.split(F.get(current, F.lit(0))["dateOfReadingStr"], "-"), F.lit(2))
    entry = lambda day, old, i, r: F.struct(day.alias("day"), F.lit(old).alias("old"), i.alias("i"), r.alias("r"))
    now = F.transform("cur", lambda r, i: entry(r["dateOfReadingStr"], 0, i, r))
    then = F.transform("before", lambda r, i: entry(rewrite_year(r["dateOfReadingStr"], F.col("year")), 1, i, r))
    listed = charts.select(*keys, "p.indicator", current.alias("cur"), previous.alias("before"), year.alias("year"))
    merged = listed.select(*keys, "indicator", F.array_sort(F.concat(now, then)).alias("all"))
    beside = F.transform("all", lambda e, i: F.struct(e.alias("e"), F.get("all", i - 1).alias("left")))
    # The first of a day's entries of last year stands right behind the day's readings of this one.
    lead = F.filter(beside, lambda x: (x["e"]["old"] == 1) & ~F.coalesce((x["left"]["old"] == 1) & (x["left"]["day"] == x["e"]["day"]), F.lit(False)))
    each = merged.select(*keys, "indicator", F.inline(lead)).withColumn("hit", F.when((F.col("left.old") == 0) & (F.col("left.day") == F.col("e.day")), F.col("left.r")))
    return each.withColumn("date", parse_date("e.day", "dash")).filter(F.col("date").isNotNull()).select(
        *keys,
        "date",
        numeric_or_null("indicator.bankFullVal").alias("bankfull"),
        numeric_or_null("indicator.highRiskLevelVal").alias("highfloodrisk"),
        numeric_or_null("indicator.moderateRiskLevelVal").alias("moderatefloodrisk"),
        numeric_or_null("hit.longtermMean").alias("longtermmean"),
        numeric_or_null("e.r.readingValue").alias("previousreadingvalue"),
        numeric_or_null("hit.readingValue").alias("readingvalue"),
    )


def chart_entries(payloads: DataFrame, keys: Sequence[str] = ("location",), column: str = "payload") -> DataFrame:
    """Every entry of a chart answer, of the array and of the map: (keys, list, date, reading)."""
    charts = _chart(payloads, keys, column).filter("reason IS NULL")
    lists = {"current": F.col("p.gaugeReadingList"), "previous": F.map_values("p.previous_year.gaugeReadingList")}
    tagged = F.array(*[F.struct(F.lit(n).alias("list"), e.alias("entries")) for n, e in lists.items()])
    each = charts.select(*keys, F.inline(tagged)).select(*keys, "list", F.explode("entries").alias("e"))
    return each.select(*keys, "list", parse_date("e.dateOfReadingStr", "dash").alias("date"), numeric_or_null("e.readingValue").alias("reading"))


def _cells(row: Column) -> Column:
    """Texts of the cells of a table row."""
    raw = F.regexp_extract_all(row, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    return F.transform(raw, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", ""), r"\s+", " ")))


# The table of the gauge page and the headings read from it.
GAUGE_TABLE_ID = "maps-data-grid"
GAUGE_HEADINGS = {"location_name": "Station", "day": "Date", "level": "Observed River Level (m)"}


def gauge_table(pages: DataFrame, stations: DataFrame, keys: Sequence[str] = ("page_id",), column: str = "html", table_id: str = GAUGE_TABLE_ID, rows: int | None = None) -> DataFrame:
    """Latest levels from a page's table: the first row of each known station, among all rows or the first ``rows``.

    Columns are found by their headings.  A level that is no number is NULL; a date has to be
    written dd-MM-yyyy.
    """
    table = F.regexp_extract(column, rf'(?is)<table[^>]*id="{table_id}"[^>]*>(.*?)</table>', 1)
    lines = pages.select(*keys, F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)).alias("tr"))
    split = lines.select(*keys, _cells(F.get("tr", F.lit(0))).alias("head"), F.transform(F.slice("tr", F.lit(2), F.size("tr") if rows is None else F.lit(rows)), _cells).alias("body"))
    at = lambda row, name: F.get(row, F.array_position(F.col("head"), F.lit(name)).cast("int") - 1)
    records = F.transform("body", lambda r: F.struct(*[at(r, heading).alias(name) for name, heading in GAUGE_HEADINGS.items()]))
    paged = split.select(*keys, records.alias("records")).withColumn("_page", F.monotonically_increasing_id())
    found = paged.select(*keys, "_page", F.posexplode("records").alias("_at", "r"))
    known = stations.select("station_name").distinct()
    listed = found.join(known, F.col("r.location_name") == F.col("station_name"), "left_semi")
    # One grouping by position: linear in the page.
    first = listed.groupBy(*keys, "_page", F.col("r.location_name").alias("location_name")).agg(F.min_by("r", "_at").alias("r"))
    return first.select(*keys, "location_name", parse_date("r.day", "dash").alias("date"), numeric_or_null("r.level").alias("level_m"))


def json_records(payloads: DataFrame, list_name: str, fields: dict[str, str], keys: Sequence[str] = (), column: str = "payload") -> DataFrame:
    """The flat records of one named list in each answer.

    ``fields`` maps a record's names to ``string``, ``number`` or a date kind of ``DATE_FORMATS``;
    what cannot be read becomes NULL.  An answer that is no JSON or lacks the list gives no rows:
    ``rejected_records`` names it.
    """
    record = ", ".join(f"{name}: string" for name in fields)
    listed = F.try_variant_get(parsed(column), f"$.{list_name}", f"array<struct<{record}>>")
    rows = payloads.select(*keys, listed.alias("p")).select(*keys, F.inline("p"))

    def typed(name, kind):
        if kind == "string":
            return F.col(name)
        if kind == "number":
            return numeric_or_null(name).alias(name)
        return parse_date(name, kind).alias(name)

    return rows.select(*keys, *[typed(n, k) for n, k in fields.items()])


def rejected_records(payloads: DataFrame, list_name: str, keys: Sequence[str] = (), column: str = "payload") -> DataFrame:
    """(keys, reason) of the answers ``json_records`` can't read."""
    v = parsed(column)
    reason = (
        F.when(F.coalesce(F.trim(column), F.lit("")) == "", "empty")
        .when(v.isNull(), "no JSON")
        .when(F.try_variant_get(v, f"$.{list_name}", "array<variant>").isNull(), f"no list {list_name}")
    )
    return payloads.select(*keys, reason.alias("reason")).filter("reason IS NOT NULL")
