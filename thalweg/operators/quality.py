"""Availability, gaps, duplicates, outliers: what a table holds and what it lacks.

Reports are aggregates that combine on the map side; none brings table rows to the driver and none
caps what it looks at.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thalweg.functions.dates import as_date

# Texts that stand for a missing sensor value.
SENTINELS = ("---", "", "NULL")
# Time stamps outside these bounds cannot be readings.
TS_BOUNDS = (dt.datetime(1900, 1, 1), dt.datetime(2030, 1, 1))


def table_extent(df: DataFrame, key: str = "location_name", date: str = "date") -> DataFrame:
    """Rows, first and last day, number of locations.

    Locations are counted through a grouping, so the distinct count has a row per location to merge.
    """
    per = df.groupBy(key).agg(F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.count(key).alias("locations"),
    )


def availability(df: DataFrame, key: str = "location_name", date: str = "date") -> DataFrame:
    """Per location: first and last day, rows, days with a row, and last - first in days.

    Two groupings: the first, on location and day, spreads a hot location over its days.
    """
    days = df.groupBy(key, date).agg(F.count("*").alias("n"))
    return days.groupBy(key).agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.sum("n").alias("records"),
        F.count("*").alias("distinct_days"),
        F.datediff(F.max(date), F.min(date)).alias("date_range"),
    )


def gap_counts(avail: DataFrame) -> DataFrame:
    """Days expected between first and last, and how many of them have no row.

    Counts days and not rows, so duplicates do not hide a gap.
    """
    expected = (F.col("date_range") + 1).cast("long")
    return avail.withColumns({"expected_days": expected, "gap_days": expected - F.col("distinct_days")})


def common_range(avail: DataFrame) -> DataFrame:
    """The range in which every location has begun and none has ended."""
    return avail.agg(F.max("first_date").alias("safe_start"), F.min("last_date").alias("safe_end"))


def limited_or_stale(avail: DataFrame, as_of, min_days: int = 30, max_age: int = 7) -> DataFrame:
    """Locations with a short record, or one that ended more than ``max_age`` days ago."""
    flagged = avail.withColumns(
        {
            "days_old": F.datediff(as_date(as_of), F.col("last_date")),
            "limited": F.col("date_range") < min_days,
        }
    ).withColumn("stale", F.col("days_old") > max_age)
    return flagged.filter(F.col("limited") | F.col("stale"))


def last_date_per_location(df: DataFrame, value: str | None = None, key: str = "location_name") -> DataFrame:
    rows = df if value is None else df.filter(F.col(value).isNotNull())
    return rows.groupBy(key).agg(F.max("date").alias("last_date"))


def fetch_window(df: DataFrame, as_of, date: str = "date", look_back: int = 3650) -> DataFrame:
    """The days to fetch next: from the day after the newest row to yesterday.

    An empty table is filled from ``look_back`` days before yesterday.
    """
    end = F.date_sub(as_date(as_of), 1)
    top = df.agg(F.max(F.col(date).cast("date")).alias("max_date"))
    start = F.coalesce(F.date_add("max_date", 1), F.date_sub(end, look_back))
    bounds = top.select("max_date", start.alias("start_date"), end.alias("end_date"))
    return bounds.withColumn("needed", F.col("start_date") <= F.col("end_date"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str] = ("location", "date")) -> DataFrame:
    """The frame itself, or ValueError naming a key it holds twice: the check that it is a series."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"{found[0]['n']} rows for {[str(found[0][k]) for k in keys]}: deduplicate first")
    return df


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for columns that have any."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _tall(counts, df.columns, "column", "nulls").filter("nulls > 0")


def _tall(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """A one-row frame of counts as (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("long").alias(value)) for c in columns])
    return one_row.select(F.inline(pairs))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in all columns."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if _is_number(f)]


def zscore_outliers(df: DataFrame, columns: Sequence[str] | None = None, limit: float = 3.0) -> DataFrame:
    """(column, outliers): values further than ``limit`` sample deviations from the mean.

    Mean and deviation come from a first pass as scalar subqueries; a constant column has none.
    """
    columns = list(columns or numeric_columns(df))
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, outliers long")
    stats = F.struct(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in columns])
    known = df.agg(stats.alias("s")).scalar()
    marked = df.select(*columns, known.alias("_s"))
    counts = marked.agg(
        *[F.count_if(F.abs(F.try_divide(F.col(c) - F.col(f"_s.{c}.mean"), F.col(f"_s.{c}.sd"))) > limit).alias(c) for c in columns]
    )
    return _tall(counts, columns, "column", "outliers")


def sensor_checks(df: DataFrame) -> DataFrame:
    """(check, n) over text sensor readings: sentinels, zeros, impossible times, no firmware."""
    lower, upper = (F.lit(t.isoformat(sep=" ")).cast("timestamp") for t in TS_BOUNDS)
    checks: dict[str, Column] = {
        "rows": F.count("*"),
        "null_value": F.count_if(F.col("value").isNull()),
        "sentinel_value": F.count_if(F.col("value").isin(*SENTINELS)),
        "zero_value": F.count_if(F.trim("value") == "0"),
        "timestamp_out_of_bounds": F.count_if((F.col("reading_ts") < lower) | (F.col("reading_ts") > upper)),
        "null_firmware": F.count_if(F.col("firmware").isNull()),
    }
    one = df.agg(*[e.alias(n) for n, e in checks.items()])
    return _tall(one, list(checks), "check", "n")


def sensor_time_range(df: DataFrame) -> DataFrame:
    lower, upper = (F.lit(t.isoformat(sep=" ")).cast("timestamp") for t in TS_BOUNDS)
    span = df.agg(F.min("reading_ts").alias("min_ts"), F.max("reading_ts").alias("max_ts"))
    return span.withColumn("valid", (F.col("min_ts") >= lower) & (F.col("max_ts") <= upper))


def table_quality_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(check, column, n): nulls, duplicate rows and outliers of the whole table."""
    nulls = null_profile(df).select(F.lit("nulls").alias("check"), "column", F.col("nulls").alias("n"))
    dups = duplicate_rows(df).select(
        F.lit("duplicate_rows").alias("check"), F.lit(None).cast("string").alias("column"), F.col("duplicate_rows").alias("n")
    )
    far = zscore_outliers(df, columns).select(F.lit("outliers").alias("check"), "column", F.col("outliers").alias("n"))
    return nulls.unionByName(dups).unionByName(far.filter("n > 0"))


def missing_locations(requested: DataFrame, data: DataFrame, key: str = "location") -> DataFrame:
    """Requested locations without a row."""
    return requested.select(key).distinct().join(data.select(key).distinct(), key, "left_anti")


def require_locations(requested: DataFrame, data: DataFrame, key: str = "location") -> None:
    """Raise where a requested location has no row, naming the first few."""
    lacking = [r[0] for r in missing_locations(requested, data, key).limit(5).collect()]
    if lacking:
        raise ValueError(f"no data for locations: {sorted(lacking)}")


def year_coverage(df: DataFrame, year: int) -> DataFrame:
    """Rows in a year and the two before it, distinct days and bounds."""
    days = df.groupBy("date").agg(F.count("*").alias("n"))
    in_year = lambda y: F.coalesce(F.sum(F.when(F.year("date") == y, F.col("n"))), F.lit(0))
    return days.agg(
        in_year(year).alias("current_year"),
        in_year(year - 1).alias("past_year"),
        in_year(year - 2).alias("year_before"),
        F.count("*").alias("distinct_dates"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def coverage_status(wanted: DataFrame, data: DataFrame, key: str = "location") -> DataFrame:
    """Every wanted location with its row count, last day and OK / MISSING."""
    per = data.groupBy(key).agg(F.count("*").alias("n"), F.max("date").alias("last_date"))
    joined = wanted.select(key).distinct().join(per, key, "left")
    return joined.select(
        key, F.coalesce("n", F.lit(0)).alias("n"), "last_date", F.when(F.col("n") > 0, "OK").otherwise("MISSING").alias("status")
    )


def recent_counts(df: DataFrame, as_of, days: int = 7, key: str = "location") -> DataFrame:
    return df.filter(F.col("date") >= F.date_sub(as_date(as_of), days)).groupBy(key).agg(F.count("*").alias("n"))
