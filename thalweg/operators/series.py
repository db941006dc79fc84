"""Operators on daily series: deduplicate, shift, fill, find gaps.

A *series* is key-unique on (location, date).  ``dedup_keep_last`` makes one out of any table; it
is an aggregate, so a location that owns a third of all rows is combined before the shuffle and
spread over its days after it.  All windows below are partitioned by location and run on series
only: a group holds at most one row per calendar day (36,525 in a century).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date, day_range
from thalweg.operators.daymaps import day_map, missing_days

LEVEL = "level__m"
RAIN = ("precipitation_sum", "precipitation_hours")


def by_day(key: str = "location", date: str = "date"):
    return Window.partitionBy(key).orderBy(date)


def dedup_keep_last(df: DataFrame, keys: Sequence[str] = ("location", "date"), recency: Sequence[str] = ("load_seq",)) -> DataFrame:
    """One row per key: the one with the greatest recency.

    The other columns break ties, so the outcome never depends on the order in which rows arrive.
    """
    order = [*recency, *[c for c in df.columns if c not in keys and c not in recency]]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_row"))
    return newest.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedup_latest_of_day(df: DataFrame, key: str = "location", ts: str = "ts") -> DataFrame:
    """Per location and calendar day the row with the greatest timestamp (then the greatest rest)."""
    day = df.withColumn("_day", F.col(ts).cast("date"))
    return dedup_keep_last(day, (key, "_day"), (ts,)).drop("_day")


def duplicate_days(df: DataFrame, key: str = "location", ts: str = "ts") -> DataFrame:
    """The (location, day) pairs ``dedup_latest_of_day`` would thin out: its dry run."""
    counts = df.groupBy(key, F.col(ts).cast("date").alias("date")).agg(F.count("*").alias("n"))
    return counts.filter("n > 1")


def shift_name(lag: int, column: str) -> str:
    """``lag07__x`` looks back 7 rows; ``forecast01__x`` is the same day, ``forecast03__x`` two ahead."""
    return f"lag{lag:02d}__{column}" if lag > 0 else f"forecast{1 - lag:02d}__{column}"


def shifted(
    df: DataFrame,
    columns: Sequence[str],
    lags: Iterable[int],
    key: str = "location",
    date: str = "date",
    calendar: bool = False,
) -> dict[str, Column]:
    """Lag and lead columns by name.  All share one window: one shuffle and one sort in all.

    The shift counts rows, as a missing day does not leave a hole: ``lag01`` is the previous day on
    record.  ``calendar=True`` counts days and gives NULL where that day is not on record.
    """
    rows = by_day(key, date)
    days = Window.partitionBy(key).orderBy(F.unix_date(date))
    out = {}
    for lag in lags:
        for c in columns:
            if calendar:
                out[shift_name(lag, c)] = F.max(c).over(days.rangeBetween(-lag, -lag))
            else:
                out[shift_name(lag, c)] = F.lag(c, lag).over(rows) if lag > 0 else F.lead(c, -lag).over(rows)
    return out


def station_lags(df: DataFrame, lags: Sequence[int], only_lag_columns: bool = False, calendar: bool = False, key: str = "location") -> DataFrame:
    """Levels with ``lagNN__level__m`` for every lag."""
    keep = [c for c in df.columns if not (only_lag_columns and c == LEVEL)]
    lagged = shifted(df, [LEVEL], lags, key=key, calendar=calendar)
    return df.select(*keep, *[e.alias(n) for n, e in lagged.items()])


def weather_shifts(df: DataFrame, lags: Sequence[int], calendar: bool = False, key: str = "location") -> DataFrame:
    """Location and date with the lags (> 0) and leads (<= 0) of both precipitation columns."""
    typed = df.select(key, "date", *[F.col(c).cast("double").alias(c) for c in RAIN])
    moved = shifted(typed, RAIN, lags, key=key, calendar=calendar)
    return typed.select(key, "date", *[e.alias(n) for n, e in moved.items()])


def cut_first(df: DataFrame, k: int, key: str = "location", date: str = "date") -> DataFrame:
    """Drop the first ``k`` rows of every series (none for k <= 0)."""
    if k <= 0:
        return df
    return df.withColumn("_rn", F.row_number().over(by_day(key, date))).filter(F.col("_rn") > k).drop("_rn")


def carried(column: str, key: str = "location", date: str = "date") -> Column:
    """The last value up to and including this row."""
    frame = by_day(key, date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(column, ignorenulls=True).over(frame)


def first_value(column: str, key: str = "location", date: str = "date") -> Column:
    """The first value of the series, which is the next one seen from any leading NULL.

    A whole-partition frame is evaluated once; a frame that ends at the last row and starts at the
    current one would be evaluated for every row anew.
    """
    frame = by_day(key, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(column, ignorenulls=True).over(frame)


def fill_values(df: DataFrame, columns: Sequence[str], leading: float | None = None, key: str = "location", date: str = "date") -> DataFrame:
    """Fill NULLs with the last value; leading NULLs with ``leading``, or with the first value."""
    out = {}
    for c in columns:
        rest = first_value(c, key, date) if leading is None else F.lit(float(leading))
        out[c] = F.coalesce(carried(c, key, date), rest)
    return df.withColumns(out)


def fill_missing_days(
    df: DataFrame,
    columns: Sequence[str],
    begin,
    end,
    leading: float | None = None,
    key: str = "location",
    date: str = "date",
    locations: DataFrame | None = None,
) -> DataFrame:
    """Give every location a row for each day begin..end and fill all values.

    Rows outside the range stay.  Each row generates the missing days up to the next row, carrying
    its filled value with it, and the first row those before it; so spine, join and fill take one
    shuffle and one sort together.  ``locations`` adds locations that have no row at all; their
    values are ``leading``.
    """
    begin, end = as_date(begin), as_date(end)
    w = by_day(key, date)
    last = {c: F.coalesce(carried(c, key, date), first_value(c, key, date) if leading is None else F.lit(float(leading))) for c in columns}
    staged = df.select(
        key,
        date,
        *[e.alias(c) for c, e in last.items()],
        F.lead(date).over(w).alias("_next"),
        F.row_number().over(w).alias("_rn"),
    )
    before = F.when(F.col("_rn") == 1, day_range(begin, F.least(F.date_sub(date, 1), end))).otherwise(F.array().cast("array<date>"))
    after = day_range(F.greatest(F.date_add(date, 1), begin), F.least(F.coalesce(F.date_sub("_next", 1), end), end))
    days = F.concat(before, F.array(F.col(date)), after)
    filled = staged.withColumn("_day", F.explode(days))
    values = []
    for c in columns:
        if leading is None:
            values.append(F.col(c))
        else:
            ahead = (F.col("_rn") == 1) & (F.col("_day") < F.col(date))
            values.append(F.when(ahead, F.lit(float(leading))).otherwise(F.col(c)).alias(c))
    out = filled.select(key, F.col("_day").alias(date), *values)
    if locations is None:
        return out
    blank = [F.lit(leading).cast("double").alias(c) for c in columns]
    absent = locations.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")
    return out.unionByName(absent.select(key, F.explode(day_range(begin, end)).alias(date), *blank))


def fill_missing_levels(df: DataFrame, begin, end, locations: DataFrame | None = None) -> DataFrame:
    """Daily levels without holes: forward fill, then backward for the head."""
    return fill_missing_days(df.select("location", "date", LEVEL), [LEVEL], begin, end, None, locations=locations)


def fill_missing_weather(df: DataFrame, begin, end, locations: DataFrame | None = None) -> DataFrame:
    """Daily weather without holes: forward fill, then zero for the head."""
    return fill_missing_days(df.select("location", "date", *RAIN), list(RAIN), begin, end, 0.0, locations=locations)


def missing_dates(df: DataFrame, begin, end, key: str = "location", date: str = "date", value: str | None = None, locations: DataFrame | None = None) -> DataFrame:
    """(location, date) for every day in the range without a row (without a value, given ``value``).

    Each location's days are a bitmap: it merges on the map side and has a fixed size, so no spine is
    joined and hot locations cost no more than others.
    """
    begin, end = as_date(begin), as_date(end)
    day = F.when(F.col(value).isNotNull(), F.col(date)) if value else F.col(date)
    # One pass: a location whose rows all lie outside the range is still asked about.
    days = df.groupBy(key).agg(day_map(day, begin, end).alias("_seen"))
    if locations is not None:
        days = locations.select(key).distinct().join(days, key, "left")
    return days.select(key, F.explode(missing_days(F.col("_seen"), begin, end)).alias(date))


def missing_dates_overall(df: DataFrame, begin, end, date: str = "date") -> DataFrame:
    """Days of the range on which no location at all has a row."""
    days = df.agg(day_map(date, begin, end).alias("_seen"))
    return days.select(F.explode(missing_days(F.col("_seen"), begin, end)).alias(date))


def gap_islands(missing: DataFrame, key: str = "location", date: str = "date") -> DataFrame:
    """Runs of consecutive missing days as (start, end, days)."""
    run = F.date_sub(date, F.row_number().over(by_day(key, date)))
    return (
        missing.withColumn("_run", run)
        .groupBy(key, "_run")
        .agg(F.min(date).alias("gap_start"), F.max(date).alias("gap_end"), F.count("*").alias("days"))
        .drop("_run")
    )


def gaps_between(df: DataFrame, begin, end, key: str = "location", date: str = "date") -> DataFrame:
    """The same runs straight from the series: every step of more than a day is one gap.

    Lists no single missing day, so its cost does not grow with the length of the gaps.
    """
    begin, end = as_date(begin), as_date(end)
    w = by_day(key, date)
    steps = df.filter(F.col(date).between(begin, end)).select(
        key,
        F.col(date).alias("_day"),
        F.lead(date).over(w).alias("_next"),
        F.row_number().over(w).alias("_rn"),
    )
    span = lambda first, last: F.struct(first.alias("gap_start"), last.alias("gap_end"))
    head = F.when((F.col("_rn") == 1) & (F.col("_day") > begin), span(begin, F.date_sub("_day", 1)))
    rest = F.when(
        F.date_add("_day", 1) <= F.coalesce(F.date_sub("_next", 1), end),
        span(F.date_add("_day", 1), F.coalesce(F.date_sub("_next", 1), end)),
    )
    gaps = steps.select(key, F.explode(F.array_compact(F.array(head, rest))).alias("_gap"))
    return gaps.select(
        key, "_gap.gap_start", "_gap.gap_end", (F.datediff("_gap.gap_end", "_gap.gap_start") + 1).cast("long").alias("days")
    )


def history_then_forecast(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """History followed by forecast; on a day both have, the forecast wins."""
    both = history.withColumn("source_rank", F.lit(1)).unionByName(forecast.withColumn("source_rank", F.lit(2)))
    return dedup_keep_last(both, ("location", "date"), ("source_rank",)).drop("source_rank")


def year_over_year(levels: DataFrame, year: int) -> DataFrame:
    """Every level of ``year - 1`` beside the one of the same day in ``year``, or NULL.

    29 February has no such day in most years and is left out there.
    """
    rows = levels.select("location", "date", LEVEL)
    later = F.add_months("date", 12)
    before = rows.filter((F.year("date") == year - 1) & (F.dayofmonth(later) == F.dayofmonth("date")))
    before = before.select("location", later.alias("date"), F.col(LEVEL).alias("previous"))
    now = rows.filter(F.year("date") == year).select("location", "date", F.col(LEVEL).alias("current"))
    return before.join(now, ["location", "date"], "left")


def placeholder_rows(levels: DataFrame, locations: DataFrame, as_of) -> DataFrame:
    """Add a zero level on the reference day for every location, so that day outlives inner joins."""
    day = as_date(as_of)
    rows = locations.select("location", day.alias("date"), F.lit(0.0).alias(LEVEL))
    return levels.select("location", "date", LEVEL).unionByName(rows)


def target_difference(
    df: DataFrame, forecast_days: int, key: str = "location", date: str = "date", lag: str = "lag01__level__m"
) -> DataFrame:
    """Replace the level by the one ``forecast_days - 1`` rows ahead and add ``y = level - lag01``.

    Runs on the joined feature rows, before rows with NULLs are dropped.  The last
    ``forecast_days - 1`` rows of a series have no level to look ahead to and are dropped.
    """
    if forecast_days > 1:
        w = by_day(key, date)
        ahead = df.withColumns(
            {LEVEL: F.lead(LEVEL, forecast_days - 1).over(w), "_left": F.lead(F.lit(1), forecast_days - 1).over(w)}
        )
        df = ahead.filter(F.col("_left").isNotNull()).drop("_left")
    return df.withColumn("y", F.col(LEVEL) - F.col(lag))


def target_differences(df: DataFrame, horizons: Sequence[int], key: str = "location", date: str = "date", lag: str = "lag01__level__m") -> DataFrame:
    """``target_difference`` for several horizons at once: a row per horizon, under ``forecast_days``."""
    w = by_day(key, date)
    aims = {f"_aim{h}": F.lead(F.struct(F.col(LEVEL)), h - 1).over(w) if h > 1 else F.struct(F.col(LEVEL)) for h in horizons}
    choices = F.array(*[F.struct(F.lit(h).alias("forecast_days"), F.col(f"_aim{h}").alias("aim")) for h in horizons])
    rest = [c for c in df.columns if c != LEVEL]
    spread = df.withColumns(aims).select(*rest, F.inline(F.filter(choices, lambda c: c["aim"].isNotNull())))
    level = F.col(f"aim.{LEVEL}")
    return spread.select(*rest, "forecast_days", level.alias(LEVEL), (level - F.col(lag)).alias("y"))
