"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The input formats of the supported feeds.
DATE_FORMATS = {
    "iso": "yyyy-MM-dd",
    "slash": "dd/MM/yyyy",
    "dash": "dd-MM-yyyy",
    "offset_timestamp": "yyyy-MM-dd HH:mm:ssxxx",
    "month": "MMM-yyyy",
}


def as_date(value) -> Column:
    """A date column from a column, a ``datetime.date`` or an ISO string."""
    if isinstance(value, Column):
        return value
    text = value if isinstance(value, str) else dt.date.isoformat(value)
    return F.lit(text).cast("date")


def day_range(begin, end) -> Column:
    """All days begin..end as an array; empty where end is before begin."""
    begin, end = as_date(begin), as_date(end)
    empty = F.array().cast("array<date>")
    return F.when(begin <= end, F.sequence(begin, F.greatest(begin, end))).otherwise(empty)


def date_spine(locations: DataFrame, begin, end, key: str = "location", date: str = "date") -> DataFrame:
    """One row per location and day.  A generator over the locations, so there is no join."""
    return locations.select(key, F.explode(day_range(begin, end)).alias(date))


def utc_calendar_date(ts: Column | str, tz: str | None = None) -> Column:
    """The calendar day of an instant, in UTC or in ``tz``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    ts = ts.cast("timestamp")
    return (F.from_utc_timestamp(ts, tz) if tz else ts).cast("date")


def parse_date(text: Column | str, kind: str) -> Column:
    """Read a date written in one of ``DATE_FORMATS``; NULL where the text does not fit."""
    text = F.col(text) if isinstance(text, str) else text
    fmt = DATE_FORMATS[kind]
    if kind == "offset_timestamp":
        return F.try_to_timestamp(text, F.lit(fmt)).cast("date")
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_date_any(text: Column | str, kinds=("iso", "slash", "dash", "offset_timestamp", "month")) -> Column:
    """The first of several formats that fits."""
    return F.coalesce(*[parse_date(text, kind) for kind in kinds])


def circular_encoding(date: Column | str = "date") -> dict[str, Column]:
    """Month and day of year, plain and as points on the unit circle.

    The year is taken as 365 days, so day 366 of a leap year lands just past the full turn.
    """
    month, day = F.month(date), F.dayofyear(date)
    month_angle = (month - 1) * (2 * F.pi()) / 12
    day_angle = (day - 1) * (2 * F.pi()) / 365
    return {
        "month": month,
        "dayofyear": day,
        "month_sin": F.sin(month_angle),
        "month_cos": F.cos(month_angle),
        "dayofyear_sin": F.sin(day_angle),
        "dayofyear_cos": F.cos(day_angle),
    }


def fourier_terms(date: Column | str = "date", order: int = 10, period: float = 365.25) -> dict[str, Column]:
    """Yearly seasonality as ``order`` sine/cosine pairs of the day count."""
    days = F.datediff(F.col(date) if isinstance(date, str) else date, F.lit("1970-01-01").cast("date"))
    terms = {}
    for k in range(1, order + 1):
        angle = days * (2 * F.pi() * k / period)
        terms[f"yearly_sin{k:02d}"] = F.sin(angle)
        terms[f"yearly_cos{k:02d}"] = F.cos(angle)
    return terms


def target_date(date: Column | str, forecast_days) -> Column:
    """The day a prediction is about: horizon 1 is the reference day itself."""
    horizon = F.lit(forecast_days) if isinstance(forecast_days, int) else forecast_days
    return F.date_add(date, (horizon - 1).cast("int"))


def previous_year(date: Column | str) -> Column:
    """The same day a year earlier; 29 February becomes 28 February."""
    return F.add_months(date, -12)


def half_year_before(month_start: Column | str) -> Column:
    """The month that holds the day 182 days earlier, as its first day."""
    return F.trunc(F.date_sub(month_start, 182), "month")


def rewrite_year(text: Column | str, year: Column) -> Column:
    """Put ``year`` in place of the year of a ``dd-MM-yyyy`` text."""
    parts = F.split(text, "-")
    return F.concat_ws("-", parts[0], parts[1], year.cast("string"))


def iso_week(date: Column | str) -> dict[str, Column]:
    """ISO week and the year that week belongs to."""
    column = F.col(date) if isinstance(date, str) else date
    return {"week_number": F.weekofyear(column), "week_year": F.extract(F.lit("YEAROFWEEK"), column)}
