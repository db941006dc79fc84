"""Table schemas, and the check that a frame fits one."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measure names of the daily and hourly weather feeds, in the order of the feed.
DAILY_MEASURES = ("temperature_2m_max", "temperature_2m_min", "precipitation_sum", "rain_sum", "precipitation_hours")
FORECAST_MEASURES = (*DAILY_MEASURES, "precipitation_probability_max", "wind_speed_10m_max")
HOURLY_MEASURES = ("temperature_2m", "precipitation_probability", "precipitation")


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
}


def _struct(text: str) -> T.StructType:
    """A schema from ``name type, ...``; needs no session, so schemas can be module constants."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STATION_SERIES = _struct("location string, date date, level__m double")
WEATHER_SERIES = _struct("location string, date date, precipitation_sum double, precipitation_hours double")
HISTORICAL_LEVEL = _struct("location_name string, date date, level_m double")
HISTORICAL_WEATHER = _struct("location_name string, date timestamp, " + ", ".join(f"{m} double" for m in DAILY_MEASURES))
FORECAST_WEATHER = _struct("location_name string, date timestamp, " + ", ".join(f"{m} double" for m in FORECAST_MEASURES))
PREDICTED_LEVEL = _struct(
    "id long, location_name string, date date, level_m double, station_number string, ml_model_name string, "
    "forecast_days int, risk_level string, created_at date, updated_at date"
)

# Patterns of the columns a wide modelling frame may have besides the fixed ones.
MODELLING_PATTERNS = {
    r"(?:[a-zA-Z0-9_]+__)?lag\d+__level__m": "double",
    r"[a-zA-Z0-9_]+__(?:lag|forecast)\d+__precipitation_(?:sum|hours)": "double",
}
MODELLING_FIXED = _struct(
    "location string, date date, level__m double, month_sin double, month_cos double, dayofyear_sin double, dayofyear_cos double"
)


def conform(
    df: DataFrame,
    schema: T.StructType,
    strict: bool = True,
    coerce: bool = True,
    patterns: Mapping[str, str] | None = None,
    nullable: Iterable[str] = (),
    check_nulls: bool = True,
) -> DataFrame:
    """``df`` with the columns and types of ``schema``, or ValueError saying what does not fit.

    ``patterns`` (regex to type) admits columns named by pattern.  With ``strict`` any other column
    is refused, without it kept as it is.  ``coerce`` casts, otherwise types must agree.  Columns
    outside ``nullable`` must hold no NULL, which costs one aggregate over the frame.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    by_pattern = {}
    for c in df.columns:
        for pattern, kind in (patterns or {}).items():
            if c not in wanted and re.fullmatch(pattern, c):
                by_pattern[c] = _TYPES[kind]
    extra = [c for c in df.columns if c not in wanted and c not in by_pattern]
    if extra and strict:
        raise ValueError(f"unexpected columns: {extra}")
    types = {**wanted, **by_pattern}
    wrong = [c for c, t in types.items() if df.schema[c].dataType != t]
    if wrong and not coerce:
        raise ValueError(f"wrong types: {[(c, df.schema[c].dataType.simpleString()) for c in wrong]}")
    order = [*wanted, *by_pattern, *extra]
    out = df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in wrong else F.col(f"`{c}`") for c in order])
    if check_nulls:
        checked = [c for c in types if c not in set(nullable)]
        row = out.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in checked]).first()
        holes = {c: row[c] for c in checked if row[c]}
        if holes:
            raise ValueError(f"NULLs in columns: {holes}")
    return out
