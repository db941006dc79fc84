"""Monthly indicators: wide period tables in, long rows out."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.functions.dates import parse_date

MONTH_COLUMN = r"[A-Z][a-z]{2}-\d{4}"


def month_columns(columns: Sequence[str]) -> list[str]:
    """The columns named like ``Jan-2001``, in calendar order; those with an underscore are not."""
    named = [c for c in columns if re.fullmatch(MONTH_COLUMN, c)]
    return sorted(named, key=lambda c: dt.datetime.strptime(c, "%b-%Y"))


def select_months(df: DataFrame, ids: Sequence[str] = ("region", "district")) -> DataFrame:
    """Ids and month columns in order; everything else, such as suffixed copies, is dropped."""
    return df.select(*ids, *[f"`{c}`" for c in month_columns(df.columns)])


def feature_columns(columns: Sequence[str], excluded: Sequence[str] = ("location", "y", "date", "level__m")) -> list[str]:
    """What a model takes as input: all columns but the excluded ones."""
    return [c for c in columns if c not in excluded]


def unpivot_months(df: DataFrame, indicator: str, months: Sequence[str] | None = None, ids: Sequence[str] = ("region", "district")) -> DataFrame:
    """(region, district, value, month, indicator) for all months, or the given ones; no NULL values."""
    wanted = list(months) if months is not None else month_columns(df.columns)
    if not wanted:
        raise ValueError("no month columns")
    tall = df.unpivot([F.col(c) for c in ids], [F.col(f"`{c}`") for c in wanted], "_label", "value")
    return tall.filter(F.col("value").isNotNull()).select(
        *ids, "value", parse_date("_label", "month").alias("month"), F.lit(indicator).alias("indicator")
    )


def merge_periods(periods: Sequence[DataFrame], indicator: str, ids: Sequence[str] = ("region", "district")) -> DataFrame:
    """All months of several period tables as long rows, each month from the first table that has it.

    Gives what outer-joining the tables side by side and dropping repeated columns would, without
    the joins: which table owns a month is known from the column names.
    """
    seen: set[str] = set()
    out = None
    for period in periods:
        own = [m for m in month_columns(period.columns) if m not in seen]
        seen.update(own)
        if own:
            part = unpivot_months(period, indicator, own, ids)
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no month columns in any period")
    return out


def pivot_months(long: DataFrame, months: Sequence[str], ids: Sequence[str] = ("region", "district")) -> DataFrame:
    """Back to one column per month; the months are given, so no pass over the data finds them."""
    labelled = long.withColumn("_label", F.date_format("month", "MMM-yyyy"))
    return labelled.groupBy(*ids).pivot("_label", list(months)).agg(F.max("value"))


def keep_regions(df: DataFrame, regions: Sequence[str]) -> DataFrame:
    return df.filter(F.col("region").isin(list(regions)))
