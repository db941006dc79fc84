"""As-of looks: what a series said at, before or after given days.

Request points are put among the rows of the series and everything is carried along one window per
location.  So a series is shuffled once, whatever the number of looks, and no row is laid out for a
request's single days.  A carried value comes with its day, which is then held against the days the
request allows.  Rows of one day are peers: a look that ends on a day sees all of it.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Look(NamedTuple):
    """One question of a request: a value by row (NULLs are passed over) and the days it may be of,
    counted from the request's; ``newest`` takes the last such row, else the first."""

    value: Column
    since: int
    upto: int
    newest: bool = True


def look(
    points: DataFrame,
    rows: DataFrame,
    looks: Mapping[str, Look],
    key: str = "location",
    at: str = "as_of",
    date: str = "date",
    same_day: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(key, at) of ``points`` with a struct (day, value) per look, NULL where no row qualifies.

    ``rows`` holds (key, date, …), the columns the looks are made of.  ``same_day`` adds columns to
    them first, aggregates over all rows of the location's day.  A window's group is the rows of a
    series and the requests of its location.
    """
    asked = points.select(key, F.col(at).alias(date)).distinct().withColumn("_asked", F.lit(True))
    both = rows.withColumn("_asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    both = both.withColumns({"_day": F.unix_date(date), "_back": -F.unix_date(date)})
    forth, back = (Window.partitionBy(key).orderBy(c) for c in ("_day", "_back"))
    for name, value in (same_day or {}).items():
        both = both.withColumn(name, value.over(forth.rangeBetween(0, 0)))
    found = {}
    for name, one in looks.items():
        seen = F.when(one.value.isNotNull() & ~F.col("_asked"), F.struct(F.col(date).alias("day"), one.value.alias("value")))
        # Both ways the frame begins at the end of the series, so it grows and is never evaluated anew.
        window, last = (forth, one.upto) if one.newest else (back, -one.since)
        found[name] = F.last(seen, ignorenulls=True).over(window.rangeBetween(Window.unboundedPreceding, last))
    carried = both.withColumns(found).filter("_asked")

    def within(name, one):
        day = F.col(name)["day"]
        inside = day >= F.date_add(date, one.since) if one.newest else day <= F.date_add(date, one.upto)
        return F.when(inside, F.col(name)).alias(name)

    return carried.select(key, F.col(date).alias(at), *[within(n, one) for n, one in looks.items()])
