"""Sets of days as bitmaps: a bit per day of a range, in aggregates of fixed size.

A group's days take 4 KB for each 32,768 days of the range, however many rows it has, and are merged
on the map side bit by bit.  Copies of a day set the same bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date, day_range

#: Days in one of Spark's bitmaps.
SPAN = 32_768


def _number(day: Column, begin: Column) -> Column:
    return F.datediff(day, begin) + 1


def day_map(day, begin, end, spans: int = 2) -> Column:
    """Aggregate: the days between ``begin`` and ``end``; days outside and NULLs are left out.

    ``spans`` bitmaps reach 89 years each; a longer range raises an error.
    """
    begin, end = as_date(begin), as_date(end)
    number = _number(F.col(day) if isinstance(day, str) else day, begin)
    fits = F.when(_number(end, begin) > spans * SPAN, F.raise_error(F.lit("the range is too long for its day maps")).cast("int")).otherwise(number)
    inside = F.when((number >= 1) & (number <= _number(end, begin)), fits)
    maps = [F.bitmap_construct_agg(F.bitmap_bit_position(F.when(F.bitmap_bucket_number(inside) == k + 1, inside))) for k in range(spans)]
    return F.array(*maps)


def has_day(maps, day: Column, begin) -> Column:
    """Whether a day of the range is in a map; a NULL map has none."""
    number = _number(day, as_date(begin))
    held = F.get(maps, (F.bitmap_bucket_number(number) - 1).cast("int"))
    bit = F.bitmap_bit_position(number).cast("int")
    byte = F.conv(F.hex(F.substring(held, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))


def count_days(maps) -> Column:
    """How many days a map has."""
    return F.coalesce(F.aggregate(maps, F.lit(0).cast("long"), lambda n, m: n + F.bitmap_count(m)), F.lit(0).cast("long"))


def missing_days(maps, begin, end) -> Column:
    """The days of the range that a map lacks, in order."""
    return F.filter(day_range(begin, end), lambda d: ~has_day(maps, d, begin))
