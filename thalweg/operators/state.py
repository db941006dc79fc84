"""Keeping tables current: upserts, inserts of what is absent, refreshes, conflict reports.

Plain files know no MERGE, so the operators below return the table as it is after the change.  Two
ways to store that: ``SnapshotTable`` writes a small table whole, under a new version, and points to
it; ``PeriodTable`` keeps a large one by day, month or year and rewrites the periods a batch touches.
Neither overwrites files a plan is reading.

All of them are aggregates or joins on the full key.  A third of all rows in one location is spread
over its days; many copies of one key are combined before the shuffle.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date
from thalweg.operators.series import dedup_keep_last

WEATHER_KEY = ("location_name", "date")
PREDICTION_KEY = ("location_name", "date", "ml_model_name")
READING_KEY = ("station_id", "reading_date")
INDICATOR_KEY = ("region", "district", "value", "month", "indicator")


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str] = WEATHER_KEY) -> DataFrame:
    """The new row where both have the key; one row per key."""
    both = old.withColumn("_rank", F.lit(1)).unionByName(new.withColumn("_rank", F.lit(2)))
    return dedup_keep_last(both, keys, ("_rank",)).drop("_rank")


def upsert_weather(old: DataFrame, new: DataFrame, clear_existing: bool = False) -> DataFrame:
    """Weather rows by (location, date), request coordinates left out; ``clear_existing`` drops the old."""
    new = new.drop("forecast_latitude", "forecast_longitude")
    return dedup_keep_last(new, WEATHER_KEY, ()) if clear_existing else upsert_latest(old, new)


def upsert_predictions(old: DataFrame, new: DataFrame, updated_at) -> DataFrame:
    """Store predictions by (location, date, model).

    On a key already present, level, horizon and update time change; id, creation time, station
    number and the assessed risk stay.  ``new`` holds the key, level_m and forecast_days, one row
    per key.  The sides are gathered in one grouping, as a full outer join would shuffle both too.
    """
    keep = [c for c in old.columns if c not in (*PREDICTION_KEY, "level_m", "forecast_days", "updated_at")]
    a = old.select(*PREDICTION_KEY, F.struct("level_m", "forecast_days", "updated_at", *keep).alias("_old"), F.lit(None).alias("_new"))
    b = new.select(*PREDICTION_KEY, F.lit(None).alias("_old"), F.struct("level_m", "forecast_days").alias("_new"))
    merged = a.unionByName(b).groupBy(*PREDICTION_KEY).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    isnew = F.col("_new").isNotNull()
    stamp = F.lit(updated_at).cast(old.schema["updated_at"].dataType)
    out = {
        "level_m": F.when(isnew, F.col("_new.level_m")).otherwise(F.col("_old.level_m")),
        "forecast_days": F.when(isnew, F.col("_new.forecast_days")).otherwise(F.col("_old.forecast_days")),
        "updated_at": F.when(isnew, stamp).otherwise(F.col("_old.updated_at")),
    }
    if "created_at" in keep:
        out["created_at"] = F.when(F.col("_old").isNull(), stamp).otherwise(F.col("_old.created_at"))
    return merged.select(*[c if c in PREDICTION_KEY else out.get(c, F.col(f"_old.{c}")).alias(c) for c in old.columns])


def rows_to_insert(old: DataFrame, new: DataFrame, keys: Sequence[str] = WEATHER_KEY, distinct_batch: bool = False) -> DataFrame:
    """New rows whose key the table does not have.

    Only the table is consulted: two new rows of one key both stay, unless ``distinct_batch``.
    """
    if distinct_batch:
        new = dedup_keep_last(new, keys, ())
    return new.join(old.select(*keys), list(keys), "left_anti").select(*new.columns)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str] = WEATHER_KEY, distinct_batch: bool = False) -> DataFrame:
    return old.unionByName(rows_to_insert(old, new, keys, distinct_batch))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str] = READING_KEY) -> DataFrame:
    """Insert with conflicts ignored: one row per new key, none for a key already there."""
    return insert_if_absent(old, new, keys, distinct_batch=True)


def conflict_report(old: DataFrame, new: DataFrame, value: str = "level_m", keys: Sequence[str] = WEATHER_KEY) -> DataFrame:
    """New rows whose key the table has with a different value, NULL counting as a value.

    A key the table holds several times is compared by its greatest value, so copies on both sides
    do not multiply.
    """
    a = dedup_keep_last(old.select(*keys, F.col(value).alias("existing")), keys, ())
    b = new.select(*keys, F.col(value).alias("incoming"))
    return b.join(a, list(keys)).filter(~F.col("existing").eqNullSafe(F.col("incoming")))


def delete_older_duplicates(df: DataFrame, keys: Sequence[str] = PREDICTION_KEY, id_col: str = "id") -> DataFrame:
    """Per key the row with the greatest id."""
    return dedup_keep_last(df, keys, (id_col,))


def gap_fill_rows(missing: DataFrame, id_map: DataFrame, source: DataFrame) -> DataFrame:
    """(location_name, date, level_m) found in a second source for missing (location, date) pairs.

    ``id_map`` (location, station_id) translates names; source rows without a reading do not count.
    """
    wanted = missing.join(id_map, "location").select("location", "station_id", F.col("date").alias("reading_date"))
    found = source.filter(F.col("reading").isNotNull()).groupBy(*READING_KEY).agg(F.max("reading").alias("level_m"))
    return wanted.join(found, list(READING_KEY)).select(F.col("location").alias("location_name"), F.col("reading_date").alias("date"), "level_m")


class SnapshotTable:
    """A table as a series of versions under one folder, the newest named by a pointer file.

    A version is written to its own folder and becomes current by appending one pointer row, so
    readers see the old table or the new one.  A failed or repeated write of the same version
    number replaces its own half-written folder only.
    """

    def __init__(self, spark, root: str, schema):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.pointers = f"{self.root}/versions"

    def version(self) -> int:
        """The current version; 0 before the first commit."""
        found = self._pointer_frame().agg(F.max("version")).first()[0]
        return found or 0

    def _pointer_frame(self) -> DataFrame:
        try:
            return self.spark.read.schema("version long").parquet(self.pointers)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "version long")

    def read(self) -> DataFrame:
        current = self.version()
        if current == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v{current:012d}")

    def commit(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the next version and make it current."""
        following = self.version() + 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/v{following:012d}")
        self.spark.range(following, following + 1).select(F.col("id").alias("version")).coalesce(1).write.mode("append").parquet(self.pointers)
        return following


class Folders(NamedTuple):
    """The folder of each period, and the version of that map."""

    version: int
    named: dict


class PeriodTable:
    """A table kept in one folder per month (or day, year) of its date column.

    A batch is merged with the periods it touches and with nothing else, so its cost follows the
    batch and not the history.  The merged periods are written once, to folders of their own; a small
    map of (period, folder) then names the current ones.  Files are never overwritten or removed: a
    reader planned before a merge still gets the table as it was, and a merge that fails before the
    map changes has done nothing.  Merging the same batch again gives the same table.  One writer at
    a time.  Rows without a date are a period of their own.
    """

    MAP = "period date, folder string"

    def __init__(self, spark, path: str, schema, date: str = "date", unit: str = "month"):
        self.spark, self.path, self.schema, self.date, self.unit = spark, path.rstrip("/"), schema, date, unit

    def _period(self, day):
        return F.date_trunc(self.unit, day).cast("date")

    def _opened(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, begin=None, end=None) -> DataFrame:
        """The table, or its rows of some days; periods outside are not opened."""
        named = self.folders().named
        if begin is not None or end is not None:
            low, high = (self._period(as_date(day)) if day is not None else F.lit(None).cast("date") for day in (begin, end))
            low, high = self.spark.range(1).select(low, high).first()
            named = {p: f for p, f in named.items() if p is not None and (low is None or p >= low) and (high is None or p <= high)}
        rows = self._opened(sorted(named.values()))
        day = F.col(self.date).cast("date")
        if begin is not None:
            rows = rows.filter(day >= as_date(begin))
        return rows if end is None else rows.filter(day <= as_date(end))

    def periods(self, rows: DataFrame) -> list:
        """The periods of some rows, None for those without a date."""
        return [r[0] for r in rows.select(self._period(self.date)).distinct().collect()]

    def folders(self) -> Folders:
        """The map as it is now; a step that reads and replaces looks it up once."""
        try:
            files = self.spark.read.schema(self.MAP).parquet(f"{self.path}/map").inputFiles()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            files = []
        version = max((int(m[1]) for f in files if (m := re.search(r"/version=([0-9]+)/", f))), default=0)
        if not version:
            return Folders(0, {})
        return Folders(version, {r["period"]: r["folder"] for r in self.spark.read.schema(self.MAP).parquet(f"{self.path}/map/version={version}").collect()})

    def read_periods(self, periods: Sequence, current: Folders | None = None) -> DataFrame:
        named = (current or self.folders()).named
        return self._opened(sorted(named[p] for p in periods if p in named))

    def replace(self, periods: Sequence | None, rows: DataFrame, current: Folders | None = None) -> Folders:
        """Make ``rows`` all that their periods hold; returns the new map.

        ``periods`` are those that the rows may belong to: one without a row is emptied.  With None
        the periods of the rows are replaced, whichever they are.
        """
        version, named = current or self.folders()
        data = f"data/{uuid.uuid4().hex}"
        name = F.coalesce(self._period(self.date).cast("string"), F.lit("none"))
        # Rows of a period go to as many tasks as their size asks for: adaptive execution splits and joins them.
        spread = rows.select(*self.schema.names, name.alias("_period")).hint("rebalance", "_period")
        spread.write.partitionBy("_period").parquet(f"{self.path}/{data}")
        held = self.spark.read.schema(self.schema).parquet(f"{self.path}/{data}").inputFiles()
        found = {m[1] for f in held if (m := re.search(r"/_period=([^/]+)/", f))}
        day = lambda p: None if p == "none" else dt.date.fromisoformat(p)
        periods = {day(p) for p in found} if periods is None else set(periods)
        strange = {day(p) for p in found} - periods
        if strange:
            raise ValueError(f"rows of other periods: {sorted(map(str, strange))}")
        now = {p: f for p, f in named.items() if p not in periods} | {day(p): f"{data}/_period={p}" for p in found}
        # A whole map each time, under the next number: the greatest is the current one.
        self.spark.createDataFrame(list(now.items()), self.MAP).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/map/version={version + 1}")
        return Folders(version + 1, now)

    def merge(self, new: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the periods of ``new`` by ``rule(their old rows, new)``.

        The rule must keep rows in their period, as all rules here do: the date is part of the key.
        ``new`` is read twice, for its periods and for its rows; store it first where it is costly.
        Returns the number of periods written.
        """
        current = self.folders()
        if not current.named:
            # Nothing is stored yet, so no old rows have to be found first.
            return len(self.replace(None, rule(self._opened([]), new), current).named)
        touched = self.periods(new)
        if touched:
            self.replace(touched, rule(self.read_periods(touched, current), new), current)
        return len(touched)
