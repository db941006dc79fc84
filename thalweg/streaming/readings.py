"""The incremental steps as Structured Streaming jobs.

Tables that streams keep are ``PeriodTable``s by day: a micro-batch merges its rows into the days it
touches, and running it again changes nothing, so a restarted query leaves every row once.  The
checkpoint lies inside the output folder: batch numbers mean something only together with it.  No
state and no watermark: a reading counts however late it comes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from thalweg.operators.risk import risk_band
from thalweg.operators.series import dedup_keep_last
from thalweg.operators.state import Folders, PeriodTable


def read_landing(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _start(writer, path: str) -> StreamingQuery:
    """Work through what has landed, then stop."""
    return writer.option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True).start()


def readings_table(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts") -> PeriodTable:
    """The ingested readings: one folder a day, whatever the number of batches."""
    return PeriodTable(spark, path, schema, date=ts, unit="day")


def _land(table: PeriodTable, batch: DataFrame, keys: Sequence[str], ts: str, current: Folders | None) -> tuple[list, Folders]:
    """Add the readings of a batch that the table does not have yet; returns the batch's days and the new map.

    Of a batch's rows with one key the latest stays, ties going to the greatest rest.  Nulls in a key
    are equal to each other.  The days of the batch are written anew.  Where the time stamp is part of
    the key only they are read, else the keys of the whole table too.
    """
    current = current or table.folders()
    days = table.periods(batch)
    if not days:
        return days, current
    old = table.read_periods(days, current)
    new = dedup_keep_last(batch, keys, [c for c in (ts,) if c not in keys])
    known = (old if ts in keys else table.read_periods(list(current.named), current)).select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    fresh = new.join(known, same, "left_anti").select(*table.schema.names)
    return days, table.replace(days, old.unionByName(fresh), current)


def ingest_readings(stream: DataFrame, path: str, keys: Sequence[str] = ("location", "ts"), ts: str = "ts") -> StreamingQuery:
    """Append readings that are not in the table yet, however old they are."""
    schema, held = stream.schema, [None]

    def write(batch: DataFrame, batch_id: int) -> None:
        # The stream is the table's writer, so the map it left is the current one.
        _, held[0] = _land(readings_table(batch.sparkSession, path, schema, ts), batch, keys, ts, held[0])

    return _start(stream.writeStream.foreachBatch(write), path)


def read_ingested(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts") -> DataFrame:
    return readings_table(spark, path, schema, ts).read()


def stream_alerts(stream: DataFrame, stations: DataFrame, path: str, band: str = "full") -> StreamingQuery:
    """Classify predictions as they arrive and keep those of one band; a join with a static table."""
    bounds = stations.select(F.col("station_name").alias("location_name"), "moderate", "high", "full_level")
    rows = stream.join(bounds, "location_name").withColumn("risk_level", risk_band("level_m")).filter(F.col("risk_level") == band)
    out = rows.select("location_name", "date", "level_m", "risk_level")
    return _start(out.writeStream.format("parquet").option("path", path), path)


ROLLUP = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("highest", T.DoubleType()),
    ]
)


def daily_rollup(readings: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """Count, sum and maximum per location and day; the same text for batch and stream."""
    day = F.to_date(ts).alias("date")
    return readings.groupBy("location", day).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("highest"))


def rollup_table(spark: SparkSession, path: str) -> PeriodTable:
    return PeriodTable(spark, f"{path}/rollup", ROLLUP, unit="day")


def stream_daily_rollup(stream: DataFrame, path: str, keys: Sequence[str] = ("location", "ts"), ts: str = "ts", value: str = "value") -> StreamingQuery:
    """Ingest readings and keep their daily rollup beside them.

    The days of a batch are rolled up anew from the deduplicated table, so a reading that lands twice
    counts once, and a late one changes its day.  All days of a batch are done, also where none of its
    readings was new: a batch that broke off between table and rollup is made good when it runs again.
    """
    schema, held = stream.schema, [None, None]

    def write(batch: DataFrame, batch_id: int) -> None:
        table, rolled = readings_table(batch.sparkSession, f"{path}/readings", schema, ts), rollup_table(batch.sparkSession, path)
        days, held[0] = _land(table, batch, keys, ts, held[0])
        if days:
            held[1] = rolled.replace(days, daily_rollup(table.read_periods(days, held[0]), ts, value), held[1])

    return _start(stream.writeStream.foreachBatch(write), path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return rollup_table(spark, path).read()
