"""Writing tables out.  Every writer leaves one folder of part files, written by all tasks."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.functions.text import normalise_name
from thalweg.session import fresh_path


def save_csv_dated(df: DataFrame, base: str, day: dt.date | str) -> str:
    """Write ``{base}_{YYYY-MM-DD}.csv`` and return its path."""
    day = day if isinstance(day, str) else day.isoformat()
    path = f"{base}_{day}.csv"
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def chart_export_path(folder: str, location: str, moment: dt.datetime) -> str:
    """Where a gauge chart export of a location goes; the newest is found by ``latest_file_per_location``."""
    return f"{folder.rstrip('/')}/{normalise_name(location)}_river_levels_as_at_{moment:%Y%m%d_%H%M%S}.csv"


def export_table(df: DataFrame, path: str, where: str | None = None, force_overwrite: bool = False, preview_rows: int = 20) -> DataFrame:
    """Write a table, or the rows a condition selects, as CSV and return a preview.

    An export that is already there is kept unless ``force_overwrite``.
    """
    rows = df.filter(F.expr(where)) if where else df
    rows.write.mode("overwrite" if force_overwrite else "ignore").option("header", "true").csv(path)
    return rows.limit(preview_rows)


def stage_artifact(df: DataFrame, root: str, stage: str, keys: Sequence[str] = ("station", "forecast_days")) -> str:
    """Write one stage of a training run (preprocessed, train, eval) by station and horizon."""
    path = f"{root.rstrip('/')}/{stage}"
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)
    return path


def stage_config(spark, config, root: str) -> str:
    """Write a run's configuration as one JSON line beside its stages."""
    path = f"{root.rstrip('/')}/config"
    line = json.dumps(dataclasses.asdict(config), sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_artifact(spark, root: str, stage: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{stage}")


def store_series(df: DataFrame, buckets: int, key: str = "location", date: str = "date") -> DataFrame:
    """Write series bucketed by location and sorted by day, and read them back.

    Whatever is done by location on such a table (lags, fills, gaps, joins of two with as many
    buckets) needs no shuffle.  A bucket is one file; as many as tasks that later work side by side.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "series")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, date).option("path", path).saveAsTable(name)
    return spark.table(name)
