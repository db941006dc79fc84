"""The daily jobs: backfill, reports, and the whole pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date
from thalweg.operators import evaluation, features, quality, risk, series, state
from thalweg.plans import inference
from thalweg.schema import PREDICTED_LEVEL, STATION_SERIES, WEATHER_SERIES, conform
from thalweg.session import materialise

#: Days after which the newest prediction is too old for an alert.
ALERT_AGE = 2


def backfill_levels(levels: DataFrame, id_map: DataFrame, source: DataFrame, begin, end) -> tuple[DataFrame, DataFrame]:
    """Fill missing days of the level table from a second source.

    Returns the rows to insert and a report per location: days missing, filled and still missing.
    Both are taken from the same written work list and rows.
    """
    named = levels.withColumnRenamed("location_name", "location")
    lacking = materialise(series.missing_dates(named, begin, end, value="level_m"), "missing")
    rows = materialise(state.gap_fill_rows(lacking, id_map, source), "found")
    missing = lacking.groupBy("location").agg(F.count("*").alias("missing_days"))
    filled = rows.groupBy(F.col("location_name").alias("location")).agg(F.count("*").alias("filled_days"))
    report = missing.join(filled, "location", "left").withColumn("filled_days", F.coalesce("filled_days", F.lit(0)))
    return rows, report.withColumn("still_missing", F.col("missing_days") - F.col("filled_days"))


def backfill_table(levels: DataFrame, id_map: DataFrame, source: DataFrame, begin, end) -> tuple[DataFrame, DataFrame]:
    """The level table with the found rows inserted, and the report of ``backfill_levels``.

    A (location, date) the table holds without a level keeps its row.
    """
    rows, report = backfill_levels(levels, id_map, source, begin, end)
    return state.insert_if_absent(levels, rows, distinct_batch=True), report


def availability_report(levels: DataFrame, as_of) -> DataFrame:
    """Everything known about each location's record, beside the range all locations share."""
    avail = quality.availability(levels)
    shared = quality.common_range(avail)
    day = as_date(as_of)
    return quality.gap_counts(avail).select(
        "*",
        (F.col("date_range") < 30).alias("limited"),
        (F.datediff(day, F.col("last_date")) > 7).alias("stale"),
        shared.select("safe_start").scalar().alias("safe_start"),
        shared.select("safe_end").scalar().alias("safe_end"),
    )


def forecast_diagnostics(mapping: DataFrame, forecast: DataFrame, as_of) -> DataFrame:
    """Per weather location of the mapping: extent, status, rows of the last week and of the future."""
    day = as_date(as_of)
    per = forecast.groupBy("location").agg(
        F.count("*").alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_if(F.col("date") >= F.date_sub(day, 7)).alias("recent"),
        F.count_if(F.col("date") > day).alias("future"),
    )
    wanted = features.edges(mapping, "weather_locations").select("location").distinct()
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n", "recent", "future")}
    joined = wanted.join(per, "location", "left").withColumns(zero)
    return joined.withColumn("status", F.when(F.col("n") > 0, "OK").otherwise("MISSING"))


def catchup_predictions(
    predictions: DataFrame,
    mapping: DataFrame,
    thresholds: DataFrame,
    levels: DataFrame,
    history: DataFrame,
    forecast: DataFrame,
    predictors: Mapping[str, inference.Predictor],
    begin,
    end,
    forecast_days: int,
    station_lags: Sequence[int] = inference.STATION_LAGS,
    weather_lags: Sequence[int] = inference.WEATHER_LAGS,
    today=None,
) -> DataFrame:
    """Predictions, with risk, for every (station, day) of the range that has none; one job."""
    work = inference.missing_predictions(predictions, mapping.select("station"), begin, end)
    kinds = F.explode(F.array(*[F.lit(k) for k in predictors]))
    grid = work.select("station", "as_of", F.lit(forecast_days).alias("forecast_days"), kinds.alias("model_type"))
    made = inference.infer_batch(mapping, grid, levels, history, forecast, predictors, station_lags, weather_lags, today, (begin, end))
    return risk.classify(made.withColumn("risk_level", F.lit(None).cast("string")), thresholds)


def predict_day(
    mapping: DataFrame,
    levels: DataFrame,
    history: DataFrame,
    forecast: DataFrame,
    predictors: Mapping[str, inference.Predictor],
    horizons: Sequence[int],
    as_of,
    station_lags: Sequence[int] = inference.STATION_LAGS,
    weather_lags: Sequence[int] = inference.WEATHER_LAGS,
) -> DataFrame:
    """Predictions of all stations of a mapping for one day, or an error: ValueError where a source has no
    row at all in its window, RuntimeError where nothing came out or a level is missing."""
    day = as_date(as_of)
    windows = inference.window_days(mapping, levels, history, forecast, day, station_lags, weather_lags)
    empty = windows.filter("found = 0").orderBy("station", "source", "location").limit(1).collect()
    if empty:
        row = empty[0]
        raise ValueError(f"station {row['station']}: no {row['source']} data of {row['location']} around {as_of}")
    grid = inference.inference_grid(mapping.select("station"), horizons, list(predictors)).withColumn("as_of", day)
    made = inference.infer_batch(mapping, grid, levels, history, forecast, predictors, station_lags, weather_lags, None, (as_of, as_of), keep_missing=True)
    return evaluation.require_predictions(quality.require_unique(materialise(made, "predictions"), state.PREDICTION_KEY))


class DailyTables(NamedTuple):
    """What the daily job reads and keeps; each by month, so a run costs its days and not the history."""

    levels: state.PeriodTable  # location, date, level__m
    history: state.PeriodTable  # location, date, precipitation_sum, precipitation_hours
    forecast: state.PeriodTable
    predictions: state.PeriodTable  # as PREDICTED_LEVEL


def daily_tables(spark, root: str) -> DailyTables:
    kept = {"levels": STATION_SERIES, "history": WEATHER_SERIES, "forecast": WEATHER_SERIES, "predictions": PREDICTED_LEVEL}
    return DailyTables(*[state.PeriodTable(spark, f"{root}/{name}", schema) for name, schema in kept.items()])


def _ingest(tables: DailyTables, landed: Mapping[str, DataFrame]) -> list[tuple]:
    """Merge what has landed; a source that is absent or can't be read leaves its table as it was."""
    key = ("location", "date")
    rules = {
        "history": lambda old, new: state.upsert_latest(old, new, key),
        "forecast": lambda old, new: state.upsert_latest(old, new, key),
        "levels": lambda old, new: state.insert_if_absent(old, new, key, distinct_batch=True),
    }
    lines = []
    for name, rule in rules.items():
        if name not in landed:
            lines.append(("ingest", name, "absent", 0))
            continue
        table, seen = getattr(tables, name), Observation(f"landed-{name}")
        keyed = F.col("location").isNotNull() & F.col("date").isNotNull()
        try:
            rows = conform(landed[name], table.schema, strict=False, check_nulls=False).select(*table.schema.names)
            # Counted while the batch is written: no pass of its own.
            rows = rows.observe(seen, F.count("*").alias("n"), F.count_if(~keyed).alias("dropped"))
            table.merge(materialise(rows.filter(keyed), f"landed-{name}"), rule)
            counts = seen.get
            lines.append(("ingest", name, "ok", counts["n"] - counts["dropped"]))
            if counts["dropped"]:
                lines.append(("ingest", name, "dropped", counts["dropped"]))
        except (PySparkException, ValueError):
            lines.append(("ingest", name, "failed", 0))
    return lines


def daily_pipeline(
    tables: DailyTables,
    landed: Mapping[str, DataFrame],
    mapping: DataFrame,
    thresholds: DataFrame,
    predictors: Mapping[str, inference.Predictor],
    horizons: Sequence[int],
    as_of,
    station_lags: Sequence[int] = inference.STATION_LAGS,
    weather_lags: Sequence[int] = inference.WEATHER_LAGS,
    ahead: int = 5,
    alert: str = "full",
) -> tuple[DataFrame, DataFrame | None]:
    """Ingest, check the forecast, predict, assess and store, and select the alerts.

    ``landed`` holds the day's rows for "levels", "history" and "forecast", as far as they came.
    Returns a status frame (phase, item, outcome, n) and the alerts.  A station whose inputs are
    incomplete is reported as failed and does not stop the others.  Without a fresh forecast nothing
    is predicted and there are no alerts.  New predictions are classified on their way into the
    table, so every row is written once, and only the months of the run are opened.
    """
    spark, day = mapping.sparkSession, as_date(as_of)
    status = "phase string, item string, outcome string, n long"
    lines = _ingest(tables, landed)
    forecast = tables.forecast.read(begin=day)
    gate = forecast.agg((F.max("date") >= F.date_add(day, ahead)).alias("fresh")).first()
    if not gate["fresh"]:
        return spark.createDataFrame([*lines, ("forecast", "all", "stale", 0)], status), None
    levels = tables.levels.read(F.date_sub(day, max(station_lags)), day)
    history = tables.history.read(F.date_sub(day, max(weather_lags)), day)
    stations = mapping.select("station").withColumn("as_of", day)
    grid = inference.inference_grid(stations, horizons, list(predictors)).withColumn("as_of", day)
    seen = Observation("predictions")
    made = inference.infer_batch(mapping, grid, levels, history, forecast, predictors, station_lags, weather_lags, None, (as_of, as_of))
    made = quality.require_unique(materialise(made.observe(seen, F.count("*").alias("n")), "predictions"), state.PREDICTION_KEY)
    if seen.get["n"] == 0:
        lines.append(("predict", "all", "nothing", 0))
    tables.predictions.merge(made, lambda old, new: risk.classify(state.upsert_predictions(old, new, as_of), thresholds))
    alerts = risk.flood_alerts(tables.predictions.read(F.date_sub(day, ALERT_AGE)), as_of, ALERT_AGE, alert)
    failed = inference.failed_items(grid, made).groupBy("location_name").agg(F.count("*").alias("n"))
    done = made.groupBy("location_name").agg(F.count("*").alias("n"))
    bands = tables.predictions.read(day, day).groupBy("risk_level").agg(F.count("*").alias("n"))
    windows = inference.window_days(mapping, levels, history, forecast, day, station_lags, weather_lags)
    line = lambda df, phase, item, outcome: df.select(F.lit(phase).alias("phase"), F.col(item).alias("item"), F.lit(outcome).alias("outcome"), "n")
    parts = [
        spark.createDataFrame(lines, status),
        line(windows.groupBy("station").agg(F.sum(F.col("expected") - F.col("found")).alias("n")).filter("n > 0"), "inputs", "station", "days missing"),
        line(windows.filter("found = 0").groupBy("location").agg(F.countDistinct("station").alias("n")), "inputs", "location", "no rows"),
        line(done, "predict", "location_name", "ok"),
        line(failed, "predict", "location_name", "failed"),
        line(bands, "risk", "risk_level", "assessed"),
    ]
    return reduce(DataFrame.unionByName, parts), alerts
