"""Predicting levels in bulk: any number of stations, days, horizons and models in one plan.

Each (station, reference day) looks at a window of days around it.  The requests are put among the
rows of the series and values are carried to them with their day (``operators.asof``), so a series is
shuffled once and no row is laid out for the single days of a window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date
from thalweg.functions.numbers import nan_to_null
from thalweg.functions.text import model_name
from thalweg.operators import evaluation, features, quality, series
from thalweg.operators.asof import Look, look
from thalweg.operators.features import STATION_LAGS, WEATHER_LAGS
from thalweg.operators.series import LEVEL, RAIN

# Fixed value: the first part of every model name.
PREPROCESSOR = "Preprocessor_001"
Predictor = Callable[[DataFrame], DataFrame]


def inference_grid(stations: DataFrame, horizons: Sequence[int], model_types: Sequence[str]) -> DataFrame:
    """Stations by horizons by model types; a generator, as the lists are short and known."""
    return stations.select(
        "station",
        F.explode(F.array(*[F.lit(h) for h in horizons])).alias("forecast_days"),
    ).select("station", "forecast_days", F.explode(F.array(*[F.lit(m) for m in model_types])).alias("model_type"))


def _keep(df: DataFrame, locations: DataFrame) -> DataFrame:
    return df.join(locations.select("location").distinct(), "location", "left_semi")


def inference_levels(levels: DataFrame, locations: DataFrame, as_of, lags: Sequence[int] = STATION_LAGS) -> DataFrame:
    """Filled levels of the days before the reference day, and a zero placeholder on it."""
    day = as_date(as_of)
    begin, end = F.date_sub(day, max(lags)), F.date_sub(day, 1)
    window = _keep(levels.filter(F.col("date").between(begin, end)), locations)
    filled = series.fill_missing_levels(window, begin, end)
    return series.placeholder_rows(filled, locations.select("location").distinct(), day)


def inference_weather(
    history: DataFrame, forecast: DataFrame, locations: DataFrame, as_of, lags: Sequence[int] = WEATHER_LAGS, today=None
) -> DataFrame:
    """Filled weather around the reference day: history to yesterday, forecast from the reference day.

    ``today`` is the day of the run and defaults to the reference day.  Where all days lie before it
    only history is used; on a day both sides have, the forecast wins.
    """
    day = as_date(as_of)
    now = day if today is None else as_date(today)
    begin, end = F.date_sub(day, max(lags)), F.date_sub(day, min(lags))
    ahead = end >= now
    past_end = F.when(ahead, F.date_sub(now, 1)).otherwise(end)
    past = history.filter(F.col("date").between(begin, past_end)).select("location", "date", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in RAIN])
    coming = forecast.filter(F.col("date").between(day, end) & ahead).select("location", "date", *RAIN)
    both = _keep(series.history_then_forecast(past, coming), locations)
    return series.fill_missing_weather(both, begin, end)


def _level_parts(pairs: DataFrame, levels: DataFrame, lags: Sequence[int]) -> DataFrame:
    """(location, as_of, lag01__level__m, values): the levels at the lags, filled within the window
    of the longest one: the last level before, else the first of the window."""
    span = max(lags)
    looks = {f"_l{n}": Look(F.col(LEVEL), -span, -n) for n in {1, *lags}}
    looks["_first"] = Look(F.col(LEVEL), -span, -1, newest=False)
    found = look(pairs, levels.select("location", "date", LEVEL), looks)
    level = lambda n: F.coalesce(F.col(f"_l{n}.value"), F.col("_first.value"))
    return found.select("location", "as_of", level(1).alias(features.LAG1), F.array(*[level(n) for n in lags]).alias("values"))


def _weather_parts(pairs: DataFrame, history: DataFrame, forecast: DataFrame, lags: Sequence[int], today) -> DataFrame:
    """(location, as_of, values): the shifted precipitation.

    History serves the days up to yesterday, the forecast those from the reference day; on a day both
    serve, the forecast's row wins.  A location without a single row in one of the two, where it is
    needed, gives NULLs.
    """
    top, low = max(lags), min(lags)
    now = F.col("as_of") if today is None else as_date(today)
    ahead = F.date_sub("as_of", low) >= now
    if today is not None:
        # Requests that reach today take history up to yesterday, and others end before today anyway.
        history = history.filter(F.col("date") < now)
    past = history.select("location", "date", F.struct(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in RAIN]).alias("_h"))
    coming = forecast.select("location", "date", F.struct(*RAIN).alias("_f"))
    rows = past.unionByName(coming, allowMissingColumns=True)
    # The last day of history that a look may reach: without a run day that is the one before the request.
    upto = lambda n: -n if today is not None else min(-n, -1)
    h, bare = F.col("_h"), F.when(~F.col("_forecast_too"), F.col("_h"))
    looks = {f"_h{i}": Look(h, -top, upto(n)) for i, n in enumerate(lags)}
    looks |= {"_before": Look(h, -top, -1), "_past": Look(h, -top, upto(low)), "_coming": Look(F.col("_f"), 0, -low)}
    for i, n in enumerate(lags):
        if n <= 0:
            looks |= {f"_f{i}_{c}": Look(F.col("_f")[c], 0, -n) for c in RAIN}
            looks[f"_b{i}"] = Look(bare, 0, -n)
    found = look(pairs, rows, looks, same_day={"_forecast_too": F.max(F.col("_f").isNotNull())})

    def value(i, n, c):
        history_only = F.coalesce(F.col(f"_h{i}.value.{c}"), F.lit(0.0))
        if n > 0:
            return history_only
        f, b = F.col(f"_f{i}_{c}"), F.col(f"_b{i}")
        merged = F.when(b["day"].isNull() | (f["day"] > b["day"]), f["value"])
        if today is None:
            merged = f["value"]
        else:
            merged = F.coalesce(merged, b["value"][c])
        return F.when(ahead, F.coalesce(merged, F.col(f"_before.value.{c}"), F.lit(0.0))).otherwise(history_only)

    served = (F.col("_past").isNotNull() | (F.date_sub("as_of", top) >= now)) & (F.col("_coming").isNotNull() | ~ahead)
    values = [F.when(served, value(i, n, c)) for i, n in enumerate(lags) for c in RAIN]
    return found.select("location", "as_of", F.array(*values).alias("values"))


def inference_features(
    mapping: DataFrame,
    wanted: DataFrame,
    levels: DataFrame,
    history: DataFrame,
    forecast: DataFrame,
    station_lags: Sequence[int] = STATION_LAGS,
    weather_lags: Sequence[int] = WEATHER_LAGS,
    today=None,
    between=None,
) -> DataFrame:
    """Feature rows for (station, as_of) pairs, as ``feature_matrix(infer=True)`` would give for the
    filled inputs of each single day.  Pairs with an empty source give no row.

    ``between``, the first and last ``as_of``, lets the scans of the series skip all other days.
    """
    if between is not None:
        first, last = as_date(between[0]), as_date(between[1])
        cut = lambda df, lags, end: df.filter(F.col("date").between(F.date_sub(first, max(lags)), end))
        levels = cut(levels, station_lags, last)
        history, forecast = (cut(df, weather_lags, F.date_sub(last, min(weather_lags))) for df in (history, forecast))
    pairs = wanted.select("station", "as_of").distinct()
    places = features.sources(mapping)
    level_spots = pairs.join(features.level_sources(places), "station")
    weather_spots = pairs.join(features.weather_sources(places), "station")
    lagged = _level_parts(level_spots.select("location", "as_of").distinct(), levels, station_lags)
    moved = _weather_parts(weather_spots.select("location", "as_of").distinct(), history, forecast, weather_lags, today)

    def rows(values, spots, *held):
        return values.join(spots, ["location", "as_of"]).select("station", F.col("as_of").alias("date"), "role", "pos", "n_sources", *held, "values")

    own = lambda e, name: F.when(F.col("role") == features.OWN, e).alias(name)
    level_part = rows(lagged, level_spots, own(F.lit(0.0), LEVEL), own(F.col(features.LAG1), features.LAG1))
    joined = features.join_on_date([level_part, rows(moved, weather_spots)])
    return features.with_dates(joined.filter(features.complete_features()))


def infer_batch(
    mapping: DataFrame,
    grid: DataFrame,
    levels: DataFrame,
    history: DataFrame,
    forecast: DataFrame,
    predictors: Mapping[str, Predictor],
    station_lags: Sequence[int] = STATION_LAGS,
    weather_lags: Sequence[int] = WEATHER_LAGS,
    today=None,
    between=None,
    keep_missing: bool = False,
) -> DataFrame:
    """Predictions for a grid of (station, as_of, forecast_days, model_type).

    Features depend on station and day only, so they are computed once for all horizons and models.
    A predictor takes feature rows with ``forecast_days`` and adds ``y``, the predicted difference.
    Grid rows whose inputs are incomplete, or whose level is no number, give no prediction:
    ``failed_items`` lists them.  ``keep_missing`` keeps the latter, with a NULL level.
    """
    rows = inference_features(mapping, grid, levels, history, forecast, station_lags, weather_lags, today, between)
    items = grid.withColumnsRenamed({"station": "location", "as_of": "date"})
    out = None
    for kind, predict in predictors.items():
        mine = items.filter(F.col("model_type") == kind).select("location", "date", "forecast_days")
        scored = evaluation.predict_level(predict(rows.join(mine, ["location", "date"])))
        scored = scored.withColumn("level_m", nan_to_null("level_m"))
        part = (scored if keep_missing else scored.filter(F.col("level_m").isNotNull())).select(
            F.col("location").alias("location_name"),
            "date",
            model_name(F.lit(PREPROCESSOR), F.col("forecast_days"), F.lit(kind), F.col("location")).alias("ml_model_name"),
            "forecast_days",
            "level_m",
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no predictors given")
    return out


def window_days(mapping: DataFrame, levels: DataFrame, history: DataFrame, forecast: DataFrame, as_of, station_lags: Sequence[int] = STATION_LAGS, weather_lags: Sequence[int] = WEATHER_LAGS) -> DataFrame:
    """(station, location, source, expected, found): days each source has in the windows of a reference day.

    Missing days are filled as long as there is one: ``found = 0`` is what stops a prediction.
    """
    day = as_date(as_of)
    spans = (
        ("level", "upstream_stations", levels, F.date_sub(day, max(station_lags)), F.date_sub(day, 1)),
        ("history", "weather_locations", history, F.date_sub(day, max(weather_lags)), F.date_sub(day, max(1, min(weather_lags)))),
        ("forecast", "weather_locations", forecast, day, F.date_sub(day, min(*weather_lags, 0))),
    )
    parts = [features.completeness(mapping, *span).select("station", "location", F.lit(source).alias("source"), "expected", "found") for source, *span in spans]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def failed_items(grid: DataFrame, predictions: DataFrame) -> DataFrame:
    """Grid rows without a prediction."""
    name = model_name(F.lit(PREPROCESSOR), F.col("forecast_days"), F.col("model_type"), F.col("station"))
    asked = grid.select(F.col("station").alias("location_name"), F.col("as_of").alias("date"), name.alias("ml_model_name"), "forecast_days", "model_type")
    return asked.join(predictions.select("location_name", "date", "ml_model_name"), ["location_name", "date", "ml_model_name"], "left_anti")


def missing_predictions(predictions: DataFrame, stations: DataFrame, begin, end) -> DataFrame:
    """(station, as_of) for every day without a prediction that has a level."""
    known = predictions.select(F.col("location_name").alias("location"), "date", "level_m")
    gaps = series.missing_dates(known, begin, end, value="level_m", locations=stations.select(F.col("station").alias("location")))
    return gaps.select(F.col("location").alias("station"), F.col("date").alias("as_of"))


def catchup_report(predictions: DataFrame, stations: DataFrame, begin, end) -> DataFrame:
    """What a catch-up has to do: the runs of missing days of each station, with its last prediction."""
    work = missing_predictions(predictions, stations, begin, end).withColumnsRenamed({"station": "location", "as_of": "date"})
    last = quality.last_date_per_location(predictions.withColumnRenamed("location_name", "location"), "level_m", key="location")
    return series.gap_islands(work).join(last, "location", "left")
