"""Inference in bulk beside brute force, and the daily job on good, late, broken and absent inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from thalweg.operators import features, models, series
from thalweg.plans import inference, operations
from thalweg.schema import STATION_SERIES, WEATHER_SERIES
from thalweg.session import fresh_path

D = dt.date(2024, 3, 1)
LAGS, WLAGS = [1, 3], [4, 1, 0, -2]


def at(n):
    return D + dt.timedelta(days=n)


def frames(spark, seed, null_share=0.0):
    """A station, its own level and two weather locations with gaps; the forecast overlaps the history."""
    r = random.Random(seed)
    some = lambda lo, hi, share: [n for n in range(lo, hi) if r.random() < share]
    value = lambda: None if r.random() < null_share else float(r.randint(1, 99))
    mapping = spark.createDataFrame([("S", "S", ["S", "U"], ["W", "V"])], "station string, location string, upstream_stations array<string>, weather_locations array<string>")
    levels = {(p, at(n)): float(r.randint(1, 99)) for p in "SU" for n in some(-12, 12, 0.5)}
    history = {(p, at(n)): (value(), value()) for p in "WV" for n in some(-12, 9, 0.5)}
    forecast = {(p, at(n)): (value(), value()) for p in "WV" for n in some(-6, 12, 0.5)}
    make = lambda d, schema: spark.createDataFrame([(*k, *(v if isinstance(v, tuple) else (v,))) for k, v in d.items()], schema)
    return mapping, levels, history, forecast, make(levels, STATION_SERIES), make(history, WEATHER_SERIES), make(forecast, WEATHER_SERIES)


def by_hand(levels, history, forecast, as_of, today):
    """The features of station S on one day, or None where a source is lacking."""
    day = lambda n: as_of + dt.timedelta(days=n)
    out = []
    for place, lags in (("S", LAGS), ("S", LAGS), ("U", LAGS)):
        window = [levels.get((place, day(-n))) for n in range(max(LAGS), 0, -1)]
        known = [v for v in window if v is not None]
        if not known:
            return None
        filled, last = [], known[0]
        for v in window:
            last = last if v is None else v
            filled.append(last)
        out += [filled[max(LAGS) - n] for n in lags]
    now = as_of if today is None else today
    ahead = day(-min(WLAGS)) >= now
    for place in "WV":
        cells, past, coming = {}, 0, 0
        for n in range(-max(WLAGS), -min(WLAGS) + 1):
            h = history.get((place, day(n))) if not ahead or day(n) < now else None
            f = forecast.get((place, day(n))) if ahead and n >= 0 else None
            past, coming = past + (h is not None), coming + (f is not None)
            cells[n] = f if f is not None else tuple(0.0 if v is None else v for v in h) if h is not None else (None, None)
        if not ((past or day(-max(WLAGS)) >= now) and (coming or not ahead)):
            return None
        for n in WLAGS:
            for c in (0, 1):
                known = [cells[k][c] for k in range(-max(WLAGS), -n + 1) if cells[k][c] is not None]
                out.append(known[-1] if known else 0.0)
    return out


@pytest.mark.parametrize("today", [None, at(-3), at(0), at(2)])
def test_inference_features_are_brute_force(spark, today):
    for seed in range(3):
        mapping, levels, history, forecast, *dfs = frames(spark, seed, null_share=0.3)
        days = [at(n) for n in range(-8, 9)]
        wanted = spark.createDataFrame([("S", d) for d in days], "station string, as_of date")
        made = inference.inference_features(mapping, wanted, *dfs, LAGS, WLAGS, today=today)
        got = {r["date"]: r["features"] for r in made.collect()}
        want = {d: by_hand(levels, history, forecast, d, today) for d in days}
        assert got == {d: v for d, v in want.items() if v is not None}
        assert len(got) > 3


def test_inference_lays_out_no_windows(spark):
    """One exchange of the requests and rows per series before the windows, and no generated days."""
    mapping, *_, levels, history, forecast = frames(spark, 1)
    wanted = spark.createDataFrame([("S", D)], "station string, as_of date")
    places = wanted.withColumnRenamed("station", "location")
    for parts in (inference._level_parts(places, levels, LAGS), inference._weather_parts(places, history, forecast, WLAGS, None)):
        plan = parts._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "Join" not in plan
        physical = parts._jdf.queryExecution().sparkPlan().toString()
        assert physical.count("Window [") <= 3


PREDICT = models.linear_predictor(features.level_names(LAGS), {series.shift_name(1, series.LEVEL): 1.0})
SPREAD = "station_name string, station_number string, moderate double, high double, full_level double"


@pytest.fixture()
def run(spark):
    mapping, *_, levels, history, forecast = frames(spark, 5)
    thresholds = spark.createDataFrame([("S", "1", 1.0, 2.0, 3.0)], SPREAD)
    tables = operations.daily_tables(spark, fresh_path(spark, "daily"))

    def go(landed, day=D, predictors=None, ahead=5):
        status, alerts = operations.daily_pipeline(tables, landed, mapping, thresholds, predictors or {"Prophet_001": PREDICT}, [1], day, LAGS, WLAGS, ahead)
        return {(r["phase"], r["item"], r["outcome"]): r["n"] for r in status.collect()}, alerts

    full = forecast.filter(F.col("date") < F.lit(at(-6)))
    every = spark.createDataFrame([(p, at(n), 1.0, 2.0) for p in "WV" for n in range(0, 8)], WEATHER_SERIES)
    return go, tables, {"levels": levels.filter(F.col("date") < F.lit(D)), "history": history.filter(F.col("date") < F.lit(D)), "forecast": full.unionByName(every)}


def test_daily_run(run):
    go, tables, landed = run
    status, alerts = go(landed)
    assert status["ingest", "levels", "ok"] == landed["levels"].count()
    assert status["predict", "S", "ok"] == 1 and status["risk", "full", "assessed"] == 1
    kept = tables.predictions.read().collect()
    assert [(r["location_name"], r["date"], r["risk_level"]) for r in kept] == [("S", D, "full")]
    assert [(r["Station"], r["Prediction date"]) for r in alerts.collect()] == [("S", D)]
    # Once more: nothing is doubled, and a reader of the day before still reads.
    before = tables.predictions.read()
    again, _ = go(landed)
    assert again == status and before.count() == tables.predictions.read().count() == 1


def test_daily_run_with_a_broken_and_an_absent_source(run, spark):
    go, tables, landed = run
    go(landed)
    held = tables.levels.read().count()
    broken = landed["levels"].withColumn("level__m", F.raise_error(F.lit("bad file")).cast("double"))
    status, alerts = go({"levels": broken, "forecast": landed["forecast"]})
    assert status["ingest", "levels", "failed"] == 0 and status["ingest", "history", "absent"] == 0 and status["ingest", "forecast", "ok"] > 0
    assert tables.levels.read().count() == held and status["predict", "S", "ok"] == 1 and alerts.count() == 1


def test_daily_run_stops_at_a_stale_forecast(run):
    go, tables, landed = run
    status, alerts = go(landed, ahead=30)
    assert status["forecast", "all", "stale"] == 0 and alerts is None and tables.predictions.read().count() == 0


def test_daily_run_reports_what_it_could_not_predict(run):
    go, tables, landed = run
    missing = lambda rows: rows.withColumn("y", F.lit(float("nan")))
    status, alerts = go(landed, predictors={"Prophet_001": missing})
    assert status["predict", "S", "failed"] == 1 and status["predict", "all", "nothing"] == 0 and alerts.count() == 0


def test_days_lacking_are_counted(run, spark):
    go, tables, landed = run
    status, _ = go(landed)
    have = {(r["location"], r["date"]) for r in landed["levels"].collect()}
    rain = {(r["location"], r["date"]) for r in landed["history"].collect()}
    lacking = sum((p, at(-n)) not in have for p in "SU" for n in range(1, 4)) + sum((p, at(-n)) not in rain for p in "WV" for n in range(1, 5))
    assert status.get(("inputs", "S", "days missing"), 0) == lacking > 0


def test_a_day_is_predicted_or_refused(run, spark):
    go, tables, landed = run
    go(landed)
    mapping = spark.createDataFrame([("S", "S", ["S", "U"], ["W", "V"])], "station string, location string, upstream_stations array<string>, weather_locations array<string>")
    levels, history, forecast = (t.read() for t in (tables.levels, tables.history, tables.forecast))
    day = lambda lv=levels, h=history, f=forecast, p=PREDICT: operations.predict_day(mapping, lv, h, f, {"Prophet_001": p}, [1, 7], D, LAGS, WLAGS)
    assert sorted(r["forecast_days"] for r in day().collect()) == [1, 7]
    with pytest.raises(ValueError, match="station S: no level data of U"):
        day(lv=levels.filter("location <> 'U'"))
    with pytest.raises(ValueError, match="no forecast data of V"):
        day(f=forecast.filter("location <> 'V'"))
    with pytest.raises(ValueError, match="no history data of V"):
        day(h=history.filter("location <> 'V'"))
    with pytest.raises(RuntimeError, match="2 predicted levels are missing"):
        day(p=lambda rows: rows.withColumn("y", F.lit(float("nan"))))
    with pytest.raises(RuntimeError, match="no prediction"):
        day(p=lambda rows: rows.withColumn("y", F.lit(0.0)).limit(0))


def test_bad_rows_are_dropped_and_bad_shapes_refused(run):
    go, tables, landed = run
    holes = landed["levels"].unionByName(landed["levels"].limit(3).withColumn("date", F.lit(None).cast("date")))
    status, _ = go(landed | {"levels": holes, "history": landed["history"].drop("precipitation_sum")})
    assert status["ingest", "levels", "dropped"] == 3 and status["ingest", "levels", "ok"] == landed["levels"].count()
    assert status["ingest", "history", "failed"] == 0
