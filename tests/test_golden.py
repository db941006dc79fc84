"""Feature and inference frames worked out by hand, compared by value."""

import datetime as dt
import math

import pytest

from thalweg.operators import features
from thalweg.plans import inference

MAPPING = "station string, location string, river string, upstream_stations array<string>, weather_locations array<string>"
LEVELS = "location string, date date, level__m double"
RAIN = "location string, date date, precipitation_sum double, precipitation_hours double"


def day(n):
    return dt.date(2021, 1, n)


@pytest.fixture
def small(spark):
    mapping = spark.createDataFrame([("S1", "S1", "r", ["S1"], ["W1"])], MAPPING)
    levels = spark.createDataFrame(
        [("S1", day(i), v) for i, v in ((1, 10.0), (2, 11.0), (3, 13.0))] + [("S2", day(i), v) for i, v in ((1, 23.0), (2, 24.0), (3, 25.0))], LEVELS
    )
    rain = spark.createDataFrame([("W1", day(i), i / 10, float(i)) for i in (1, 2, 3)], RAIN)
    return mapping, levels, rain


def wide(matrix, up, wx, station_lags, weather_lags):
    names = features.feature_names(up, wx, station_lags, weather_lags)
    return names, [r.asDict() for r in features.widen(matrix, names).orderBy("location", "date").collect()]


def check_dates(row):
    month, n = row["date"].month, row["date"].timetuple().tm_yday
    assert (row["month"], row["dayofyear"]) == (month, n)
    assert row["month_sin"] == pytest.approx(math.sin(2 * math.pi * (month - 1) / 12))
    assert row["month_cos"] == pytest.approx(math.cos(2 * math.pi * (month - 1) / 12))
    assert row["dayofyear_sin"] == pytest.approx(math.sin(2 * math.pi * (n - 1) / 365))
    assert row["dayofyear_cos"] == pytest.approx(math.cos(2 * math.pi * (n - 1) / 365))


@pytest.mark.parametrize(
    "weather_lags, horizon, expected",
    [
        ([1, 0], 1, [(day(2), 11, 10, 10, 0.1, 1, 0.2, 2, 1), (day(3), 13, 11, 11, 0.2, 2, 0.3, 3, 2)]),
        ([1, 0, -1], 1, [(day(2), 11, 10, 10, 0.1, 1, 0.2, 2, 0.3, 3, 1)]),
        ([0, -1], 2, [(day(2), 13, 10, 10, 0.2, 2, 0.3, 3, 3)]),
    ],
)
def test_training_frames(small, weather_lags, horizon, expected):
    mapping, levels, rain = small
    matrix = features.feature_matrix(mapping, levels, rain, [1], weather_lags, horizon)
    names, rows = wide(matrix, ["S1"], ["W1"], [1], weather_lags)
    assert [(r["date"], r["level__m"], *[r[n] for n in names], r["y"]) for r in rows] == expected
    for r in rows:
        check_dates(r)


def test_several_horizons_are_each_the_single_one(small):
    mapping, levels, rain = small
    both = features.training_matrix(mapping, levels, rain, [1, 2], [1], [0])
    for h in (1, 2):
        single = features.feature_matrix(mapping, levels, rain, [1], [0], h)
        some = both.filter(both.forecast_days == h).drop("forecast_days")
        assert sorted(map(str, some.collect())) == sorted(map(str, single.collect())) != []


def test_column_names(small):
    names = features.feature_names(["S1"], ["W 1"], [1], [1, 0, -1])
    assert names[:2] == ["lag01__level__m", "s1__lag01__level__m"]
    assert names[2:] == [
        "w_1__lag01__precipitation_sum", "w_1__lag01__precipitation_hours", "w_1__forecast01__precipitation_sum",
        "w_1__forecast01__precipitation_hours", "w_1__forecast02__precipitation_sum", "w_1__forecast02__precipitation_hours",
    ]


D = dt.date(2024, 5, 10)


def at(n):
    return D + dt.timedelta(days=n)


def test_inference_frame_minimal(spark):
    mapping = spark.createDataFrame([("S1", "S1", "r", ["S1"], ["W1"])], MAPPING)
    levels = spark.createDataFrame([("S1", D, 0.0), ("S1", at(-1), 1.0)], LEVELS)
    rain = spark.createDataFrame([("W1", D, 0.1, 1.1)], RAIN)
    matrix = features.feature_matrix(mapping, levels, rain, [1], [0], 1, infer=True)
    names, rows = wide(matrix, ["S1"], ["W1"], [1], [0])
    assert [(r["date"], r["level__m"], *[r[n] for n in names]) for r in rows] == [(D, 0.0, 1.0, 1.0, 0.1, 1.1)]


def two_sources(spark):
    mapping = spark.createDataFrame([("S1", "S1", "r", ["S1", "S2"], ["W1", "W2"])], MAPPING)
    past = [(f"S{i}", at(n), i + v) for i in (1, 2) for n, v in ((-3, 0.0), (-2, 0.1), (-1, 0.2))]
    levels = spark.createDataFrame(past + [("S1", D, 0.0), ("S2", D, 0.0)], LEVELS)
    rain = spark.createDataFrame(
        [(w, at(n), (n + 4) / 10, float(n + 4 + shift)) for w, shift in (("W1", 0), ("W2", 10)) for n in range(-3, 2)], RAIN
    )
    return mapping, levels, rain


EXPECTED = {
    "lag01__level__m": 1.2, "lag03__level__m": 1.0, "s1__lag01__level__m": 1.2, "s1__lag03__level__m": 1.0,
    "s2__lag01__level__m": 2.2, "s2__lag03__level__m": 2.0,
    "w1__lag01__precipitation_sum": 0.3, "w1__lag03__precipitation_sum": 0.1, "w1__forecast01__precipitation_sum": 0.4, "w1__forecast02__precipitation_sum": 0.5,
    "w1__lag01__precipitation_hours": 3, "w1__lag03__precipitation_hours": 1, "w1__forecast01__precipitation_hours": 4, "w1__forecast02__precipitation_hours": 5,
    "w2__lag01__precipitation_sum": 0.3, "w2__lag03__precipitation_sum": 0.1, "w2__forecast01__precipitation_sum": 0.4, "w2__forecast02__precipitation_sum": 0.5,
    "w2__lag01__precipitation_hours": 13, "w2__lag03__precipitation_hours": 11, "w2__forecast01__precipitation_hours": 14, "w2__forecast02__precipitation_hours": 15,
}


def named(row):
    names = features.feature_names(["S1", "S2"], ["W1", "W2"], [3, 1], [3, 1, 0, -1])
    return dict(zip(names, row["features"], strict=True))


def test_inference_frame_two_upstream_two_weather(spark):
    matrix = features.feature_matrix(*two_sources(spark), [3, 1], [3, 1, 0, -1], 1, infer=True)
    rows = matrix.collect()
    assert len(rows) == 1 and rows[0]["date"] == D and rows[0]["level__m"] == 0.0
    assert named(rows[0]) == pytest.approx(EXPECTED)


def test_bulk_inference_gives_the_single_day_frame(spark):
    mapping, levels, rain = two_sources(spark)
    import pyspark.sql.functions as F

    wanted = spark.createDataFrame([("S1", D)], "station string, as_of date")
    history, forecast = rain.filter(F.col("date") < F.lit(D)), rain.filter(F.col("date") >= F.lit(D))
    rows = inference.inference_features(mapping, wanted, levels, history, forecast, [3, 1], [3, 1, 0, -1]).collect()
    assert len(rows) == 1 and rows[0]["level__m"] == 0.0 and rows[0]["lag01__level__m"] == 1.2
    assert named(rows[0]) == pytest.approx(EXPECTED)


def test_bulk_inference_equals_the_composition_day_by_day(spark, sf):
    """inference_features over many days = filled inputs and feature_matrix for each day alone."""
    from pyspark.sql import functions as F

    from thalweg import fixtures as fx

    lags, wlags = [1, 3, 7], [14, 1, 0, -6]
    mapping, levels, rain = fx.station_mapping(spark, sf).cache(), fx.levels(spark, sf).cache(), fx.rain(spark, sf).cache()
    forecast = fx.rain_forecast(spark, sf).cache()
    days = [dt.date(2001, 6, 20), dt.date(2001, 6, 28), dt.date(2001, 7, 3)]
    grid = spark.createDataFrame([(d,) for d in days], "as_of date").crossJoin(mapping.select("station"))
    bulk = {(r["location"], r["date"]): r["features"] for r in inference.inference_features(mapping, grid, levels, rain, forecast, lags, wlags).collect()}
    assert bulk
    spots = features.edges(mapping, "weather_locations")
    singles = {}
    for d in days:
        lv = inference.inference_levels(levels, mapping.select("location"), d, lags)
        wx = inference.inference_weather(rain, forecast, spots, d, wlags)
        m = features.feature_matrix(mapping, lv, wx, lags, wlags, 1, infer=True).filter(F.col("date") == F.lit(d))
        singles.update({(r["location"], r["date"]): r["features"] for r in m.collect()})
    assert set(bulk) <= set(singles)
    for key, got in bulk.items():
        assert got == singles[key]


def test_index_names_agree(spark):
    mapping = two_sources(spark)[0]
    row = features.feature_index(mapping, [3, 1], [3, 1, 0, -1]).first()
    assert row["names"] == features.feature_names(["S1", "S2"], ["W1", "W2"], [3, 1], [3, 1, 0, -1])


def test_inference_levels_bounds_and_placeholder(spark):
    rows = [(p, at(-n), 10.0 * k + n) for k, p in enumerate(("loc1", "loc2")) for n in (1, 2, 3, 4)]
    levels = spark.createDataFrame(rows, LEVELS)
    places = spark.createDataFrame([("loc1",), ("loc2",)], "location string")
    got = {(r["location"], r["date"]): r["level__m"] for r in inference.inference_levels(levels, places, D, [1, 2, 3]).collect()}
    want = {(p, d): v for p, d, v in rows if d >= at(-3)} | {("loc1", D): 0.0, ("loc2", D): 0.0}
    assert got == want and len(got) == 8


def test_sources_without_rows_are_named(spark, small):
    mapping, levels, rain = small
    with pytest.raises(ValueError, match="weather location W1"):
        features.require_sources(mapping, levels, rain.filter("location = 'none'"))
    with pytest.raises(ValueError, match="S1"):
        features.require_sources(mapping, levels.filter("location = 'none'"), rain)
    features.require_sources(mapping, levels, rain)


def test_lag_one_is_required_for_training(small):
    with pytest.raises(ValueError, match="lag 1"):
        features.feature_matrix(*small, [3], [0], 1)
