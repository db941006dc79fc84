"""Behaviour that the table comparisons do not reach: errors, repeated runs, parsing details, plans."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.functions import dates, numbers, text
from thalweg.operators import asof, daymaps, evaluation, features, indicators, models, quality, risk, series, state
from thalweg.schema import MODELLING_FIXED, MODELLING_PATTERNS, STATION_SERIES, conform
from thalweg.session import fresh_path
from thalweg.sources import payloads, sinks, tables

D0 = dt.date(2020, 1, 1)


def at(n):
    return D0 + dt.timedelta(days=n)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def brute_fill(points, begin, end, leading):
    """Reference fill over (offset, value) pairs of one location."""
    have = dict(points)
    out, last = {}, None
    keys = sorted(set(have) | set(range(begin, end + 1)))
    for k in keys:
        v = have.get(k)
        last = v if v is not None else last
        out[k] = last
    first = next((have[k] for k in sorted(have) if have[k] is not None), None) if leading is None else leading
    return {k: first if v is None else v for k, v in out.items()}


point = st.tuples(st.integers(0, 25), st.one_of(st.none(), st.floats(0, 9, allow_nan=False)))


@settings(max_examples=6, deadline=None)
@given(groups=st.lists(st.lists(point, min_size=1, max_size=12, unique_by=lambda p: p[0]), min_size=1, max_size=4), begin=st.integers(-3, 8), size=st.integers(0, 20))
@pytest.mark.parametrize("leading", [None, 0.0])
def test_fill_missing_days_against_brute_force(spark, groups, begin, size, leading):
    data = [(f"L{i}", at(o), v) for i, g in enumerate(groups) for o, v in g]
    df = spark.createDataFrame(data, "location string, date date, v double")
    got = {(r["location"], r["date"]): r["v"] for r in series.fill_missing_days(df, ["v"], at(begin), at(begin + size), leading).collect()}
    want = {(f"L{i}", at(k)): v for i, g in enumerate(groups) for k, v in brute_fill(g, begin, begin + size, leading).items()}
    assert got == want


def test_fill_is_idempotent_and_covers_absent_locations(spark):
    df = spark.createDataFrame([("a", at(2), 1.0), ("a", at(5), 3.0)], "location string, date date, level__m double")
    once = series.fill_missing_levels(df, at(0), at(7))
    assert rows_of(series.fill_missing_levels(once, at(0), at(7))) == rows_of(once)
    places = spark.createDataFrame([("a",), ("b",)], "location string")
    both = series.fill_missing_levels(df, at(0), at(7), locations=places)
    assert both.filter("location = 'b' AND level__m IS NULL").count() == 8


def test_islands_sum_to_missing_days(spark, sf):
    levels = fx.levels(spark, sf)
    gaps = series.missing_dates(levels, fx.BEGIN, fx.END)
    total = gaps.groupBy("location").agg(F.count("*").alias("n"))
    assert rows_of(series.gap_islands(gaps).groupBy("location").agg(F.sum("days").alias("n"))) == rows_of(total)
    assert rows_of(series.gaps_between(levels, fx.BEGIN, fx.END)) == rows_of(series.gap_islands(gaps))


def test_missing_dates_of_a_location_without_rows(spark):
    df = spark.createDataFrame([("a", at(1), 1.0), ("a", at(2), None)], "location string, date date, v double")
    places = spark.createDataFrame([("a",), ("b",)], "location string")
    got = rows_of(series.missing_dates(df, at(0), at(2), value="v", locations=places))
    assert got == [("a", at(0)), ("a", at(2)), ("b", at(0)), ("b", at(1)), ("b", at(2))]


def test_dedup_does_not_depend_on_order(spark):
    data = [("a", at(0), float(i), i % 3) for i in range(30)]
    make = lambda d: spark.createDataFrame(d, "location string, date date, v double, load_seq int").repartition(7)
    assert rows_of(series.dedup_keep_last(make(data))) == rows_of(series.dedup_keep_last(make(data[::-1]))) == [("a", at(0), 29.0, 2)]


def test_upsert_twice_is_upsert_once(spark, sf):
    old, new = fx.weather(spark, sf, end="2001-06-01"), fx.weather(spark, sf, begin="2001-05-01")
    once = state.upsert_latest(old, new)
    assert rows_of(state.upsert_latest(once, new)) == rows_of(once)


def test_insert_keeps_batch_duplicates_unless_told(spark):
    schema = "location_name string, date date, level_m double"
    old = spark.createDataFrame([("a", at(0), 1.0)], schema)
    new = spark.createDataFrame([("a", at(0), 2.0), ("a", at(1), 3.0), ("a", at(1), 4.0)], schema)
    assert rows_of(state.insert_if_absent(old, new)) == [("a", at(0), 1.0), ("a", at(1), 3.0), ("a", at(1), 4.0)]
    assert state.insert_if_absent(old, new, distinct_batch=True).count() == 2


def test_repeated_prediction_keeps_risk_and_reassess_changes_it(spark):
    dim = spark.createDataFrame([("a", "S", 2.0, 3.0, 4.0)], "station_name string, station_number string, moderate double, high double, full_level double")
    p = spark.createDataFrame([("a", 5.0, "low"), ("a", 5.0, None), ("z", 5.0, None), ("a", None, None)], "location_name string, level_m double, risk_level string")
    assert sorted(map(str, [r["risk_level"] for r in risk.classify(p, dim).collect()])) == ["None", "None", "full", "low"]
    assert sorted(map(str, [r["risk_level"] for r in risk.classify(p, dim, reassess=True).collect()])) == ["None", "None", "full", "full"]


@pytest.mark.parametrize("level, band", [(1.9, "low"), (2.0, "moderate"), (3.0, "high"), (4.0, "full"), (99.0, "full")])
def test_bands_are_half_open(spark, level, band):
    assert spark.range(1).select(risk.risk_band(F.lit(level), F.lit(2.0), F.lit(3.0), F.lit(4.0))).first()[0] == band


def test_literal_summary_counts_capitals_only(spark, sf):
    p = fx.predictions(spark, sf)
    free, literal = (risk.risk_summary(p, "2001-01-31", literal=x).agg(F.sum("low_risk_count")).first()[0] for x in (False, True))
    assert 0 < literal < free


def test_snapshot_table_versions(spark):
    store = state.SnapshotTable(spark, fresh_path(spark, "snap"), STATION_SERIES)
    assert store.version() == 0 and store.read().count() == 0
    store.commit(spark.createDataFrame([("a", at(0), 1.0)], STATION_SERIES))
    store.commit(store.read().withColumn("level__m", F.col("level__m") + 1))
    assert store.version() == 2 and rows_of(store.read()) == [("a", at(0), 2.0)]


def test_period_table_touches_only_the_months_of_a_batch(spark):
    schema = spark.createDataFrame([], "location_name string, date date, level_m double").schema
    make = lambda rows: spark.createDataFrame(rows, schema)
    store = state.PeriodTable(spark, fresh_path(spark, "monthly"), schema)
    assert store.read().count() == 0
    first = [("a", at(0), 1.0), ("a", at(40), 2.0), ("b", at(75), 3.0)]
    assert store.merge(make(first), state.upsert_latest) == 3
    before = {f for f in store.read().inputFiles() if "2020-02" not in f}
    change = make([("a", at(40), 9.0), ("c", at(41), 4.0)])
    for _ in range(2):
        assert store.merge(change, state.upsert_latest) == 1
    assert rows_of(store.read()) == sorted([("a", at(0), 1.0), ("a", at(40), 9.0), ("b", at(75), 3.0), ("c", at(41), 4.0)])
    assert {f for f in store.read().inputFiles() if "2020-02" not in f} == before
    assert rows_of(store.read(at(1), at(41))) == [("a", at(40), 9.0), ("c", at(41), 4.0)]
    assert store.merge(make([]), state.upsert_latest) == 0


def test_readers_survive_a_merge(spark):
    """A frame planned before a merge gives the table as it was; so do rows without a date, and a rule that empties a month."""
    schema = spark.createDataFrame([], "location_name string, date date, level_m double").schema
    make = lambda rows: spark.createDataFrame(rows, schema)
    store = state.PeriodTable(spark, fresh_path(spark, "kept"), schema)
    store.merge(make([("a", at(0), 1.0), ("a", at(40), 2.0), ("b", None, 5.0)]), state.upsert_latest)
    before = store.read()
    store.merge(make([("a", at(0), 7.0), ("b", None, 6.0)]), state.upsert_latest)
    assert sorted(map(str, before.collect())) == sorted(map(str, make([("a", at(0), 1.0), ("a", at(40), 2.0), ("b", None, 5.0)]).collect()))
    assert sorted(map(str, store.read().collect())) == sorted(map(str, make([("a", at(0), 7.0), ("a", at(40), 2.0), ("b", None, 6.0)]).collect()))
    store.merge(make([("a", at(40), 0.0)]), lambda old, new: old.limit(0))
    assert rows_of(store.read(at(0), at(99))) == [("a", at(0), 7.0)]
    with pytest.raises(ValueError, match="other periods"):
        store.merge(make([("a", at(40), 0.0)]), lambda old, new: new.withColumn("date", F.date_add("date", 90)))
    assert rows_of(store.read(at(0), at(99))) == [("a", at(0), 7.0)]


def as_of_by_hand(points, rows, since, upto, newest):
    out = {}
    for place, day in points:
        hits = [(d, v) for p, d, v in rows if p == place and v is not None and since <= (d - day).days <= upto]
        out[place, day] = (max if newest else min)(hits, key=lambda x: x[0], default=None)
    return out


@pytest.mark.parametrize("since, upto, newest", [(-5, -1, True), (-5, -5, True), (-3, 4, True), (0, 3, True), (-5, -1, False), (-2, 6, False), (1, 1, False)])
def test_as_of_looks(spark, since, upto, newest):
    import random

    r = random.Random(since * 7 + upto)
    days = {p: sorted(r.sample(range(60), 25)) for p in "ab"}
    rows = [(p, at(d), None if r.random() < 0.3 else float(d)) for p, ds in days.items() for d in ds]
    points = [(p, at(d)) for p in "abc" for d in range(-3, 64, 2)]
    df = spark.createDataFrame(rows, "location string, date date, v double")
    asked = spark.createDataFrame(points + points, "location string, as_of date")
    got = asof.look(asked, df, {"x": asof.Look(F.col("v"), since, upto, newest)}).collect()
    assert {(g["location"], g["as_of"]): tuple(g["x"]) if g["x"] else None for g in got} == as_of_by_hand(points, rows, since, upto, newest)
    assert len(got) == len(points)


def test_series_check(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(1))], "location string, date date")
    assert quality.require_unique(df) is df
    with pytest.raises(ValueError, match="2 rows for"):
        quality.require_unique(df.unionByName(df.limit(1)))


def test_conform(spark):
    df = spark.createDataFrame([("2020-01-01", "a", "1.5")], "date string, location string, level__m string")
    assert conform(df, STATION_SERIES).schema == STATION_SERIES
    with pytest.raises(ValueError, match="wrong types"):
        conform(df, STATION_SERIES, coerce=False)
    with pytest.raises(ValueError, match="unexpected"):
        conform(df.withColumn("more", F.lit(1)), STATION_SERIES)
    assert conform(df.withColumn("more", F.lit(1)), STATION_SERIES, strict=False).columns[-1] == "more"
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("date"), STATION_SERIES)
    with pytest.raises(ValueError, match="NULLs"):
        conform(df.withColumn("level__m", F.lit(None).cast("string")), STATION_SERIES)
    conform(df.withColumn("level__m", F.lit(None).cast("string")), STATION_SERIES, nullable=["level__m"])


def test_conform_modelling_frame(spark):
    names = ["location", "date", "level__m", "month_sin", "month_cos", "dayofyear_sin", "dayofyear_cos", "lag01__level__m", "w1__forecast01__precipitation_sum"]
    df = spark.createDataFrame([("a", D0, *[1.0] * 7)], names)
    assert conform(df, MODELLING_FIXED, patterns=MODELLING_PATTERNS).columns == names
    with pytest.raises(ValueError, match="unexpected"):
        conform(df.withColumn("w1__later__precipitation_sum", F.lit(1.0)), MODELLING_FIXED, patterns=MODELLING_PATTERNS)


def test_chart_skips_leap_day_and_takes_last_reading(spark):
    doc = """{"gaugeReadingList": [
        {"readingValue": "3.11", "longtermMean": null, "dateOfReadingStr": "01-01-2025"},
        {"readingValue": "3.25", "longtermMean": "1.0", "dateOfReadingStr": "01-01-2025"}],
      "indicator": {"moderateRiskLevelVal": "4.00", "highRiskLevelVal": "4.60", "bankFullVal": "5.20"},
      "previous_year": {"gaugeReadingList": {
        "01-01-2024": {"readingValue": "1.75", "dateOfReadingStr": "01-01-2024"},
        "02-01-2024": {"readingValue": "x", "dateOfReadingStr": "02-01-2024"},
        "29-02-2024": {"readingValue": "3.00", "dateOfReadingStr": "29-02-2024"}}}}"""
    df = spark.createDataFrame([("a", doc)], "location string, payload string")
    got = rows_of(payloads.gauge_chart(df).drop("bankfull", "highfloodrisk", "moderatefloodrisk").fillna(-1.0))
    assert got == [("a", dt.date(2025, 1, 1), 1.0, 1.75, 3.25), ("a", dt.date(2025, 1, 2), -1.0, -1.0, -1.0)]


def test_html_table(spark):
    rows = "".join(
        f"<tr><td>{n}</td><td>\n {s} </td><td>{d}</td><td><b>{v}</b></td></tr>"
        for n, (s, d, v) in enumerate(
            [("Ford", "07-03-2023", "2.5"), ("Nowhere", "07-03-2023", "9"), ("Weir", "07-03-2023", "n/a"), ("Ford", "06-03-2023", "7"),
             ("A", "x", "1"), ("B", "x", "1"), ("C", "x", "1"), ("Mill", "07-03-2023", "4")]
        )
    )
    head = "<thead><tr><th>#</th><th>Station</th><th>Date</th><th>Observed River Level (m)</th></tr></thead>"
    page = f'<html><table id="other"><tr><td>Ford</td></tr></table><table border=1 id="maps-data-grid">{head}{rows}</table></html>'
    pages = spark.createDataFrame([(1, page), (2, "<html></html>")], "page_id int, html string")
    dim = spark.createDataFrame([("Ford",), ("Weir",), ("Mill",)], "station_name string")
    day = dt.date(2023, 3, 7)
    read = lambda **o: sorted(((r["location_name"], r["date"], r["level_m"]) for r in payloads.gauge_table(pages, dim, **o).collect()))
    assert read(rows=7) == [("Ford", day, 2.5), ("Weir", day, None)]
    assert read() == [("Ford", day, 2.5), ("Mill", day, 4.0), ("Weir", day, None)]


def test_daily_payload_with_nan_and_empty_block(spark):
    good = '{"latitude": 1, "longitude": 2, "daily": {"start": 1731963600, "end": 1732136400, "interval": 86400, "precipitation_sum": [0.4, NaN], "temperature_2m_max": [30.5]}}'
    empty = '{"latitude": 1, "longitude": 2, "daily": {"start": 0, "end": 0, "interval": 86400, "precipitation_sum": []}}'
    df = spark.createDataFrame([("a", good), ("b", empty)], "location_name string, payload string")
    got = [(r["location_name"], r["date"], r["precipitation_sum"], r["temperature_2m_max"]) for r in payloads.weather_daily(df).orderBy("date").collect()]
    assert got == [("a", dt.date(2024, 11, 18), 0.4, 30.5), ("a", dt.date(2024, 11, 19), None, None)]
    local = payloads.weather_daily(df, tz="Africa/Nairobi").orderBy("date").first()
    assert local["date"] == dt.date(2024, 11, 19)


def test_portal_leap_day_goes_to_28_february(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 2, 29), 1.0, 2.0)], "location string, date date, previousreadingvalue double, readingvalue double")
    assert rows_of(tables.unpivot_portal(df)) == [(dt.date(2023, 2, 28), "a", 1.0, 2), (dt.date(2024, 2, 29), "a", 2.0, 1)]


def test_reconcile_priority_can_be_turned(spark):
    s = "date date, location string, level__m double"
    a, p = spark.createDataFrame([(D0, "a", 1.0)], s), spark.createDataFrame([(D0, "a", 2.0)], s)
    assert tables.reconcile(a, p).first()["level__m"] == 2.0
    assert tables.reconcile(a, p, archive_rank=2, portal_rank=1).first()["level__m"] == 1.0


def test_unknown_kinds_are_refused(spark):
    with pytest.raises(ValueError, match="unsupported"):
        tables.read_source(spark, "xml", "x")
    with pytest.raises(ValueError, match="unknown model"):
        models.model_kind("none")


def test_loaders_raise_on_missing_locations(spark):
    t = spark.createDataFrame([("a", dt.datetime(2020, 1, 1), 1.0, None, 1)], "location_name string, date timestamp, precipitation_sum double, precipitation_hours double, id int")
    assert rows_of(tables.load_history_weather(t, ["a"], D0, at(1), check=True)) == [("a", D0, 1.0, 0.0)]
    with pytest.raises(ValueError, match="no data for locations: \\['b'\\]"):
        tables.load_history_weather(t, ["a", "b"], D0, at(1), check=True)
    with pytest.raises(ValueError, match="last day 2020-01-01"):
        tables.load_forecast_weather(t, ["a"], at(1), at(2), check=True)


def test_upper_bound_option(spark):
    t = spark.createDataFrame([("a", dt.datetime(2020, 1, 2))], "location_name string, date timestamp")
    assert tables.filter_locations_dates(t, ["a"], D0, D0).count() == 0
    assert tables.filter_locations_dates(t, ["a"], D0, D0, inclusive_next_midnight=True).count() == 1


def test_lookup(spark):
    dim = spark.createDataFrame([("a", 1)], "name string, id int")
    assert tables.lookup(dim, "a").first()["id"] == 1
    with pytest.raises(ValueError):
        tables.lookup(dim, "b")


def test_export_force(spark):
    path = fresh_path(spark, "export")
    df = spark.range(10)
    assert sinks.export_table(df, path, "id < 3", preview_rows=2).count() == 2
    sinks.export_table(df, path)
    assert spark.read.option("header", "true").csv(path).count() == 3
    sinks.export_table(df, path, force_overwrite=True)
    assert spark.read.option("header", "true").csv(path).count() == 10


def test_newest_chart_export_is_found(spark):
    folder = fresh_path(spark, "charts")
    for hour in (9, 11, 10):  # the file written last is the newest, whatever its name says
        path = sinks.chart_export_path(folder, "Two Words", dt.datetime(2024, 3, 1, hour))
        spark.range(1).coalesce(1).write.csv(path)
    found = tables.latest_file_per_location(spark, folder, tables.portal_file_pattern("Two Words")).collect()
    assert [r["location"] for r in found] == ["two_words"] and "_as_at_20240301_100000.csv" in found[0]["path"]


def test_one_key_may_hold_most_rows(spark):
    """Copies of one (location, day) are combined before the shuffle, so it moves few rows."""
    hot = spark.range(200000).selectExpr("'hot' location", "date'2020-01-01' date", "cast(id as double) level__m", "id load_seq")
    rest = spark.range(1000).selectExpr("concat('l', id % 10) location", "date_add(date'2020-01-01', cast(id as int)) date", "1.0D level__m", "id load_seq")
    out = series.dedup_keep_last(hot.unionByName(rest))
    assert out.count() == 1001
    assert out.filter("location = 'hot'").first()["level__m"] == 199999.0
    assert "partial_max" in plan_of(out)


def test_model_name_round_trip(spark):
    names = ["Preprocessor_001-f7-XGBoost_001-Two Words.joblib", "p-f1-t-a-b.json", "p-fx-t-a", "p-f1-t", ""]
    parts = text.parse_model_name("n")
    got = spark.createDataFrame([(n,) for n in names], "n string").select(*[e.alias(k) for k, e in parts.items()]).collect()
    assert tuple(got[0]) == ("Preprocessor_001", 7, "XGBoost_001", "Two Words")
    assert tuple(got[1]) == ("p", 1, "t", "a-b")
    assert all(tuple(r) == (None,) * 4 for r in got[2:])


def test_direction_text(spark):
    df = spark.createDataFrame([(1.234,), (-0.5,), (0.0,), (None,)], "d double")
    assert [r[0] for r in df.select(text.direction_text("d")).collect()] == ["up by 1.23 m", "down by -0.50 m", "unchanged", None]


def test_fetch_window(spark):
    t = spark.createDataFrame([(at(0),), (at(3),)], "date date")
    assert tuple(quality.fetch_window(t, at(10)).first()) == (at(3), at(4), at(9), True)
    assert tuple(quality.fetch_window(t, at(4)).first()) == (at(3), at(4), at(3), False)
    assert tuple(quality.fetch_window(t.filter("false"), at(10)).first()) == (None, at(9 - 3650), at(9), True)


def test_constant_columns(spark):
    df = spark.createDataFrame([("a", 1.0, float(i)) for i in range(5)], "location string, c double, y double")
    assert df.select(numbers.pearson("c", "y")).first()[0] is None
    assert {r["column"]: r["outliers"] for r in quality.zscore_outliers(df).collect()} == {"c": 0, "y": 0}


def test_duplicates_do_not_hide_gaps(spark):
    t = spark.createDataFrame([("a", at(0)), ("a", at(0)), ("a", at(0)), ("a", at(2))], "location_name string, date date")
    assert quality.gap_counts(quality.availability(t)).first()["gap_days"] == 1


def test_merge_periods_equals_outer_join_of_wide_tables(spark):
    """The long union against joining side by side and dropping repeated columns."""
    a = spark.createDataFrame([("r", "x", 1.0, None), ("r", "y", 2.0, 3.0)], ["region", "district", "Feb-2020", "Mar-2020"])
    b = spark.createDataFrame([("r", "x", 9.0, 5.0), ("s", "z", 8.0, 6.0)], ["region", "district", "Mar-2020", "Jan-2020"])
    got = sorted((r["region"], r["district"], r["month"].month, r["value"]) for r in indicators.merge_periods([a, b], "cdi").collect())
    pa, pb = a.toPandas(), b.toPandas()
    wide = pa.merge(pb, on=["region", "district"], how="outer", suffixes=("", "_old"))
    wide = wide.drop(columns=[c for c in wide.columns if "_" in c])
    tall = wide.melt(id_vars=["region", "district"]).dropna()
    month = {"Jan-2020": 1, "Feb-2020": 2, "Mar-2020": 3}
    assert got == sorted((r.region, r.district, month[r.variable], r.value) for r in tall.itertuples())


def test_month_columns():
    assert indicators.month_columns(["region", "Mar-2020", "Feb-2020", "Dec-2019", "Mar-2020_x"]) == ["Dec-2019", "Feb-2020", "Mar-2020"]
    assert indicators.feature_columns(["location", "a", "date", "y", "level__m", "month_sin"]) == ["a", "month_sin"]


def test_dates_in_all_formats(spark):
    texts = ["2024-11-19", "19/11/2024", "19-11-2024", "2024-11-18 21:00:00+00:00", "Nov-2024", "31-02-2024", "soon"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(dates.parse_date_any("t")).collect()]
    d = dt.date(2024, 11, 19)
    assert got == [d, d, d, dt.date(2024, 11, 18), dt.date(2024, 11, 1), None, None]


def test_predictions_are_required(spark):
    s = "location string, level_m double"
    with pytest.raises(RuntimeError):
        evaluation.require_predictions(spark.createDataFrame([], s))
    with pytest.raises(RuntimeError):
        evaluation.require_predictions(spark.createDataFrame([("a", None)], s))


# --- plans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_shifts_of_a_series_share_one_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 7 as string) location", "date_add(date'2020-01-01', cast(id as int)) date", "rand() precipitation_sum", "rand() precipitation_hours")
    plan = plan_of(series.weather_shifts(df, features.WEATHER_LAGS))
    assert plan.count("Exchange") == 1 and plan.count("Window ") == 1


def test_stored_series_need_no_shuffle(spark):
    """Lags, fills, gaps, deduplication and joins by location over tables stored by location."""
    df = spark.range(1000).selectExpr("cast(id % 7 as string) location", "date_add(date'2020-01-01', cast(id as int)) date", "cast(id % 5 as double) level__m")
    kept, other = sinks.store_series(df, 4), sinks.store_series(df.withColumnRenamed("level__m", "b"), 4)
    plans = [
        series.station_lags(kept, features.STATION_LAGS),
        series.fill_missing_levels(kept, "2020-01-01", "2022-12-31"),
        series.gaps_between(kept, "2020-01-01", "2022-12-31"),
        series.station_lags(series.dedup_keep_last(kept, recency=()), [1]),
        quality.last_date_per_location(kept, "level__m", key="location"),
        kept.hint("merge").join(other, "location").groupBy("location").agg(F.count("*")),
    ]
    for plan in plans:
        assert "Exchange" not in plan_of(plan), plan_of(plan)
    assert sorted(map(str, plans[0].collect())) == sorted(map(str, series.station_lags(df, features.STATION_LAGS).collect()))


def test_quantiles_of_a_hot_group(spark):
    """Equal to the engine's own, where one location holds most rows, with ties, one value, nulls and a huge range."""
    import random

    r = random.Random(8)
    rows = [("hot", r.choice([0.1, 0.2, r.gauss(0, 1e6), r.gauss(0, 1e-6)])) for _ in range(3000)]
    rows += [("few", 2.0), ("two", 1.0), ("two", 4.0), ("same", 3.0), ("same", 3.0), ("null", None), ("nan", float("nan"))] + [("mid", float(k % 13)) for k in range(101)]
    df = spark.createDataFrame(rows, "location string, e double").cache()
    shares = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    known = df.filter("e IS NOT NULL AND NOT isnan(e)")
    want = {x["location"]: x["q"] for x in known.groupBy("location").agg(F.percentile("e", F.array(*[F.lit(p) for p in shares])).alias("q")).collect()}
    for bins in (1024, 3):
        assert {x["location"]: x["q"] for x in evaluation.quantiles(df, "location", "e", shares, bins).collect()} == want
    assert evaluation.quantiles(df.limit(0), "location", "e", shares).count() == 0


def test_day_maps(spark):
    """Copies, days outside and nulls change nothing; a century takes two bitmaps, a longer range is refused."""
    rows = [("a", at(0)), ("a", at(0)), ("a", at(9)), ("a", at(40_000)), ("a", at(-1)), ("a", None), ("b", at(50_000))]
    df = spark.createDataFrame(rows, "location string, date date")
    for last in (9, 40_000):
        got = {r["location"]: r for r in df.groupBy("location").agg(daymaps.day_map("date", at(0), at(last)).alias("m")).select("location", daymaps.count_days("m").alias("n"), daymaps.missing_days(F.col("m"), at(0), at(last)).alias("gone")).collect()}
        held = {0, 9} | ({40_000} if last == 40_000 else set())
        assert got["a"]["n"] == len(held) and got["b"]["n"] == 0
        assert got["a"]["gone"] == [at(k) for k in range(last + 1) if k not in held] and len(got["b"]["gone"]) == last + 1
    with pytest.raises(Exception, match="too long"):
        df.agg(daymaps.day_map("date", at(0), at(70_000))).collect()
    plan = plan_of(series.missing_dates(df, at(0), at(9)))
    assert "collect_set" not in plan and "bitmap" in plan


BROKEN = [
    ("cut", '{"latitude": 1, "daily": {"start": 0', "no JSON"),
    ("blank", "  ", "empty"),
    ("null", None, "empty"),
    ("error", '{"error": true, "reason": "limit"}', "no daily block"),
    ("axis", '{"daily": {"start": 0, "end": 172800}}', "no time axis"),
    ("still", '{"daily": {"start": 0, "end": 172800, "interval": 0}}', "no time axis"),
    ("endless", '{"daily": {"start": 0, "end": 99999999999, "interval": 1}}', "time axis too long"),
    ("uneven", '{"daily": {"start": 0, "end": 172800, "interval": 86400, "precipitation_sum": [1.0, 2.0, 3.0]}}', "more values than times"),
    ("text", '["daily"]', "no daily block"),
]


def test_broken_answers_stop_no_other(spark):
    good = '{"latitude": 1.5, "longitude": 2, "daily": {"start": 0, "end": 172800, "interval": 86400, "precipitation_sum": [1.5, null], "precipitation_hours": ["2", "x"]}}'
    df = spark.createDataFrame([(n, t) for n, t, _ in BROKEN] + [("good", good)], "location_name string, payload string")
    rows = payloads.weather_daily(df).orderBy("date").collect()
    assert [(r["location_name"], r["forecast_longitude"], r["precipitation_sum"], r["precipitation_hours"], r["rain_sum"]) for r in rows] == [("good", 2.0, 1.5, 2.0, None), ("good", 2.0, None, None, None)]
    assert {tuple(r) for r in payloads.rejected_weather(df).collect()} == {(n, why) for n, _, why in BROKEN}
    charts = df.withColumnRenamed("location_name", "location")
    assert payloads.gauge_chart(charts).count() == 0
    assert {r["reason"] for r in payloads.rejected_charts(charts).collect()} == {"no JSON", "empty", "no readings"}
    lists = spark.createDataFrame([(1, '{"x": [{"a": "1"}, {"b": 2}]}'), (2, '{"y": []}'), (3, "no"), (4, None)], "k int, payload string")
    assert [tuple(r) for r in payloads.json_records(lists, "x", {"a": "number"}, ["k"]).collect()] == [(1, 1.0), (1, None)]
    assert {tuple(r) for r in payloads.rejected_records(lists, "x", ["k"]).collect()} == {(2, "no list x"), (3, "no JSON"), (4, "empty")}


def test_a_location_that_feeds_most_stations(spark):
    """Every station gets the rows of a shared location, and they come out of many tasks."""
    stations = [(f"S{i}", f"S{i}", "r", [f"S{i}"], ["shared"] if i % 3 else ["shared", f"W{i}"]) for i in range(30)]
    mapping = spark.createDataFrame(stations, "station string, location string, river string, upstream_stations array<string>, weather_locations array<string>")
    days = [(at(i),) for i in range(40)]
    own = spark.createDataFrame(days, "date date").crossJoin(mapping.select("location")).withColumn("level__m", F.dayofmonth("date").cast("double"))
    rain = spark.createDataFrame(days, "date date").crossJoin(features.edges(mapping, "weather_locations").select("location").distinct())
    rain = rain.withColumns({"precipitation_sum": F.lit(1.0), "precipitation_hours": F.lit(2.0)})
    m = features.feature_matrix(mapping, own, rain, [1], [0])
    per = {r["location"]: r["n"] for r in m.groupBy("location").agg(F.count("*").alias("n")).collect()}
    assert per == {f"S{i}": 39 for i in range(30)}
    rows = features.weather_rows(rain, features.weather_sources(features.sources(mapping)), [0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shared = rows.filter("pos = 0").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shared > 1


def test_doubled_days_and_missing_sources(spark):
    """A doubled day of one weather location neither stands in for the other's missing one nor drops the day."""
    mapping = spark.createDataFrame([("S", "S", "r", ["U"], ["A", "B"])], "station string, location string, river string, upstream_stations array<string>, weather_locations array<string>")
    levels = spark.createDataFrame([(k, at(i), float(i), 1) for k in "SU" for i in range(12)] + [("S", at(5), 99.0, 0)], "location string, date date, level__m double, load_seq int")
    rows = [(k, at(i), float(i), 1.0, 1) for k in "AB" for i in range(12) if (k, i) != ("B", 8)]
    rain = spark.createDataFrame([*rows, ("A", at(8), 99.0, 1.0, 2), ("A", at(3), 77.0, 1.0, 0)], "location string, date date, precipitation_sum double, precipitation_hours double, load_seq int")
    m = features.feature_matrix(mapping, levels, rain, [1], [1], infer=True, recency=["load_seq"]).orderBy("date").collect()
    # The first row of each upstream and further weather series falls away with lag 1; on day 8 location B has no row.
    assert [r["date"] for r in m] == [at(i) for i in range(1, 12) if i != 8]
    by_day = {r["date"]: list(r["features"]) for r in m}
    assert by_day[at(4)] == [3, 3, 3, 1, 3, 1] and by_day[at(6)] == [5, 5, 5, 1, 5, 1]
    assert by_day[at(9)] == [8, 8, 99, 1, 7, 1]
    bad = features.join_on_date([features.weather_rows(rain.drop("load_seq"), features.sources(mapping, reference=False, upstream=False), [0])])
    with pytest.raises(Exception, match="more than one row of a source"):
        bad.collect()


def test_feature_matrix_windows(spark, sf):
    """One window per series and one for the target, whatever the number of lags."""
    m = features.feature_matrix(fx.station_mapping(spark, sf), fx.levels(spark, sf), fx.rain(spark, sf), forecast_days=7)
    assert plan_of(m).count("Window [") == 3


def test_fill_takes_one_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 7 as string) location", "date_add(date'2020-01-01', cast(id as int)) date", "rand() level__m")
    assert plan_of(series.fill_missing_levels(df, "2020-01-01", "2022-12-31")).count("Exchange") == 1


@pytest.mark.parametrize("key", ["feature_matrix", "fill_missing_days", "risk_classify", "infer_batch", "weather_lags_leads_fleet", "gap_fill_from_source"])
def test_no_python_and_no_cross_product_in_plans(spark, sf, key):
    from thalweg.catalog import QUERIES

    plan = plan_of(QUERIES[key](spark, sf))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bounds_reach_the_scan(spark, sf):
    plan = plan_of(fx.river(spark, sf, "2000-01-01", "2000-12-31"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
