"""Models, training runs and streams."""

import dataclasses
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog import jobs
from thalweg.operators import evaluation, features, models, trees
from thalweg.plans import training
from thalweg.session import fresh_path
from thalweg.sources import sinks
from thalweg.streaming import readings as streams


@pytest.fixture(scope="module")
def matrix(spark):
    """Two stations whose difference is linear in two features, 400 days each, both horizons."""
    rng = np.random.default_rng(3)
    rows = []
    for k, station in enumerate(("A", "B")):
        for i in range(400):
            x = rng.normal(size=2)
            y = 0.5 * (k + 1) * x[0] - 0.25 * x[1] + 0.1
            rows.append((station, dt.date(2020, 1, 1) + dt.timedelta(days=i), 3.0 + float(y), 3.0, [float(v) for v in x], float(y)))
    df = spark.createDataFrame(rows, "station string, date date, level__m double, lag01__level__m double, features array<double>, y double")
    return features.with_dates(df.withColumn("forecast_days", F.explode(F.array(F.lit(1), F.lit(7))))).cache()


def split(matrix):
    return matrix.filter("date < '2021-01-01'"), matrix.filter("date >= '2021-01-01'")


def rmse(scored, truth):
    joined = scored.select("location", "date", "forecast_days", "y").join(
        truth.select("location", "date", "forecast_days", F.col("y").alias("t")), ["location", "date", "forecast_days"]
    )
    return joined.agg(F.sqrt(F.avg((F.col("y") - F.col("t")) ** 2)), F.count("*")).first()


def test_additive_model_recovers_a_linear_series(matrix):
    train, test = split(matrix)
    fitted = models.fit_additive(train, ridge=1e-6, order=2)
    assert fitted.count() == 4
    error, n = rmse(models.additive_predict(fitted, test, order=2), test)
    assert n == test.count() and error < 1e-6


def test_additive_model_equals_least_squares(matrix):
    """The distributed sums give the coefficients of one dense solve."""
    train = split(matrix)[0].filter("location = 'A' AND forecast_days = 1")
    noisy = train.withColumn("y", F.col("y") + F.sin(F.dayofyear("date") * 7.0))
    got = models.fit_additive(noisy, ridge=0.0, order=1).first()
    pdf = models.with_design(noisy, 1).select("x", "y").toPandas()
    x = np.column_stack([np.ones(len(pdf)), np.vstack(pdf["x"])])
    fit = x @ np.linalg.lstsq(x, pdf["y"], rcond=None)[0]
    mine = x @ np.concatenate([[got["intercept"]], got["weights"]])
    assert got["rows"] == len(pdf) and np.allclose(mine, fit, atol=1e-6)


def test_fit_does_not_depend_on_partitions(matrix):
    train, _ = split(matrix)
    a, b = (models.fit_additive(train.repartition(n)).orderBy(*models.KEYS).collect() for n in (1, 7))
    for r, s in zip(a, b, strict=True):
        assert np.allclose(r["weights"], s["weights"], atol=1e-9)


def one_by_one(trees, x):
    """What every tree says about one row, by following it node by node."""
    out = []
    for t in trees:
        n = 0
        while t["feature"][n] >= 0:
            n = t["left"][n] if x[t["feature"][n]] <= t["threshold"][n] else t["right"][n]
        out.append(t["value"][n])
    return out


def scored_by_hand(fitted, test, total):
    held = {}
    for t in sorted(fitted.collect(), key=lambda t: t["tree"]):
        held.setdefault((t["location"], t["forecast_days"]), []).append(t)
    rows = test.select("location", "forecast_days", "date", features.feature_vector().alias("x")).collect()
    return {(r["location"], r["forecast_days"], r["date"]): total(one_by_one(held[r["location"], r["forecast_days"]], r["x"])) for r in rows}


def test_forest_and_its_spread(matrix):
    """All stations and horizons in one table; mean and spread equal those of the single trees."""
    train, test = split(matrix)
    fitted = models.fit_forest(train, trees=8, depth=8).cache()
    assert {(r["location"], r["forecast_days"]): r["count"] for r in fitted.groupBy("location", "forecast_days").count().collect()} == {(s, h): 8 for s in "AB" for h in (1, 7)}
    scored = models.forest_predict(fitted, test)
    assert scored.columns == [*[c for c in test.columns if c != "y"], "y", "y_var"]
    by_hand = scored_by_hand(fitted, test, lambda v: (np.mean(v), np.var(v)))
    rows = scored.collect()
    assert len(rows) == len(by_hand) == test.count()
    for r in rows:
        assert (r["y"], r["y_var"]) == pytest.approx(by_hand[r["location"], r["forecast_days"], r["date"]])
    assert rmse(scored, test)[0] < 0.4


def test_boosted_trees_add_up(matrix):
    train, test = split(matrix)
    fitted = models.fit_boosted(train, rounds=30, depth=4).cache()
    scored = models.boosted_predict(fitted, test)
    by_hand = scored_by_hand(fitted, test, sum)
    for r in scored.collect():
        assert r["y"] == pytest.approx(by_hand[r["location"], r["forecast_days"], r["date"]])
    error, n = rmse(scored, test)
    assert n == test.count() and error < 0.3
    single = trees.tree_values(fitted, test, features.feature_vector()).groupBy("location", "forecast_days", "date").agg(F.sum("value").alias("v")).collect()
    assert len(single) == len(by_hand) and all(r["v"] == pytest.approx(by_hand[r["location"], r["forecast_days"], r["date"]]) for r in single)


def test_a_tree_splits_where_brute_force_does():
    """The first split of a tree is the one with the least squared error over all features and thresholds."""
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=40), rng.integers(0, 3, 40).astype(float), np.ones(40)])
    y = np.where(x[:, 1] > 0, 2.0, 0.0) + 0.1 * x[:, 0]
    cuts = [trees.cut_points(c) for c in x.T]
    codes = np.column_stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)])
    tree = trees.grow(codes, cuts, y, np.ones(40), np.arange(3), 1, 5, 0.0)
    error = lambda f, c: sum(((y[m] - y[m].mean()) ** 2).sum() for m in (x[:, f] <= c, x[:, f] > c))
    best = min(((error(f, c), f, c) for f in range(3) for c in cuts[f] if min((x[:, f] <= c).sum(), (x[:, f] > c).sum()) >= 5))
    assert (tree["feature"][0], tree["threshold"][0]) == (best[1], best[2]) and tree["depth"] == 1
    left = x[:, best[1]] <= best[2]
    assert tree["value"][1:] == pytest.approx([y[left].mean(), y[~left].mean()])
    assert not len(cuts[2]) and len(trees.cut_points(np.arange(1000.0))) <= trees.BINS - 1


def test_a_constant_target_gives_one_leaf(spark, matrix):
    train, test = (df.filter("location = 'A' AND forecast_days = 1") for df in split(matrix))
    flat = train.withColumn("y", F.lit(2.5))
    for fitted, predict in ((models.fit_forest(flat, trees=3), models.forest_predict), (models.fit_boosted(flat, rounds=3), models.boosted_predict)):
        assert {r["depth"] for r in fitted.collect()} == {0}
        assert {round(r["y"], 9) for r in predict(fitted, test).collect()} == {2.5}
    fitted = models.fit_forest(flat.limit(0), trees=3)
    assert fitted.count() == 0 and models.forest_predict(fitted, test).count() == 0


def test_fit_is_the_same_on_any_partitions(matrix):
    train, _ = split(matrix)
    a, b = (models.fit_forest(train.repartition(n), trees=3, depth=5).orderBy(*models.KEYS, "tree").collect() for n in (1, 5))
    assert [r["threshold"] for r in a] == [r["threshold"] for r in b]


def test_registry_kinds_round_trip(spark, matrix):
    train, test = split(matrix)
    options = {"RandomForestRegressor_001": {"trees": 2, "depth": 3}, "XGBoost_001": {"rounds": 2, "depth": 2}, "Prophet_001": {}}
    assert set(options) == set(models.REGISTRY)
    for name, entry in models.REGISTRY.items():
        fitted = entry.fit(train, **options[name])
        path = models.model_path(fresh_path(spark, "models"), name)
        entry.save(fitted, path)
        again = entry.load(spark, path)
        assert sorted(again.columns) == sorted(fitted.columns)
        one, two = (entry.predict(m, test).agg(F.sum("y")).first()[0] for m in (fitted, again))
        assert one == pytest.approx(two)


def test_training_run_of_several_stations(spark, sf):
    mapping = fx.station_mapping(spark, sf).filter("station IN ('ASIA', 'EUROPE')")
    config = training.ForecastConfig((1, 3), (1, 0, -2), (1, 2), "2000-01-01", "XGBoost_001", {"rounds": 2, "depth": 3})
    root = fresh_path(spark, "run")
    run = training.build_models(mapping, fx.levels_filled(spark, sf), fx.rain_filled(spark, sf), fx.stations(spark, sf), config, root)
    scores = run.scores.collect()
    assert {(r["location"], r["forecast_days"]) for r in scores} == {(s, h) for s in ("ASIA", "EUROPE") for h in (1, 2)}
    assert all(r["n"] > 100 and r["rmse"] > 0 and r["weighted_rmse"] > 0 for r in scores)
    assert run.counts["rows"] > 1000 and run.counts["dropped"] == 0
    gappy = training.build_models(mapping, fx.levels(spark, sf), fx.rain_filled(spark, sf), fx.stations(spark, sf), dataclasses.replace(config, station_lags=(1, 5)), None)
    assert gappy.counts["rows"] > gappy.counts["dropped"] >= 0
    again = training.load_models(spark, f"{root}/models", "XGBoost_001")
    assert sorted(map(str, again.collect())) == sorted(map(str, run.models.select(*again.columns).collect()))
    assert sinks.read_artifact(spark, root, "eval").filter("station = 'ASIA' AND forecast_days = 2").count() > 100


def test_too_few_rows_are_refused(spark, sf):
    """Stations are looked at one by one: one that lacks rows is not helped by the others."""
    mapping, config = fx.station_mapping(spark, sf), training.ForecastConfig()
    levels, rain = fx.levels(spark, sf), fx.rain(spark, sf)
    training.require_sizes(mapping, levels, rain, config)
    few = levels.filter("location NOT IN ('ASIA', 'EUROPE') OR date < '1995-02-15'")
    with pytest.raises(ValueError, match="station ASIA: .* rows of levels, at least 30 needed"):
        training.require_sizes(mapping, few, rain, config)
    with pytest.raises(ValueError, match="of levels"):
        training.build_models(mapping, few, rain, fx.stations(spark, sf), config)


def test_scores_of_a_perfect_prediction(spark, matrix):
    one = matrix.filter("location = 'A' AND forecast_days = 1")
    evaluated = evaluation.eval_frame(one.withColumn("pred_y", F.col("y")))
    dim = spark.createDataFrame([("A", 3.0, 3.5)], "station_name string, moderate double, high double")
    row = evaluation.score_report(evaluated, dim).first()
    assert row["rmse"] == 0 and row["weighted_rmse"] == 0 and row["baseline_rmse"] > 0


# --- streams


def readings(spark, rows):
    return spark.createDataFrame(rows, "location string, ts timestamp, event_id long, value double")


def at(day, hour):
    return dt.datetime(2024, 1, day, hour)


def test_ingest_over_restarts_inserts_once(spark):
    folder, path = fresh_path(spark, "in"), fresh_path(spark, "out")
    first = readings(spark, [("a", at(1, 1), 1, 1.0), ("a", at(1, 2), 2, 2.0), ("a", at(1, 2), 2, 2.0)])
    schema = first.schema

    def run():
        streams.ingest_readings(streams.read_landing(spark, folder, schema, 1), path).awaitTermination()
        return sorted(tuple(r) for r in streams.read_ingested(spark, path, schema).select("event_id", "value").collect())

    first.coalesce(1).write.mode("append").parquet(folder)
    assert run() == [(1, 1.0), (2, 2.0)]
    assert run() == [(1, 1.0), (2, 2.0)]
    readings(spark, [("a", at(1, 2), 2, 2.0), ("a", at(2, 1), 3, 3.0)]).coalesce(1).write.mode("append").parquet(folder)
    assert run() == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_ingest_checks_the_table_beyond_its_state(spark):
    """A key that comes back after its state has expired is found in the table."""
    folder, path = fresh_path(spark, "in"), fresh_path(spark, "out")
    parts = [("a", at(1, 1), 1, 1.0)], [("a", at(10, 1), 2, 2.0)], [("a", at(20, 1), 3, 3.0)], [("a", at(20, 2), 1, 1.0), ("a", at(20, 3), 4, 4.0)]
    for part in parts:
        df = readings(spark, part)
        df.coalesce(1).write.mode("append").parquet(folder)
        streams.ingest_readings(streams.read_landing(spark, folder, df.schema), path, ("location", "event_id")).awaitTermination()
    got = streams.read_ingested(spark, path, df.schema).select("event_id").collect()
    assert sorted(r[0] for r in got) == [1, 2, 3, 4]


def test_rollup_of_a_day_that_arrives_in_parts(spark):
    folder, path = fresh_path(spark, "in"), fresh_path(spark, "out")
    for part in ([("a", at(1, 1), 1, 1.0)], [("a", at(1, 9), 2, 5.0), ("b", at(1, 9), 3, 2.0)]):
        df = readings(spark, part)
        df.coalesce(1).write.mode("append").parquet(folder)
        streams.stream_daily_rollup(streams.read_landing(spark, folder, df.schema), path).awaitTermination()
    got = sorted(tuple(r) for r in streams.read_rollup(spark, path).collect())
    assert got == [("a", dt.date(2024, 1, 1), 2, 6.0, 5.0), ("b", dt.date(2024, 1, 1), 1, 2.0, 2.0)]


def test_a_reading_that_lands_twice_counts_once(spark):
    """In the table and in the rollup, within a batch and across batches; one folder a day holds the table."""
    folder, path = fresh_path(spark, "in"), fresh_path(spark, "out")
    parts = [("a", at(1, 1), 1, 2.0), ("a", at(1, 1), 1, 2.0)], [("a", at(1, 1), 1, 2.0), ("a", at(2, 1), 2, 3.0)], [("a", at(1, 5), 3, 4.0)]
    for part in parts:
        df = readings(spark, part)
        df.coalesce(1).write.mode("append").parquet(folder)
        streams.stream_daily_rollup(streams.read_landing(spark, folder, df.schema), path).awaitTermination()
    got = sorted(tuple(r) for r in streams.read_rollup(spark, path).collect())
    assert got == [("a", dt.date(2024, 1, 1), 2, 6.0, 4.0), ("a", dt.date(2024, 1, 2), 1, 3.0, 3.0)]
    table = streams.read_ingested(spark, f"{path}/readings", df.schema)
    assert sorted(r["event_id"] for r in table.collect()) == [1, 2, 3]
    assert len({f.rsplit("/", 1)[0] for f in table.inputFiles()}) == 2


def test_late_readings_are_kept(spark):
    """Readings 18 days late, and one without a time stamp that lands twice, are in the table and in the rollup."""
    folder, path, rolled = (fresh_path(spark, n) for n in ("in", "out", "rolled"))
    parts = [("a", at(1, 1), 1, 1.0)], [("a", at(20, 1), 2, 2.0), ("a", None, 3, 3.0)], [("a", at(2, 1), 4, 4.0), ("a", at(1, 2), 5, 5.0), ("a", None, 3, 3.0)], [("a", at(1, 1), 1, 1.0)]
    for part in parts:
        df = readings(spark, part)
        df.coalesce(1).write.mode("append").parquet(folder)
        streams.ingest_readings(streams.read_landing(spark, folder, df.schema), path).awaitTermination()
    got = streams.read_ingested(spark, path, df.schema)
    assert sorted(r[0] for r in got.select("event_id").collect()) == [1, 2, 3, 4, 5]
    for day in (20, 1, 2, None):
        got.filter(F.dayofmonth("ts").eqNullSafe(F.lit(day))).coalesce(1).write.mode("append").parquet(f"{folder}-kept")
        streams.stream_daily_rollup(streams.read_landing(spark, f"{folder}-kept", df.schema), rolled).awaitTermination()
    days = sorted((r["date"].day if r["date"] else 0, r["n"], r["total"]) for r in streams.read_rollup(spark, rolled).collect())
    assert days == [(0, 1, 3.0), (1, 2, 6.0), (2, 1, 4.0), (20, 1, 2.0)]


def test_kinds_share_one_matrix_and_raw_tables_are_read_once(spark, sf, monkeypatch):
    """The model queries store mapping and daily series; all kinds of models are fitted on one matrix."""
    raw = lambda df: [f for f in df.inputFiles() if f.endswith(("/orders.parquet", "/lineitem.parquet", "/supplier.parquet"))]
    assert raw(fx.rain_filled(spark, sf)) and not any(raw(df) for df in jobs.training_inputs(spark, sf))
    made, store = [], training.stored_matrix
    monkeypatch.setattr(training, "stored_matrix", lambda *a: made.append(a) or store(*a))
    monkeypatch.setattr(models, "REGISTRY", {name: models.REGISTRY["Prophet_001"] for name in ("Prophet_001", "Prophet_002")})
    rows = jobs.persist_load_model(spark, sf).collect()
    assert len(made) == 1 and {r.kind for r in rows} == set(models.REGISTRY) and all(r.n and not r.differing for r in rows)
