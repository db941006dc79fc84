"""Splits, scores and error metrics, with a fixed linear model standing in for a trained one."""

from __future__ import annotations

from pyspark.sql import functions as F

from thalweg import fixtures as fx
from thalweg.catalog.registry import query
from thalweg.catalog.tables import oracle
from thalweg.operators import evaluation, features, models, series

LAGS = [1, 3]
SPLIT = "2000-01-01"
WEIGHTS = {"lag01__level__m": -0.5, "lag03__level__m": 0.25}
INTERCEPT = 0.5

ROWS = """SELECT location, date, level__m, lag01, lag03, level__m - lag01 AS y, 0.5::DOUBLE + -0.5::DOUBLE * lag01 + 0.25::DOUBLE * lag03 AS pred_y
FROM (SELECT *, lag(level__m, 1) OVER w AS lag01, lag(level__m, 3) OVER w AS lag03 FROM levels WINDOW w AS (PARTITION BY location ORDER BY date))
WHERE lag03 IS NOT NULL"""
TEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location ORDER BY date) AS rn FROM feats WHERE date >= DATE '2000-01-01') WHERE rn > 30"
EVAL = "SELECT location, date, pred_y, y AS test_y, level__m, level__m + pred_y AS abs_pred_y, level__m + y AS abs_test_y FROM test"


NAMES = features.level_names(LAGS)


def feats(spark, sf):
    """Level lags as features with the target, for every day a station has them."""
    lagged = series.target_difference(series.station_lags(fx.levels(spark, sf), LAGS), 1)
    rows = lagged.filter(F.col(NAMES[-1]).isNotNull())
    return rows.select("location", "date", series.LEVEL, features.LAG1, F.array(*NAMES).alias("features"), "y")


def evaluated(spark, sf, base=series.LEVEL):
    _, test = evaluation.time_split(feats(spark, sf), SPLIT, 30)
    scored = test.withColumn("pred_y", evaluation.linear_score(NAMES, WEIGHTS, INTERCEPT))
    return evaluation.eval_frame(scored, base)


def with_eval(body: str, names: str = "levels") -> str:
    return oracle(names, body, feats=ROWS, test=TEST, ev=EVAL)


@query("time_split", with_eval("SELECT location, 'train' AS part, date, y FROM feats WHERE date < DATE '2000-01-01' UNION ALL SELECT location, 'test', date, y FROM test"))
def time_split(spark, sf):
    train, test = evaluation.time_split(feats(spark, sf), SPLIT, 30)
    cut = lambda df, name: df.select("location", F.lit(name).alias("part"), "date", "y")
    return cut(train, "train").unionByName(cut(test, "test"))


@query("eval_head_buffer", with_eval("SELECT location, min(date) AS first_date, count(*) AS n FROM test GROUP BY ALL"))
def eval_head_buffer(spark, sf):
    _, test = evaluation.time_split(feats(spark, sf), SPLIT, 30)
    return test.groupBy("location").agg(F.min("date").alias("first_date"), F.count("*").alias("n"))


@query(
    "split_report",
    with_eval(
        """SELECT location, "rows", train_rows, test_rows, train_first, train_last, test_first, test_last,
  round(train_rows / "rows", 9) AS train_share, round(test_rows / "rows", 9) AS test_share
FROM (SELECT location, count(*) AS "rows", count(*) FILTER (WHERE date < DATE '2000-01-01') AS train_rows,
        min(date) FILTER (WHERE date < DATE '2000-01-01') AS train_first, max(date) FILTER (WHERE date < DATE '2000-01-01') AS train_last FROM feats GROUP BY ALL)
JOIN (SELECT location, count(*) AS test_rows, min(date) AS test_first, max(date) AS test_last FROM test GROUP BY ALL) USING (location)"""
    ),
)
def split_report(spark, sf):
    out = evaluation.split_report(feats(spark, sf), SPLIT, 30)
    return out.withColumns({c: F.round(c, 9) for c in ("train_share", "test_share")})


@query("make_eval_frame", with_eval("SELECT * FROM ev"))
def make_eval_frame(spark, sf):
    return evaluated(spark, sf)


@query("make_eval_frame_lag_base", with_eval("SELECT location, date, pred_y, y AS test_y, level__m, lag01 + pred_y AS abs_pred_y, lag01 + y AS abs_test_y FROM test"))
def make_eval_frame_lag_base(spark, sf):
    return evaluated(spark, sf, "lag01")


@query("rmse", with_eval("SELECT location, round(sqrt(avg((abs_pred_y - abs_test_y) * (abs_pred_y - abs_test_y))), 9) AS rmse FROM ev GROUP BY ALL"))
def rmse(spark, sf):
    return evaluation.rmse(evaluated(spark, sf)).withColumn("rmse", F.round("rmse", 9))


@query(
    "baseline_rmse",
    with_eval(
        """SELECT location, round(sqrt(avg(d * d)), 9) AS baseline_rmse FROM (
  SELECT location, lag(test_y, 1) OVER (PARTITION BY location ORDER BY date) - test_y AS d FROM ev) GROUP BY ALL"""
    ),
)
def baseline_rmse(spark, sf):
    return evaluation.baseline_rmse(evaluated(spark, sf)).withColumn("baseline_rmse", F.round("baseline_rmse", 9))


@query(
    "weighted_rmse",
    with_eval(
        """SELECT location, round(sqrt(sum(e * e * w) / sum(w)), 9) AS weighted_rmse FROM (
  SELECT location, abs_pred_y - abs_test_y AS e,
    1 + 4 * CASE WHEN abs_test_y >= high THEN 1 ELSE 1 / (1 + exp(-2 * (abs_test_y - moderate))) END + CASE WHEN abs_test_y >= high THEN 5 ELSE 0 END AS w
  FROM ev JOIN stations ON location = station_name) GROUP BY ALL""",
        "levels stations",
    ),
)
def weighted_rmse(spark, sf):
    return evaluation.weighted_rmse(evaluated(spark, sf), fx.stations(spark, sf)).withColumn("weighted_rmse", F.round("weighted_rmse", 9))


@query(
    "error_describe",
    with_eval(
        """SELECT location, count(e) AS n, round(avg(e), 9) AS mean, round(stddev_samp(e), 9) AS std, round(min(e), 9) AS lowest,
  round(quantile_cont(e, 0.25), 12) AS q25, round(quantile_cont(e, 0.5), 12) AS q50, round(quantile_cont(e, 0.75), 12) AS q75, round(max(e), 9) AS highest
FROM (SELECT location, abs_pred_y - abs_test_y AS e FROM ev) GROUP BY ALL"""
    ),
)
def error_describe(spark, sf):
    out = evaluation.error_describe(evaluated(spark, sf))
    # Quartiles are decimal fractions of about ten digits: twelve keep clear of ties.
    digits = {c: 12 if c.startswith("q") else 9 for c in out.columns if c not in ("location", "n")}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("predict_level", with_eval("SELECT location, date, lag01 + pred_y AS level_m FROM feats"))
def predict_level(spark, sf):
    scored = models.linear_predictor(NAMES, WEIGHTS, INTERCEPT)(feats(spark, sf))
    return evaluation.predict_level(scored).select("location", "date", "level_m")


@query(
    "rmse_scores",
    with_eval(
        """SELECT location, count(*) AS n, round(sqrt(avg(e * e)), 9) AS rmse, round(sqrt(avg(d * d)), 9) AS baseline_rmse,
  round(sqrt(sum(e * e * w) / sum(w)), 9) AS weighted_rmse, round(avg(e), 9) AS mean_error
FROM (SELECT location, abs_pred_y - abs_test_y AS e, lag(test_y, 1) OVER (PARTITION BY location ORDER BY date) - test_y AS d,
        1 + 4 * CASE WHEN abs_test_y >= high THEN 1 ELSE 1 / (1 + exp(-2 * (abs_test_y - moderate))) END + CASE WHEN abs_test_y >= high THEN 5 ELSE 0 END AS w
      FROM ev JOIN stations ON location = station_name) GROUP BY ALL""",
        "levels stations",
    ),
)
def rmse_scores(spark, sf):
    out = evaluation.score_report(evaluated(spark, sf), fx.stations(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c not in ("location", "n")})
