"""Splitting, scoring and error metrics, by location.

Quantiles are found by counting in ever finer bins, so a location may have any number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date
from thalweg.functions.numbers import level_weight
from thalweg.operators import series
from thalweg.session import materialise

LAG1 = series.shift_name(1, series.LEVEL)


def time_split(matrix: DataFrame, split_date, buffer: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the date, and rows from it on less each location's first ``buffer``.

    The buffer is the longest lag: those rows still look back into the training time.
    """
    day = as_date(split_date)
    late = matrix.filter(F.col("date") >= day)
    return matrix.filter(F.col("date") < day), series.cut_first(late, buffer)


def split_report(matrix: DataFrame, split_date, buffer: int) -> DataFrame:
    """Per location: rows, share of all rows and bounds of both splits."""
    late = F.col("date") >= as_date(split_date)
    ranked = matrix.select("location", "date", late.alias("late")).withColumn(
        "rn", F.row_number().over(series.Window.partitionBy("location", "late").orderBy("date"))
    )
    train, test = ~F.col("late"), F.col("late") & (F.col("rn") > buffer)
    out = ranked.groupBy("location").agg(
        F.count("*").alias("rows"),
        F.count_if(train).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.min(F.when(train, F.col("date"))).alias("train_first"),
        F.max(F.when(train, F.col("date"))).alias("train_last"),
        F.min(F.when(test, F.col("date"))).alias("test_first"),
        F.max(F.when(test, F.col("date"))).alias("test_last"),
    )
    return out.withColumns({"train_share": F.col("train_rows") / F.col("rows"), "test_share": F.col("test_rows") / F.col("rows")})


def linear_score(names: Sequence[str], coefficients: Mapping[str, float], intercept: float = 0.0) -> Column:
    """A fixed linear model over the features; ``names`` gives the order of the array."""
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + F.lit(float(weight)) * F.col("features")[list(names).index(name)]
    return total


def eval_frame(scored: DataFrame, base: str = series.LEVEL) -> DataFrame:
    """Predictions beside the truth, as differences and as levels.

    ``scored`` has ``pred_y`` and ``y``.  The levels add the difference to the level column, which
    is the level aimed at; with ``base='lag01'`` they are added to the level the difference is taken
    from.  The error is the same either way, the level weights are not.  Rows with a NULL are left out.
    """
    start = F.col(LAG1) if base == "lag01" else F.col(base)
    rows = scored.filter(F.col("y").isNotNull() & F.col("pred_y").isNotNull() & F.col(series.LEVEL).isNotNull())
    return rows.select(
        "location",
        "date",
        "pred_y",
        F.col("y").alias("test_y"),
        series.LEVEL,
        (start + F.col("pred_y")).alias("abs_pred_y"),
        (start + F.col("y")).alias("abs_test_y"),
    )


def date_slice(df: DataFrame, begin=None, end=None) -> DataFrame:
    """Rows of a half-open period."""
    if begin is not None:
        df = df.filter(F.col("date") >= as_date(begin))
    if end is not None:
        df = df.filter(F.col("date") < as_date(end))
    return df


def error() -> Column:
    return F.col("abs_pred_y") - F.col("abs_test_y")


def rmse(evaluated: DataFrame) -> DataFrame:
    return evaluated.groupBy("location").agg(F.sqrt(F.avg(error() * error())).alias("rmse"))


def baseline_rmse(evaluated: DataFrame, truth: str = "test_y") -> DataFrame:
    """The error of taking the previous row's difference as the prediction."""
    before = F.lag(truth, 1).over(series.by_day())
    diff = evaluated.select("location", (before - F.col(truth)).alias("d"))
    return diff.groupBy("location").agg(F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("baseline_rmse"))


def weighted_rmse(evaluated: DataFrame, stations: DataFrame) -> DataFrame:
    """The error with days of high water weighing up to ten times as much."""
    bounds = stations.select("station_name", "moderate", "high")
    joined = evaluated.join(bounds, evaluated["location"] == bounds["station_name"])
    weight = level_weight("abs_test_y", "moderate", "high")
    return joined.groupBy("location").agg(F.sqrt(F.sum(error() * error() * weight) / F.sum(weight)).alias("weighted_rmse"))


def error_describe(evaluated: DataFrame) -> DataFrame:
    """Count, mean, deviation, bounds and exact quartiles of the error."""
    rows = evaluated.select("location", error().alias("e"))
    out = rows.groupBy("location").agg(F.count("e").alias("n"), F.avg("e").alias("mean"), F.stddev_samp("e").alias("std"), F.min("e").alias("lowest"), F.max("e").alias("highest"))
    quartiles = quantiles(rows, "location", "e", (0.25, 0.5, 0.75))
    joined = out.join(quartiles, "location", "left")
    return joined.select("location", "n", "mean", "std", "lowest", *[F.get("q", F.lit(i)).alias(f"q{25 * (i + 1)}") for i in range(3)], "highest")


def quantiles(rows: DataFrame, key: str, value: str, shares: Sequence[float], bins: int = 1024) -> DataFrame:
    """(key, q): exact quantiles of each group, between two values in proportion, as ``percentile`` gives them.

    A rank is looked for in an interval of values: these are counted in bins, on the map side, and the
    bin that holds the rank is the next interval.  An interval is as wide as its least and greatest
    value, so each round narrows it, and it is found when the two are one.  No task ever holds a
    group's values.  NULLs and NaNs are left out; a group without any other value has no row.
    """
    data = rows.select(F.col(key).alias("k"), F.col(value).alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p)), F.ceil(place(p))) for p in shares])))
    bounds = data.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = bounds.select("k", "n", "lo", "hi", F.transform(ranks, lambda r: F.struct(r.alias("rank"), r.alias("left"))).alias("ranks"))
    state, found = materialise(state, "ranks"), None
    while True:
        done = state.filter("lo = hi").select("k", "n", F.col("lo").alias("v"), F.explode("ranks.rank").alias("rank"))
        found = done if found is None else found.unionByName(done)
        still = state.filter("lo < hi")
        if still.isEmpty():
            break
        # Intervals of a group are apart from each other: a value falls into one at most.
        held = data.join(still, "k").filter(F.col("v").between(F.col("lo"), F.col("hi")))
        at = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins), F.lit(bins - 1)).alias("bin")
        cells = held.groupBy("k", "lo", "hi", at).agg(F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = F.sum("c").over(Window.partitionBy("k", "lo").orderBy("bin")) - F.col("c")
        within = cells.withColumn("before", before).join(still, ["k", "lo", "hi"])
        hits = F.filter("ranks", lambda r: (r["left"] >= F.col("before")) & (r["left"] < F.col("before") + F.col("c")))
        next_ranks = F.transform(hits, lambda r: F.struct(r["rank"].alias("rank"), (r["left"] - F.col("before")).alias("left")))
        narrowed = within.select("k", "n", F.col("least").alias("lo"), F.col("most").alias("hi"), next_ranks.alias("ranks"))
        state = materialise(narrowed.filter(F.size("ranks") > 0), "ranks")
    of = F.map_from_entries(F.collect_list(F.struct("rank", "v")))
    known = found.groupBy("k", "n").agg(of.alias("of"))

    def between(p):
        low, high = F.floor(place(p)), F.ceil(place(p))
        a, b = F.element_at("of", low), F.element_at("of", high)
        return F.when(a == b, a).otherwise((high - place(p)) * a + (place(p) - low) * b)

    return known.select(F.col("k").alias(key), F.array(*[between(p) for p in shares]).alias("q"))


def score_report(evaluated: DataFrame, stations: DataFrame) -> DataFrame:
    """All metrics of an evaluation, one row per location, in one grouping after one window."""
    bounds = stations.select("station_name", "moderate", "high")
    rows = evaluated.join(bounds, evaluated["location"] == bounds["station_name"])
    rows = rows.withColumns(
        {
            "_e2": error() * error(),
            "_d": F.lag("test_y", 1).over(series.by_day()) - F.col("test_y"),
            "_w": level_weight("abs_test_y", "moderate", "high"),
        }
    )
    return rows.groupBy("location").agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg("_e2")).alias("rmse"),
        F.sqrt(F.avg(F.col("_d") * F.col("_d"))).alias("baseline_rmse"),
        F.sqrt(F.sum(F.col("_e2") * F.col("_w")) / F.sum("_w")).alias("weighted_rmse"),
        F.avg(error()).alias("mean_error"),
    )


def predict_level(scored: DataFrame) -> DataFrame:
    """``level_m`` = the last known level plus the predicted difference."""
    return scored.withColumn("level_m", F.col(LAG1) + F.col("y"))


def require_predictions(predictions: DataFrame) -> DataFrame:
    """Raise where there is no prediction, or one without a level; else the predictions."""
    row = predictions.agg(F.count("*").alias("n"), F.count_if(F.col("level_m").isNull()).alias("bad")).first()
    if row["n"] == 0:
        raise RuntimeError("no prediction came out of the given inputs")
    if row["bad"]:
        raise RuntimeError(f"{row['bad']} predicted levels are missing")
    return predictions
