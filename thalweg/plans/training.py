"""From stored tables to fitted and scored models."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date
from thalweg.operators import evaluation, features, models, series
from thalweg.operators.features import STATION_LAGS, WEATHER_LAGS
from thalweg.session import materialise
from thalweg.sources import sinks

LOOK_BACK_DAYS = 1825


@dataclass(frozen=True)
class ForecastConfig:
    """What a training run is built on."""

    station_lags: tuple[int, ...] = STATION_LAGS
    weather_lags: tuple[int, ...] = WEATHER_LAGS
    horizons: tuple[int, ...] = (1,)
    split_date: str = "2023-10-01"
    model_type: str = "XGBoost_001"
    fit_options: dict = field(default_factory=dict)

    @property
    def buffer(self) -> int:
        return max(max(self.station_lags), max(self.weather_lags))


def modelling_inputs(levels: DataFrame, weather: DataFrame, mapping: DataFrame, as_of, look_back: int = LOOK_BACK_DAYS) -> tuple[DataFrame, DataFrame]:
    """The last ``look_back`` days of the series the mapping needs."""
    end = as_date(as_of)
    begin = F.date_sub(end, look_back)
    wanted = lambda column: features.edges(mapping, column).select("location").distinct()
    cut = lambda df: df.filter(F.col("date").between(begin, end))
    own = wanted("upstream_stations").unionByName(mapping.select("location")).distinct()
    return cut(levels).join(own, "location", "left_semi"), cut(weather).join(wanted("weather_locations"), "location", "left_semi")


def input_sizes(levels: DataFrame, weather: DataFrame, config: ForecastConfig) -> DataFrame:
    """Rows of both inputs against the least a lag needs."""
    size = lambda df, name, least: df.agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("input"), "rows", F.lit(least).alias("needed"), (F.col("rows") >= least).alias("enough")
    )
    return size(levels, "levels", max(config.station_lags)).unionByName(size(weather, "weather", max(config.weather_lags)))


def station_sizes(mapping: DataFrame, levels: DataFrame, weather: DataFrame, config: ForecastConfig) -> DataFrame:
    """Per station and input: the rows of all its sources together against the least a lag needs.

    Series are counted by location first, so a source that feeds many stations is counted once.
    """

    def size(column, frame, name, least):
        counts = frame.groupBy("location").agg(F.count("*").alias("rows"))
        wanted = features.edges(mapping, column).select("station", "location").distinct()
        total = wanted.join(counts, "location", "left").groupBy("station").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        return total.select("station", F.lit(name).alias("input"), "rows", F.lit(least).alias("needed"), (F.col("rows") >= least).alias("enough"))

    first = size("upstream_stations", levels, "levels", max(config.station_lags))
    return first.unionByName(size("weather_locations", weather, "weather", max(config.weather_lags)))


def require_sizes(mapping: DataFrame, levels: DataFrame, weather: DataFrame, config: ForecastConfig) -> None:
    """Raise where a station has less than its longest lag needs.  Brings back one line, not the table."""
    short = station_sizes(mapping, levels, weather, config).filter(~F.col("enough")).orderBy("station", "input").limit(1).collect()
    if short:
        r = short[0]
        raise ValueError(f"station {r['station']}: {r['rows']} rows of {r['input']}, at least {r['needed']} needed")


def training_matrix(mapping: DataFrame, levels: DataFrame, weather: DataFrame, config: ForecastConfig, seen: Observation | None = None) -> DataFrame:
    """Feature rows of all stations for every horizon, marked with ``forecast_days``."""
    return features.training_matrix(mapping, levels, weather, config.horizons, config.station_lags, config.weather_lags, seen=seen)


def stored_matrix(mapping: DataFrame, levels: DataFrame, weather: DataFrame, config: ForecastConfig, seen: Observation | None = None) -> DataFrame:
    """The training matrix, written once; ``seen`` counts its rows and those dropped as it is written."""
    return materialise(training_matrix(mapping, levels, weather, config, seen), "matrix")


def analyze_features(matrix: DataFrame, index: DataFrame) -> dict[str, DataFrame]:
    """Days no station has a row for, and the correlation of every feature with the target."""
    # The bounds come first, as the days of a map count from one of them: two days, not the table.
    first, last = matrix.agg(F.min("date"), F.max("date")).first()
    gaps = series.missing_dates_overall(matrix, first, last) if first else matrix.select("date").limit(0)
    return {"missing_dates": gaps, "corr": features.feature_target_corr(matrix, index)}


@dataclass
class TrainedModels:
    """Models of a run with a predictor over their stations, and their scores.

    ``counts`` tells how many joined rows the run had ("rows"), and how many were left out as
    incomplete ("dropped").
    """

    kind: str
    models: DataFrame
    scores: DataFrame
    counts: dict = field(default_factory=dict)

    @property
    def predictor(self):
        return models.predictor(self.kind, self.models)

    def save(self, root: str) -> None:
        models.model_kind(self.kind).save(self.models, models.model_path(root, self.kind))


def load_models(spark, root: str, kind: str) -> DataFrame:
    """Stored models as ``TrainedModels`` holds them."""
    return models.model_kind(kind).load(spark, models.model_path(root, kind))


def fit_models(train: DataFrame, config: ForecastConfig) -> DataFrame:
    """The models of all stations and horizons, stored: a fit is read more than once and not repeated."""
    return materialise(models.model_kind(config.model_type).fit(train, **config.fit_options), "models")


def build_models(
    mapping: DataFrame, levels: DataFrame, weather: DataFrame, thresholds: DataFrame, config: ForecastConfig, artifacts: str | None = None
) -> TrainedModels:
    """Features, split, fit and scores for all stations and horizons.

    The matrix is written once and read by fit and scoring; all stations and horizons that have
    training rows are fitted in one job.  A station without rows for one of its sources, or with fewer
    than its longest lag needs, is an error.
    """
    features.require_sources(mapping, levels, weather)
    require_sizes(mapping, levels, weather, config)
    seen = Observation("matrix")
    matrix = stored_matrix(mapping, levels, weather, config, seen)
    late = as_date(config.split_date)
    train = matrix.filter(F.col("date") < late)
    if train.isEmpty():
        raise ValueError("no station has complete feature rows before the split date")
    fitted = fit_models(train, config)
    out = TrainedModels(config.model_type, fitted, matrix, seen.get)
    parts, tests = [], []
    for h in config.horizons:
        _, test = evaluation.time_split(matrix.filter(F.col("forecast_days") == h), config.split_date, config.buffer)
        tests.append(test)
        scored = out.predictor(test.withColumnRenamed("y", "test_y")).withColumnsRenamed({"y": "pred_y", "test_y": "y"})
        parts.append(evaluation.score_report(evaluation.eval_frame(scored), thresholds).withColumn("forecast_days", F.lit(h)))
    out.scores = reduce(DataFrame.unionByName, parts)
    if artifacts:
        staged = matrix.withColumnRenamed("location", "station")
        sinks.stage_artifact(staged.filter(F.col("date") < late), artifacts, "train")
        held = reduce(DataFrame.unionByName, tests)  # without the buffer, as it was scored
        sinks.stage_artifact(held.withColumnRenamed("location", "station"), artifacts, "eval")
        out.save(f"{artifacts.rstrip('/')}/models")
        sinks.stage_config(matrix.sparkSession, config, artifacts)
    return out
