"""Feature tables: a station's lags beside those of its upstream stations and its weather.

Stations differ in the columns they have.  The canonical form keeps a row's features as one array of
doubles, in an order the station mapping fixes: the station's own lags, then those of each upstream
station, then the shifts of each weather location.  So all stations are served by one plan, rows
carry no names through shuffles or files, and models take the array as it is.  ``feature_index``
gives the names; ``widen`` and ``lengthen`` turn the array into columns or rows.

The plan shifts every series once (one window each for levels and weather), joins the shifted rows
with the edges of the mapping, and gathers them by (station, date).  The number of shuffles does
not depend on how many locations feed a station.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from thalweg.functions.dates import as_date, circular_encoding
from thalweg.functions.text import normalise_name
from thalweg.operators import series
from thalweg.operators.daymaps import count_days, day_map, missing_days

# The lags, in days, that models are trained on; zero and below look ahead.
STATION_LAGS = (1, 3, 7, 14, 30)
WEATHER_LAGS = (1, 3, 7, 14, 30, 0, -2, -6)
DATE_FEATURES = ("month", "dayofyear", "month_sin", "month_cos", "dayofyear_sin", "dayofyear_cos")
LAG1 = series.shift_name(1, series.LEVEL)

# The place of a source within a row: the station itself, upstream levels, weather.
OWN, UPSTREAM, WEATHER = 0, 1, 2


def edges(mapping: DataFrame, column: str) -> DataFrame:
    """(station, location, pos) from one list of the station mapping."""
    return mapping.select("station", F.posexplode(column).alias("pos", "location"))


def level_names(lags: Sequence[int]) -> list[str]:
    return [series.shift_name(n, series.LEVEL) for n in lags]


def rain_names(lags: Sequence[int]) -> list[str]:
    return [series.shift_name(n, c) for n in lags for c in series.RAIN]


def feature_names(upstream: Iterable[str], weather: Iterable[str], station_lags=STATION_LAGS, weather_lags=WEATHER_LAGS) -> list[str]:
    """The names of a station's features, in the order of the array."""
    names = level_names(station_lags)
    names += [f"{normalise_name(u)}__{n}" for u in upstream for n in level_names(station_lags)]
    names += [f"{normalise_name(w)}__{n}" for w in weather for n in rain_names(weather_lags)]
    return names


def feature_index(mapping: DataFrame, station_lags=STATION_LAGS, weather_lags=WEATHER_LAGS) -> DataFrame:
    """(location, names) with the same names for every station of a mapping."""
    own, rain = (F.array(*[F.lit(n) for n in names]) for names in (level_names(station_lags), rain_names(weather_lags)))

    def prefixed(column, names):
        per = F.transform(column, lambda place: F.transform(names, lambda n: F.concat(normalise_name(place), F.lit("__"), n)))
        return F.flatten(per)

    names = F.concat(own, prefixed("upstream_stations", own), prefixed("weather_locations", rain))
    return mapping.select(F.col("station").alias("location"), names.alias("names"))


def sources(mapping: DataFrame, reference: bool = True, upstream: bool = True, weather: bool = True) -> DataFrame:
    """(station, location, role, pos, n_sources): one row per source of every station.

    ``n_sources`` is how many rows a complete day of the station is made of.
    """
    def listed(column, role):
        return F.transform(column, lambda x, i: F.struct(x.alias("location"), F.lit(role).alias("role"), i.alias("pos")))

    wanted = []
    if reference:
        wanted.append(listed(F.array("location"), OWN))
    if upstream:
        wanted.append(listed("upstream_stations", UPSTREAM))
    if weather:
        wanted.append(listed("weather_locations", WEATHER))
    all_of = mapping.select("station", F.concat(*wanted).alias("s"))
    return all_of.select("station", F.size("s").alias("n_sources"), F.inline("s"))


def level_sources(places: DataFrame) -> DataFrame:
    return places.filter(F.col("role") != WEATHER)


def weather_sources(places: DataFrame) -> DataFrame:
    return places.filter(F.col("role") == WEATHER)


def _at_sources(packed: DataFrame, places: DataFrame) -> DataFrame:
    """Shifted rows, once for every station their location feeds.

    A location may feed a third of all stations, and its series comes out of one window task.  So the
    days are spread before the rows multiply.  The mapping is small and Catalyst broadcasts it; beyond
    its limit the join merges, and adaptive execution splits the hot location's rows.
    """
    return packed.repartition("location", "date").join(places, "location")


def level_rows(levels: DataFrame, places: DataFrame, lags: Sequence[int] = STATION_LAGS) -> DataFrame:
    """(station, date, role, pos, n_sources, level__m, lag01__level__m, values): lags by source.

    Upstream series lose their first max(lag) rows, the station's own does not.  The level and lag
    1 are set on the station's own rows.
    """
    lagged = series.shifted(levels, [series.LEVEL], lags)
    first = lagged.get(LAG1, F.lit(None).cast("double"))
    rank = F.row_number().over(series.by_day())
    packed = levels.select(
        "location", "date", rank.alias("_rn"), series.LEVEL, first.alias(LAG1), F.array(*[lagged[n] for n in level_names(lags)]).alias("values")
    )
    joined = _at_sources(packed, places).filter((F.col("role") == OWN) | (F.col("_rn") > max(lags)))
    mine = lambda c: F.when(F.col("role") == OWN, F.col(c)).alias(c)
    return joined.select("station", "date", "role", "pos", "n_sources", mine(series.LEVEL), mine(LAG1), "values")


def weather_rows(weather: DataFrame, places: DataFrame, lags: Sequence[int] = WEATHER_LAGS) -> DataFrame:
    """(station, date, role, pos, n_sources, values) for weather.  The first location of a station is not cut,
    the others lose max(lag) rows; with no positive lag nothing is cut."""
    moved = series.shifted(weather, series.RAIN, lags)
    rank = F.row_number().over(series.by_day())
    values = F.array(*[moved[n].cast("double") for n in rain_names(lags)])
    packed = weather.select("location", "date", rank.alias("_rn"), values.alias("values"))
    cut = max(max(lags), 0)
    joined = _at_sources(packed, places).filter((F.col("pos") == 0) | (F.col("_rn") > cut))
    return joined.select("station", "date", "role", "pos", "n_sources", "values")


def join_on_date(frames: Sequence[DataFrame]) -> DataFrame:
    """Inner join of any number of sources on (station, date) as one grouping.

    Days on which one of the ``n_sources`` sources has no row are dropped, which is what a chain of
    inner joins would leave.  Sources are told apart by (role, pos), so a doubled row never stands
    in for a missing one; it raises an error.  A group holds one row per source of the station, a
    number fixed by the mapping.
    """
    tall = None
    for frame in frames:
        held = {c: F.col(c) if c in frame.columns else F.lit(None).cast("double") for c in (series.LEVEL, LAG1)}
        part = F.struct("role", "pos", "values").alias("part")
        rows = frame.select("station", "date", "n_sources", *[e.alias(c) for c, e in held.items()], part)
        tall = rows if tall is None else tall.unionByName(rows)
    grouped = tall.groupBy("station", "date").agg(
        F.max("n_sources").alias("n_sources"),
        F.max(series.LEVEL).alias(series.LEVEL),
        F.max(LAG1).alias(LAG1),
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    present = F.size(F.array_distinct(F.transform("parts", lambda p: F.struct(p.role, p.pos))))
    doubled = F.raise_error(F.concat(F.lit("more than one row of a source for "), F.col("station"), F.lit(" on "), F.col("date").cast("string")))
    complete = grouped.filter(F.when(F.size("parts") > present, doubled.cast("boolean")).otherwise(present == F.col("n_sources")))
    return complete.select("station", "date", series.LEVEL, LAG1, F.flatten("parts.values").alias("features"))


def complete_features() -> Column:
    return ~F.exists("features", lambda v: v.isNull())


def joined_rows(
    mapping: DataFrame,
    levels: DataFrame,
    weather: DataFrame,
    station_lags: Sequence[int] = STATION_LAGS,
    weather_lags: Sequence[int] = WEATHER_LAGS,
    recency: Sequence[str] = (),
) -> DataFrame:
    """(station, date, level__m, lag01__level__m, features): days on which all sources are present.

    Levels and weather may hold several rows for a location and day: the one with the greatest
    ``recency`` columns counts, ties go to the greatest values.
    """
    places = sources(mapping)
    levels, weather = (
        series.dedup_keep_last(frame.select("location", "date", *recency, *values), recency=recency)
        for frame, values in ((levels, [series.LEVEL]), (weather, series.RAIN))
    )
    return join_on_date(
        [level_rows(levels, level_sources(places), station_lags), weather_rows(weather, weather_sources(places), weather_lags)]
    )


def feature_matrix(
    mapping: DataFrame,
    levels: DataFrame,
    weather: DataFrame,
    station_lags: Sequence[int] = STATION_LAGS,
    weather_lags: Sequence[int] = WEATHER_LAGS,
    forecast_days: int = 1,
    infer: bool = False,
    recency: Sequence[str] = (),
) -> DataFrame:
    """(location, date, level__m, lag01__level__m, features, date features[, y]) for all stations.

    For training, ``level__m`` is the level ``forecast_days - 1`` joined rows ahead and ``y`` its
    difference to ``lag01__level__m``, so lag 1 has to be among the station lags.  Rows with a
    missing value are dropped; for inference the level may be missing.  Of several rows for a location
    and day the one with the greatest ``recency`` columns counts.  Stations for which a source is
    empty give no rows: ``empty_sources`` names them, ``require_sources`` raises.
    """
    if infer:
        joined = joined_rows(mapping, levels, weather, station_lags, weather_lags, recency)
        return with_dates(joined.filter(complete_features()))
    _require_lag1(station_lags)
    joined = joined_rows(mapping, levels, weather, station_lags, weather_lags, recency)
    aimed = series.target_difference(joined, forecast_days, key="station")
    return with_dates(aimed.filter(complete_features() & F.col("y").isNotNull()))


def training_matrix(
    mapping: DataFrame,
    levels: DataFrame,
    weather: DataFrame,
    horizons: Sequence[int],
    station_lags: Sequence[int] = STATION_LAGS,
    weather_lags: Sequence[int] = WEATHER_LAGS,
    recency: Sequence[str] = (),
    seen: Observation | None = None,
) -> DataFrame:
    """``feature_matrix`` for several horizons, marked with ``forecast_days``.

    The sources are joined once; one window finds the targets of all horizons.  ``seen`` takes the
    number of joined rows ("rows") and of those left out as incomplete ("dropped").
    """
    _require_lag1(station_lags)
    joined = joined_rows(mapping, levels, weather, station_lags, weather_lags, recency)
    aimed = series.target_differences(joined, horizons, key="station")
    whole = complete_features() & F.col("y").isNotNull()
    if seen is not None:
        aimed = aimed.observe(seen, F.count("*").alias("rows"), F.count_if(~whole).alias("dropped"))
    return with_dates(aimed.filter(whole))


def _require_lag1(station_lags: Sequence[int]) -> None:
    if 1 not in station_lags:
        raise ValueError("the target is a difference to lag 1: add 1 to station_lags")


def with_dates(rows: DataFrame) -> DataFrame:
    """Joined rows with the date features, under the names of the matrix."""
    tail = [c for c in ("y", "forecast_days") if c in rows.columns]
    encoded = rows.withColumns(circular_encoding("date"))
    return encoded.select(F.col("station").alias("location"), "date", series.LEVEL, LAG1, "features", *DATE_FEATURES, *tail)


def empty_sources(mapping: DataFrame, levels: DataFrame, weather: DataFrame) -> DataFrame:
    """(station, role, location) for every source without a single row; the mapping's empty lists too."""
    def absent(column, frame, role):
        lacking = edges(mapping, column).join(frame.select("location").distinct(), "location", "left_anti")
        return lacking.select("station", F.lit(role).alias("role"), "location")

    blank = lambda column, role: mapping.filter(F.size(column) == 0).select(
        "station", F.lit(role).alias("role"), F.lit(None).cast("string").alias("location")
    )
    own = mapping.join(levels.select("location").distinct(), "location", "left_anti")
    return (
        own.select("station", F.lit("reference").alias("role"), "location")
        .unionByName(absent("upstream_stations", levels, "upstream"))
        .unionByName(absent("weather_locations", weather, "weather"))
        .unionByName(blank("upstream_stations", "upstream"))
        .unionByName(blank("weather_locations", "weather"))
    )


def require_sources(mapping: DataFrame, levels: DataFrame, weather: DataFrame) -> None:
    """Raise where a station lacks a source.  Brings back one line, not the table."""
    found = empty_sources(mapping, levels, weather).limit(1).collect()
    if found:
        row = found[0]
        raise ValueError(f"station {row['station']}: no data for {row['role']} location {row['location']}")


def widen(matrix: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per feature, for the rows of one station (``names`` from ``feature_names``)."""
    tail = [c for c in (*DATE_FEATURES, "y") if c in matrix.columns]
    return matrix.select("location", "date", series.LEVEL, *[F.col("features")[i].alias(n) for i, n in enumerate(names)], *tail)


def lengthen(matrix: DataFrame, index: DataFrame) -> DataFrame:
    """(location, date, feature, value): the long form, with the names of ``feature_index``."""
    named = matrix.select("location", "date", "features").join(index, "location")
    return named.select("location", "date", F.inline(F.arrays_zip(F.col("names").alias("feature"), F.col("features").alias("value"))))


def feature_vector(include_dates: bool = True) -> Column:
    """The model input: the features, then the date features."""
    if not include_dates:
        return F.col("features")
    return F.concat("features", F.array(*[F.col(c).cast("double") for c in DATE_FEATURES]))


def completeness(mapping: DataFrame, column: str, data: DataFrame, begin, end) -> DataFrame:
    """Per station and source location: days expected, found, and which are missing.

    Days are counted in a bitmap of fixed size, so duplicates cannot hide a gap.
    """
    begin, end = as_date(begin), as_date(end)
    seen = data.filter(F.col("date").between(begin, end)).groupBy("location").agg(day_map("date", begin, end).alias("_seen"))
    wanted = edges(mapping, column).select("station", "location").distinct()
    counted = wanted.join(seen, "location", "left").select(
        "station",
        "location",
        (F.datediff(end, begin) + 1).alias("expected"),
        count_days("_seen").cast("int").alias("found"),
        missing_days(F.col("_seen"), begin, end).alias("missing_dates"),
    )
    return counted.withColumn("complete", F.col("found") >= F.col("expected"))


def feature_target_corr(matrix: DataFrame, index: DataFrame) -> DataFrame:
    """(location, feature, corr) of every feature, date feature and the level with ``y``.

    A row goes into its location's sums as it is: the variances of x, y, x + y and x - y for all
    features at once give the correlation, and are combined on the map side.  A feature or target that
    doesn't vary has no correlation.
    """
    extra = [*DATE_FEATURES, series.LEVEL]
    x = F.concat("features", F.array(*[F.col(c).cast("double") for c in extra]))
    y = F.col("y").cast("double")
    both = F.concat(x, F.transform(x, lambda v: v + y), F.transform(x, lambda v: v - y), F.array(y))
    sums = matrix.groupBy("location").agg(Summarizer.variance(array_to_vector(both)).alias("v"))
    n = ((F.size("v") - 1) / 3).cast("int")
    var = sums.select("location", vector_to_array("v").alias("v")).withColumn("n", n)
    at = lambda k, i: F.get("v", k * F.col("n") + i)
    spread = F.col("x") * F.get("v", 3 * F.col("n"))
    corr = F.when(spread > 0, (F.col("plus") - F.col("minus")) / (4 * F.sqrt(spread))).alias("corr")
    names = index.select("location", F.concat("names", F.array(*[F.lit(c) for c in extra])).alias("names"))
    each = F.transform("names", lambda f, i: F.struct(f.alias("feature"), at(0, i).alias("x"), at(1, i).alias("plus"), at(2, i).alias("minus")))
    return var.join(names, "location").select("location", "v", "n", F.inline(each)).select("location", "feature", corr)


def corr_table(corr: DataFrame, locations: Sequence[str]) -> DataFrame:
    """Feature by location.  The locations are given, so the pivot needs no extra pass."""
    return corr.groupBy("feature").pivot("location", list(locations)).agg(F.first("corr"))
