"""Names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def normalise_name(name):
    """Lower case with underscores for blanks; a Python string gives a string (column prefixes)."""
    if isinstance(name, str):
        return name.lower().replace(" ", "_")
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def model_name(preprocessor: Column, forecast_days: Column, model_type: Column, station: Column) -> Column:
    """``{preprocessor}-f{n}-{type}-{station}``."""
    return F.concat_ws("-", preprocessor, F.concat(F.lit("f"), forecast_days.cast("string")), model_type, station)


def parse_model_name(name) -> dict[str, Column]:
    """The four parts of a model name.

    The station is everything after the third dash, less a file extension, so a dash inside a
    station's name survives.  A text with fewer parts, or with no horizon number, gives NULLs.
    """
    name = F.regexp_replace(_col(name), r"\.(json|joblib|pkl)$", "")
    parts = F.split(name, "-", 4)
    horizon = F.try_to_number(F.regexp_extract(F.get(parts, F.lit(1)), r"^f(\d{1,9})$", 1), F.lit("999999999")).cast("int")
    ok = (F.size(parts) == 4) & horizon.isNotNull()
    return {
        "preprocessor_type": F.when(ok, F.get(parts, F.lit(0))),
        "forecast_days": F.when(ok, horizon),
        "model_type": F.when(ok, F.get(parts, F.lit(2))),
        "station": F.when(ok, F.get(parts, F.lit(3))),
    }


def direction_text(diff) -> Column:
    """How the level moves, in words, to two decimals."""
    diff = _col(diff)
    return (
        F.when(diff > 0, F.format_string("up by %.2f m", diff))
        .when(diff < 0, F.format_string("down by %.2f m", diff))
        .when(diff == 0, F.lit("unchanged"))
    )
