"""Product catalogue searches as filters on a catalogue table (id, name, start, end, x0, y0, x1, y1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.grid import boxes_overlap, name_token
from gridloom.functions.temporal import moment, seconds_of_day

# Daylight window of a search day, wanted processing version and file prefix.
DAY_FROM, DAY_TO = dt.time(5, 0, 0), dt.time(16, 59, 59)
VERSION_TOKEN, VERSION = 12, "03"
FILE_PREFIX = "S5P_"


def _seconds(t: dt.time) -> float:
    return t.hour * 3600.0 + t.minute * 60.0 + t.second


def catalogue_search(
    catalogue: DataFrame,
    name_like: str | Column,
    first_day: dt.date,
    last_day: dt.date | None = None,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Products whose name contains ``name_like`` and that start after 05:00:00 and end before 16:59:59
    (both strict) of one same day from ``first_day`` to ``last_day``; with ``box``, whose footprint meets it."""
    last_day = last_day or first_day
    opens = dt.datetime.combine(first_day, DAY_FROM)
    closes = dt.datetime.combine(last_day, DAY_TO)
    name = name_like if isinstance(name_like, Column) else F.lit(name_like)
    found = catalogue.filter(
        # comparisons with literals, which reach the file scan
        (F.col("start") > moment(opens)) & (F.col("end") < moment(closes))
        & F.contains(F.col("name"), name)
        & (F.to_date(F.col("start")) == F.to_date(F.col("end")))
        & (seconds_of_day(F.col("start")) > _seconds(DAY_FROM))
        & (seconds_of_day(F.col("end")) < _seconds(DAY_TO))
    )
    if box is None:
        return found
    return found.filter(boxes_overlap(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), box))


def window_search(catalogue: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Products of an explicit time range, both ends included."""
    return catalogue.filter((F.col("start") >= moment(start)) & (F.col("end") <= moment(end)))


def product_filter(products: DataFrame, version: str = VERSION, prefix: str = FILE_PREFIX) -> DataFrame:
    return products.filter(
        F.col("name").startswith(prefix) & (name_token(F.col("name"), "_", VERSION_TOKEN) == version)
    )
