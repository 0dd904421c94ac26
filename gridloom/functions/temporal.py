"""Dates, times of day, cyclic encodings and date-stamped paths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Periods of the cyclic features.
DAYS_PER_YEAR = 365
SECONDS_PER_DAY = 86400
DEGREES_PER_TURN = 360

# Where each layer's file for one day lies below the data folder.
LAYER_PATHS = {
    "Band 1": "Wind_resampled_combined2/{ymd}_wind_res/band_1.tif",
    "Band 2": "Wind_resampled_combined2/{ymd}_wind_res/band_2.tif",
    "Band 3": "Wind_resampled_combined2/{ymd}_wind_res/band_3.tif",
    "Band 4": "Wind_resampled_combined2/{ymd}_wind_res/band_4.tif",
    "Value WVC": "resampled_water_vapor/{year}/{month}/ColumnWV_{year}_{month}_{day}.tif",
    "Value IMERG": "resampled_imerg_1000m_aggregated/IMERG_aggregated_{ymd}_1000m.tif",
    "Value CER": "resampled_modis_combined/CER/cer_res_A{year}{doy}.tif",
    "Value COT": "resampled_modis_combined/COT/cot_res_A{year}{doy}.tif",
    "Value CWP": "resampled_modis_combined/CWP/cwp_res_A{year}{doy}.tif",
}
DATE_PATTERNS = {"ymd": "yyyyMMdd", "year": "yyyy", "month": "MM", "day": "dd", "doy": "DDD"}


def moment(at: dt.datetime) -> Column:
    """A wall-clock time as a literal that does not depend on the time zone of session or driver."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def month_of(date: Column) -> Column:
    return F.month(F.to_date(date))


def month_of_name(path: Column) -> Column:
    """Month in a file name such as ``A_B_20240601_C.tif``: the third ``_`` token, characters 5 and 6."""
    stamp = F.try_element_at(F.split(F.substring_index(path, "/", -1), "_"), F.lit(3))
    return F.substring(stamp, 5, 2).try_cast("int")


def layer_path(layer: str, date: Column, root: str = "") -> Column:
    parts: list[Column] = [F.lit(root.rstrip("/") + "/")] if root else []
    rest = LAYER_PATHS[layer]
    while "{" in rest:
        text, _, tail = rest.partition("{")
        field, _, rest = tail.partition("}")
        parts += [F.lit(text), F.date_format(date, DATE_PATTERNS[field])]
    return F.concat(*parts, F.lit(rest))


def date_range(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date") -> DataFrame:
    """One row per day, both ends included."""
    days = (end - start).days + 1
    return spark.range(max(days, 0)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def day_of_year(date: Column) -> Column:
    return F.dayofyear(date)


def seconds_of_day(ts: Column) -> Column:
    """Seconds since midnight with the fraction kept; the same for zoned and zone-less timestamps."""
    return F.hour(ts) * 3600.0 + F.minute(ts) * 60.0 + F.date_part(F.lit("SECOND"), ts).cast("double")


def hhmm_seconds(token: Column) -> Column:
    """Seconds of day of an ``HHMM`` token (leading zeros may be missing), one minute later."""
    padded = F.lpad(token, 4, "0")
    hours, minutes = F.substring(padded, 1, 2).try_cast("int"), F.substring(padded, 3, 2).try_cast("int")
    return hours * 3600 + minutes * 60 + 60


def hour_start(ts: Column) -> Column:
    """The full hour at or before a time, as wall-clock time."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def cyclic_sin(x: Column, period: float) -> Column:
    return F.sin(F.lit(2.0) * F.pi() * x / F.lit(float(period)))
