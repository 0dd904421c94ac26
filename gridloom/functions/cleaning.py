"""Masks, fills, rescaling and class names as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.session import clean

# Fixed values.
NODATA = 9.96921e36
QA_THRESHOLD = 0.5
PRODUCT_LINE_SWITCH = dt.date(2022, 7, 26)
PACKAGED_BEFORE = dt.date(2019, 1, 1)
FEW_FROM, FEW_TO, MEDIUM_TO = 2, 20, 100
SIZE_CLASSES = {1: "small", 0: "medium", -1: "large"}


def inf_to_missing(c: Column) -> Column:
    return F.when(F.abs(clean(c)) < F.lit(float("inf")), c)


def quality_mask(value: Column, qa: Column, threshold: float = QA_THRESHOLD) -> Column:
    """The value where quality is strictly above the threshold, else missing."""
    return F.when(clean(qa) > threshold, clean(value))


def nodata_mask(pred: Column, co: Column, tp: Column, ndvi: Column, nodata: float = NODATA) -> Column:
    """Prediction with unusable cells set to the nodata code.

    Precedence, strongest first: vegetation index outside [-1, 1]; negative prediction becomes 0 (the
    nodata code is positive, so a masked cell stays masked); missing, negative or fill concentration,
    or missing precipitation; else the prediction itself.
    """
    pred, co, tp, ndvi = clean(pred), clean(co), clean(tp), clean(ndvi)
    unusable = co.isNull() | (co < 0) | (co == nodata) | tp.isNull()
    return (
        F.when((ndvi > 1) | (ndvi < -1), F.lit(nodata))
        .when(unusable, F.lit(nodata))
        .when(pred < 0, F.lit(0.0))
        .otherwise(pred)
    )


def clamp_non_negative(c: Column) -> Column:
    return F.when(clean(c) < 0, F.lit(0.0)).otherwise(clean(c))


def rescale(raw: Column, scale: float, offset: float = 0.0) -> Column:
    return (raw - F.lit(float(offset))) / F.lit(float(scale))


def product_line(date: Column, switch: dt.date = PRODUCT_LINE_SWITCH) -> Column:
    """Reprocessed products before the switch date, offline products from it on."""
    return F.when(F.to_date(date) >= F.lit(switch), F.lit("OFFL")).otherwise(F.lit("RPRO"))


def is_packaged(date: Column, before: dt.date = PACKAGED_BEFORE) -> Column:
    return F.to_date(date) < F.lit(before)


def class_name(class_id: Column) -> Column:
    named = None
    for number, name in SIZE_CLASSES.items():
        named = F.when(class_id == number, name) if named is None else named.when(class_id == number, name)
    return named


def frequency_class(frequency: Column) -> Column:
    return (
        F.when(frequency > MEDIUM_TO, "many").when(frequency > FEW_TO, "medium").when(frequency >= FEW_FROM, "few").otherwise("other")
    )


def relevance_class(phi: Column) -> Column:
    return F.when(phi == 0, "low").when(phi < 1, "medium").when(phi.isNotNull(), "high")
