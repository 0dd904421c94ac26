"""Projections, filters and missing values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.temporal import moment
from gridloom.session import clean


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_float(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.DoubleType, T.FloatType))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order: the order is part of a model's contract."""
    return df.select(*[_c(n) for n in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[_c(n) for n in df.columns if n not in set(names)])


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return drop_columns(df, [target]), df.select(_c(target))


def drop_by_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[_c(n) for n in df.columns if not n.startswith(prefix)])


def names_containing(df: DataFrame, text: str) -> list[str]:
    return [n for n in df.columns if text in n]


def select_by_name(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """Columns whose name contains one of the texts, in table order."""
    return df.select(*[_c(n) for n in df.columns if any(t in n for t in texts)])


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[_c(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.StringType)])


def missing_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, missing): how many values of each column are NULL or NaN. One pass, one row per column."""
    floats = {f.name for f in df.schema.fields if _is_float(f)}
    counts = [
        F.count_if((clean(_c(n)) if n in floats else _c(n)).isNull()).alias(n) for n in names
    ]
    return df.agg(*counts).unpivot([], [_c(n) for n in names], "column", "missing")


def drop_missing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(names))


def fill_missing(df: DataFrame, names: Sequence[str], value: float = -1.0) -> DataFrame:
    return df.na.fill({n: value for n in names})


def filter_class(df: DataFrame, class_id: int = 2, column: str = "Class_2") -> DataFrame:
    """Rows of one size class; any id that is not a class keeps every row."""
    return df.filter(_c(column) == class_id) if class_id in (-1, 0, 1) else df


def with_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})


def select_date(df: DataFrame, ts: str, day: dt.date) -> DataFrame:
    """Rows of one day, as a range on the timestamp itself so that file statistics can skip data."""
    start = dt.datetime.combine(day, dt.time())
    return df.filter((_c(ts) >= moment(start)) & (_c(ts) < moment(start + dt.timedelta(days=1))))


def stack_rows(*tables: DataFrame) -> DataFrame:
    """Tables appended by column name; duplicates stay."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
