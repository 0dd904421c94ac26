"""Pixel tables: arrays to rows, and prediction grids as date-partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.cleaning import NODATA
from gridloom.functions.grid import Grid, pixel_coords
from gridloom.session import clean


def pixel_scan(df: DataFrame, array: str, width: int, keys: list[str], value: str = "value") -> DataFrame:
    """One row per pixel of a row-major array column: keys, row, col, value. No shuffle."""
    flat = df.select(*keys, F.posexplode(F.col(array)).alias("_pos", "_value"))
    return flat.select(
        *keys,
        F.expr(f"cast(_pos div {int(width)} as int)").alias("row"),
        (F.col("_pos") % width).alias("col"),
        F.col("_value").cast("double").alias(value),
    )


def grid_rows(df: DataFrame, grid: Grid, value: Column, nodata: float = NODATA, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Rows of an output grid: keys, row, col, upper-left lon and lat, and a float value or nodata.

    A cell without a row is nodata as well.
    """
    lon, lat = pixel_coords(grid, F.col("row"), F.col("col"))
    return df.select(
        *keys, "row", "col", lon.alias("lon"), lat.alias("lat"),
        F.coalesce(clean(value), F.lit(nodata)).cast("float").alias("value"),
    )


def grid_sink(
    df: DataFrame, grid: Grid, value: Column, path: str, nodata: float = NODATA, keys: Sequence[str] = ("date",)
) -> None:
    """Write the grid partitioned by date. Dates that are there already are replaced, all others stay: a date's files take
    their place when the whole job is done, so a run that fails leaves no half date.

    Rows are range-partitioned by date and row first: each task writes few dates, and a huge date is
    spread over several tasks.
    """
    rows = grid_rows(df, grid, value, nodata, keys).repartitionByRange("date", "row")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").option("maxRecordsPerFile", 50_000_000).parquet(path)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
