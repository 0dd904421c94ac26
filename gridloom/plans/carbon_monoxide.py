"""Ground carbon monoxide: station table to model, and satellite orbits to prediction grids."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import physics, temporal
from gridloom.functions.cleaning import nodata_mask, quality_mask, relevance_class, rescale
from gridloom.functions.grid import REGION, TARGET_STEP, Grid, pixel_coords
from gridloom.operators import align, models, relevance, rows, scaling, split
from gridloom.session import lookup_join, settle, with_row_key
from gridloom.sources.models import save_cascade
from gridloom.sources.pixels import grid_rows
from gridloom.sources.tables import CO_CYCLIC, CO_FEATURES, CO_FILLED, CO_SCHEMA, CO_TARGET, read_stage, read_station_csv, write_stage

# Hourly weather variables and the point whose scan time stands for an orbit.
VARIABLES = ["d2m", "t2m", "ssr", "u10", "v10", "sp", "tp"]
REGION_CENTER = ((REGION[0] + REGION[2]) / 2, (REGION[1] + REGION[3]) / 2)
SCALED = [c for c in CO_FEATURES if c not in CO_CYCLIC]
WEATHER_NODATA = -32767.0


def split_stations(stations: DataFrame, key: str) -> DataFrame:
    """80/20 by target bin, rare bins together."""
    binned = split.bin_and_merge_rare(stations, CO_TARGET)
    return split.stratified_split(binned, 20, 42, key, "bin").drop("bin")


def cyclic(df: DataFrame) -> DataFrame:
    return df.withColumns({c: temporal.cyclic_sin(F.col(f"`{c}`"), period) for c, period in CO_CYCLIC.items()})


def _scaled_first(df: DataFrame, rest: Sequence[str]) -> DataFrame:
    return align.bind_columns(df, {c: F.col(f"`{c}`") for c in SCALED}, rest)


def normalize(train: DataFrame, test: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both tables with cyclic and standardised features (scaled columns first), and the scaler table."""
    scaler = settle(scaling.fit_standardize(train, SCALED))
    rest = [*CO_CYCLIC, CO_TARGET, key]
    done = [_scaled_first(scaling.apply_standardize(cyclic(df), scaler, SCALED), rest) for df in (train, test)]
    return done[0], done[1], scaler


@dataclass(frozen=True)
class CascadeFit:
    """Fits a cascade to training rows and a weight column. A sweep calls ``prepare`` once for all its weights."""

    key: str
    options: dict[str, Any]

    def prepare(self, train: DataFrame) -> DataFrame:
        return models.cascade_rows(train, CO_FEATURES, self.key, **{n: v for n, v in self.options.items() if n == "k"})

    def __call__(self, train: DataFrame, weight: str) -> models.ForestCascade:
        if "_fold" in train.columns:
            return models.grow_cascade(train, CO_FEATURES, CO_TARGET, weight, **self.options)
        return models.fit_forest_cascade(train, CO_FEATURES, CO_TARGET, self.key, weight, **self.options)


def cascade_fit(key: str, **kw) -> CascadeFit:
    return CascadeFit(key, kw)


# Mean relevance-weighted error per weighting strength, used when tuning is switched off.
STORED_SWEEP = {
    0.0: 8894.8069089294,
    0.1: 8987.063773374784,
    0.2: 8997.074467348082,
    0.3: 8939.888736849047,
    0.4: 9315.1834516117,
    0.5: 9039.413774066872,
    0.6: 8566.440649333914,
    0.7: 8891.848524774265,
    0.8: 8658.79093023558,
    0.9: 8111.407318935996,
    1.0: 8870.747383252388,
}


def stored_sweep(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STORED_SWEEP.items()), "`Alpha` double, `Mean SERA` double")


def tune(
    train: DataFrame, key: str, alphas: Sequence[float] = tuple(models.CO_ALPHAS), fit: Callable | None = None, k: int = 3, seed: int = 42
) -> DataFrame:
    """(Alpha, Mean SERA) over repeated holdouts stratified by relevance class."""
    classed = relevance.with_relevance(train, CO_TARGET)
    classed = classed.withColumn("relevance", relevance_class(F.col("phi"))).drop("phi")
    folds = settle(split.repeated_holdout(classed, key, "relevance", k, seed))
    return models.holdout_sweep(folds, CO_TARGET, alphas, fit or cascade_fit(key))


def train_best(train: DataFrame, key: str, sweep: DataFrame, **kw) -> models.ForestCascade:
    """The cascade fitted with the weighting strength of lowest mean SERA (one number read back)."""
    alpha = models.best_alpha(sweep, "Mean SERA", "Alpha").first()["Alpha"]
    weighted = settle(models.density_weights(train, CO_TARGET, {"weight": alpha}))
    return cascade_fit(key, **kw)(weighted, "weight")


def run_development(
    spark: SparkSession, csv_path: str, root: str, run: str, tuning: bool = True, alphas: Sequence[float] = tuple(models.CO_ALPHAS),
    version: int = 1, **cascade,
) -> str:
    """Station file to stage tables, the sweep and the final cascade, all below ``root``."""
    key = "row_id"
    split_rows = settle(split_stations(with_row_key(read_station_csv(spark, csv_path, CO_SCHEMA), key), key))
    write_stage(split_rows.filter(~F.col("is_test")).drop("is_test"), root, run, "train_dataset")
    write_stage(split_rows.filter("is_test").drop("is_test"), root, run, "test_dataset")
    train, test, scaler = normalize(read_stage(spark, root, run, "train_dataset"), read_stage(spark, root, run, "test_dataset"), key)
    for name, table in {"train_normalized": train, "test_normalized": test, "scaler": scaler}.items():
        write_stage(table, root, run, name)
    train = read_stage(spark, root, run, "train_normalized")
    sweep = tune(train, key, alphas, cascade_fit(key, **cascade)) if tuning else stored_sweep(spark)
    write_stage(sweep, root, run, "alpha_k_fold_results")
    model = train_best(train, key, read_stage(spark, root, run, "alpha_k_fold_results"), **cascade)
    return save_cascade(model, root, "carbon_monoxide", rows.select_features(train, CO_FEATURES), version)


def grid_orbits(swath: DataFrame, grid: Grid) -> tuple[DataFrame, DataFrame]:
    """(cells, times): column concentrations per (date, orbit, row, col), and each orbit's scan time.

    Orbits whose window is empty or one column wide are left out, all orbits of all days in one job.
    """
    keyed = swath.withColumn("date", F.to_date("ts"))
    by, box = ["date", "orbit"], REGION
    windows = settle(align.bbox_index_window(keyed, box, by, row="scan", col="ground"))
    good = keyed.withColumn("value", quality_mask(F.col("value"), F.col("qa")))
    inside = align.slice_window(good, windows, by, "scan", "ground")
    cells = align.grid_swath(inside, grid, by).select(*by, "row", "col", F.col("value").alias("co"))
    kept = lookup_join(keyed, windows.filter(~F.col("out_of_range")).select(*by), by, "left_semi")
    times = align.nearest_pixel(kept, *REGION_CENTER, by, ["ts"], row="scan", col="ground").select(*by, "ts")
    return cells, times


def orbit_features(
    swath: DataFrame, weather: DataFrame, weather_grid: Grid, ndvi: DataFrame, tpi: DataFrame, ndvi_scale: float, ndvi_offset: float,
    grid: Grid | None = None,
) -> DataFrame:
    """One row per cell and orbit with the raw model features.

    ``weather`` is (variable, hour, row, col, value) on its own grid; ``ndvi`` is (row, col, value) and
    ``tpi`` (row, col, value) on the target grid, ``ndvi`` in raw units.
    """
    grid = grid or Grid.covering(REGION, TARGET_STEP)
    by = ["date", "orbit"]
    cells, times = grid_orbits(swath, grid)
    times = settle(times)
    timed = settle(lookup_join(cells, times, by))
    # only the hours around scan times are read on
    start = temporal.hour_start(F.col("ts")).cast(weather.schema["hour"].dataType)
    hours = times.select(F.explode(F.array(start, start + F.expr("interval 1 hour"))).alias("hour")).distinct()
    near = lookup_join(weather, hours, ["hour"], "left_semi")
    fields = align.sample_fields(timed, near, VARIABLES, weather_grid, grid, by, nodata=WEATHER_NODATA)
    df = timed.join(fields.drop("ts"), [*by, "row", "col"])
    df = df.join(ndvi.select("row", "col", F.col("value").alias("_ndvi")), ["row", "col"], "left")
    df = df.join(tpi.select("row", "col", F.col("value").alias("Topographic Position Index")), ["row", "col"], "left")
    lon, lat = pixel_coords(grid, F.col("row"), F.col("col"))
    return df.withColumns(
        {
            "S5PConcentration": F.col("co"), "Surface Solar Radiance": F.col("ssr"), "Surface Pressure": F.col("sp"),
            "Total Precipitation": F.col("tp"), "NDVI": rescale(F.col("_ndvi"), ndvi_scale, ndvi_offset),
            "Day of Year": temporal.day_of_year(F.col("date")), "Total Seconds": temporal.seconds_of_day(F.col("ts")),
            "Relative Humidity": physics.relative_humidity(F.col("d2m"), F.col("t2m")),
            "Wind Speed": physics.wind_speed(F.col("u10"), F.col("v10")),
            "Wind Direction": physics.wind_direction(F.col("u10"), F.col("v10")),
            "Distance to Center": physics.distance_to_center(lon, lat),
        }
    ).select(*by, "row", "col", "co", "tp", *[F.col(f"`{c}`") for c in CO_FEATURES])


def predict_orbits(features: DataFrame, scaler: DataFrame, model: PipelineModel | models.ForestCascade, grid: Grid | None = None) -> DataFrame:
    """Masked prediction grid rows; masks read the concentration and precipitation before filling."""
    grid = grid or Grid.covering(REGION, TARGET_STEP)
    raw = features.withColumn("_index", F.col("NDVI"))
    ready = scaling.apply_standardize(cyclic(rows.fill_missing(raw, CO_FILLED)), scaler, SCALED)
    predicted = model.transform(models.numbers_only(ready, CO_FEATURES))
    value = nodata_mask(F.col("prediction"), F.col("co"), F.col("tp"), F.col("_index"))
    return grid_rows(predicted, grid, value, keys=["date", "orbit"])
