"""Active fires: tile manifest to features, predictions to the report by size class, products to grids."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fire
from gridloom.functions.grid import FIRE_REGION, TARGET_STEP, Grid, join_path
from gridloom.operators import align, metrics, models, rows, scaling, split
from gridloom.sources.pixels import grid_rows
from gridloom.sources.tables import MANIFEST_COLUMNS, read_stage, write_stage

# Manifest columns that name files, in sample order; the source grids' missing code.
FILE_COLUMNS = [
    "MODIS_RAD", "SEVIRI", "SEVIRI_HRV", "ELEVATION", "SLOPE", "ASPECT", "TPI", "FUEL_MAP", "CANOPY_HEIGHT", "CANOPY_COVER",
]
# Loss mix and learning rate used when tuning is switched off.
STORED_PARAMETERS = {"alpha": 0.816, "learning_rate": 0.00007}
IMAGE_NODATA = 32635.0
FIRE_BAND = 4

# Sides of the tiles that the segmentation model reads, and how far beyond a tile it may look.
TILE, TILE_MARGIN = 128, 16


def samples(manifest: DataFrame, root: str, class_id: int = 2) -> DataFrame:
    """Tiles of one size class (or all), with file columns made into paths below ``root``."""
    kept = rows.select_features(rows.filter_class(manifest, class_id), MANIFEST_COLUMNS)
    return kept.withColumns({c: join_path(root, F.col(c)) for c in FILE_COLUMNS})


def holdouts(tiles: DataFrame, key: str, k: int = 2, seed: int = 42) -> DataFrame:
    """Repeated 80/20 splits by size class."""
    return split.repeated_holdout(tiles, key, "Class_2", k, seed)


def tile_features(pixels: DataFrame, names: Mapping[str, int] | Iterable[str], keys: tuple[str, ...] = ("tile",)) -> DataFrame:
    """keys, row, col, the switched-on features in model order, and the label when ``fire_code`` exists.

    Per-tile scores are only computed for the names that need them.
    """
    on = fire.enabled_features(names)
    scores = {n: f"b{fire.TILE_SCORES[n]}" for n in on if n in fire.TILE_SCORES}
    if scores:
        pixels = scaling.tile_zscore(pixels, list(keys), scores)
    label = [fire.fire_label(F.col("fire_code")).alias("label")] if "fire_code" in pixels.columns else []
    return pixels.select(*keys, "row", "col", *[fire.band_feature(n) for n in on], *label)


def loss(predictions: DataFrame, alpha: float = STORED_PARAMETERS["alpha"]) -> DataFrame:
    """The training loss of (label, prob) rows."""
    return metrics.combined_loss(predictions, "label", "prob", alpha)


def evaluate(predictions: DataFrame) -> DataFrame:
    """Report by size class of (tile, label, prob, Class_2) rows."""
    return metrics.metrics_by_class_report(predictions, "label", "prob", "Class_2", "tile")


def run_evaluation(spark: SparkSession, predictions: DataFrame, root: str, run: str) -> DataFrame:
    """The report, kept as a stage table and read back."""
    write_stage(evaluate(predictions), root, run, "best_model_metrics")
    return read_stage(spark, root, run, "best_model_metrics")


def score_images(pixels: DataFrame, src: Grid, load: Callable, dst: Grid | None = None, size: int = TILE, margin: int = TILE_MARGIN) -> DataFrame:
    """Probability grid rows from image pixels (date, band, row, col, value): one band is regridded, scaled and scored
    tile by tile by a model from outside (see ``score_tiles``), which sees the pixels around each one."""
    dst = dst or Grid.covering(FIRE_REGION, TARGET_STEP)
    band = pixels.filter(F.col("band") == FIRE_BAND).select("date", "row", "col", "value")
    regular = align.regrid_bilinear(band, src, dst, ["date"], IMAGE_NODATA)
    ready = regular.withColumn("seviri_ir39_", fire.channel(F.col("value"))).drop("value")
    return grid_rows(models.score_tiles(ready, ["seviri_ir39_"], load, ["date"], size, margin, "prob"), dst, F.col("prob"))
