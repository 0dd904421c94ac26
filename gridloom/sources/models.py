"""Versioned model folders with the schema the model was fitted on."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.models import ForestCascade

# A model's parts lie in a hidden folder of their own; a row of the manifest makes them a version.
MANIFEST = "version int, parts string"


def _manifest(spark: SparkSession, root: str, name: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/{name}/manifest")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """The versions of a model that are there as a whole."""
    return sorted(r["version"] for r in _manifest(spark, root, name).select("version").distinct().collect())


def _new_parts(spark: SparkSession, root: str, name: str, version: int) -> str:
    if version in versions(spark, root, name):
        raise FileExistsError(f"{name} has a version {version}")
    return f"{root.rstrip('/')}/{name}/_parts-{uuid.uuid4().hex}"


def _publish(spark: SparkSession, root: str, name: str, version: int, parts: str) -> str:
    """The last step of a save: one row is appended to the manifest, in one file that appears when it is whole."""
    row = spark.createDataFrame([(version, parts.rsplit("/", 1)[1])], MANIFEST)
    row.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/{name}/manifest")
    return parts


def _parts(spark: SparkSession, root: str, name: str, version: int | None) -> str:
    """The folder of a version's parts; of the latest version if none is named."""
    found = _manifest(spark, root, name)
    found = found.orderBy(F.desc("version")) if version is None else found.filter(F.col("version") == version)
    row = found.first()
    if row is None:
        raise FileNotFoundError(f"{name} has no version {'at all' if version is None else version} below {root}")
    return f"{root.rstrip('/')}/{name}/{row['parts']}"


def _save_signature(folder: str, example: DataFrame) -> None:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(example.schema.fields)]
    table = example.sparkSession.createDataFrame(rows, "position int, name string, type string")
    table.coalesce(1).write.json(f"{folder}/signature")


def save_model(model: PipelineModel, root: str, name: str, example: DataFrame, version: int = 1) -> str:
    """Save the model and, beside it, the schema of its input (columns and types of ``example``). A save that stops in
    between leaves no version, and can be repeated."""
    spark = example.sparkSession
    folder = _new_parts(spark, root, name, version)
    model.write().save(f"{folder}/model")
    _save_signature(folder, example)
    return _publish(spark, root, name, version, folder)


def save_cascade(cascade: ForestCascade, root: str, name: str, example: DataFrame, version: int = 1) -> str:
    """Every forest of every layer, their number, and the final predictor (layer -1), beside the input schema; as whole
    as by ``save_model``."""
    spark = example.sparkSession
    folder = _new_parts(spark, root, name, version)
    for depth, forests in enumerate(cascade.layers):
        for i, forest in enumerate(forests):
            forest.write().save(f"{folder}/layers/{depth}/{i}")
    shape = [(depth, len(forests)) for depth, forests in enumerate(cascade.layers)]
    if cascade.predictor is not None:
        cascade.predictor.write().save(f"{folder}/layers/-1/0")
        shape.append((-1, 1))
    spark.createDataFrame(shape, "layer int, forests int").coalesce(1).write.json(f"{folder}/shape")
    _save_signature(folder, example)
    return _publish(spark, root, name, version, folder)


def load_cascade(spark: SparkSession, root: str, name: str, version: int | None = 1) -> ForestCascade:
    folder = _parts(spark, root, name, version)
    shape = spark.read.schema("layer int, forests int").json(f"{folder}/shape").orderBy("layer").collect()
    loaded = {r["layer"]: tuple(PipelineModel.load(f"{folder}/layers/{r['layer']}/{i}") for i in range(r["forests"])) for r in shape}
    final = loaded.pop(-1, (None,))[0]
    return ForestCascade(tuple(_signature(spark, folder).names), tuple(loaded[k] for k in sorted(loaded)), final)


def load_model(root: str, name: str, version: int | None = 1) -> PipelineModel:
    return PipelineModel.load(f"{_parts(SparkSession.active(), root, name, version)}/model")


def load_signature(spark: SparkSession, root: str, name: str, version: int | None = 1) -> T.StructType:
    """The input schema kept with a model (one row per input column)."""
    return _signature(spark, _parts(spark, root, name, version))


def _signature(spark: SparkSession, folder: str) -> T.StructType:
    rows = spark.read.schema("position int, name string, type string").json(f"{folder}/signature")
    fields = rows.orderBy("position").select(F.col("name"), F.col("type")).collect()
    return T.StructType([T.StructField(r["name"], T.DataType.fromDDL(r["type"])) for r in fields])
