"""Files and catalogues: schemas, boundaries and missing values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from gridloom.functions.grid import Grid
from gridloom.plans import active_fires, precipitation
from gridloom.session import fresh_path, shared_dir
from gridloom.sources import catalogue, pixels, tables


def products(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, start timestamp_ntz, end timestamp_ntz, x0 double, y0 double, x1 double, y1 double")


def test_daylight_window_is_strict(spark):
    day, box = dt.datetime(2024, 2, 6), (0.0, 0.0, 1.0, 1.0)

    def at(h, m=0, s=0):
        return day + dt.timedelta(hours=h, minutes=m, seconds=s)

    rows = [
        (1, "a_CO_b", at(5, 0, 1), at(16, 59, 58), *box), (2, "a_CO_b", at(5), at(6), *box), (3, "a_CO_b", at(6), at(16, 59, 59), *box),
        (4, "a_NO_b", at(6), at(7), *box), (5, "a_CO_b", at(6), at(30), *box), (6, "a_CO_b", at(6), at(7), 50.0, 50.0, 51.0, 51.0),
        (7, "a_CO_b", at(30), at(31), *box), (8, "a_CO_b", at(6), at(7), 1.0, 1.0, 2.0, 2.0),
    ]
    found = catalogue.catalogue_search(products(spark, rows), "CO", day.date(), box=box)
    assert {r["id"] for r in found.collect()} == {1, 8}  # a shared corner meets
    two_days = catalogue.catalogue_search(products(spark, rows), "CO", day.date(), dt.date(2024, 2, 7))
    assert {r["id"] for r in two_days.collect()} == {1, 6, 7, 8}
    found = catalogue.window_search(products(spark, rows), at(6), at(7))
    assert {r["id"] for r in found.collect()} == {4, 6, 8}


def test_product_version(spark):
    box, t = (0.0, 0.0, 1.0, 1.0), dt.datetime(2024, 2, 6)
    names = ["_".join(["S5P", *"abcdefghijk", v]) for v in ("03", "02")] + ["S5P_short", "_".join(["X", *"abcdefghijk", "03"])]
    found = catalogue.product_filter(products(spark, [(i, n, t, t, *box) for i, n in enumerate(names)]))
    assert [r["id"] for r in found.collect()] == [0]


def test_manifest_file(spark):
    path = fresh_path(spark, "manifest")
    rows = [(str(i), 1.5, 2.5, *["t/" + str(i)] * 11, 0, 3, 1, i - 1) for i in range(3)]
    spark.createDataFrame(rows, tables.MANIFEST_SCHEMA).write.option("header", True).csv(path)
    manifest = tables.read_station_csv(spark, path, tables.MANIFEST_SCHEMA)
    found = active_fires.samples(manifest, "/data", -1).collect()
    assert len(found) == 1 and found[0]["SEVIRI"] == "/data/t/0" and found[0]["MODIS_FIRE"] == "t/0" and found[0]["Class_2"] == -1
    assert active_fires.samples(manifest, "/data").count() == 3


def test_station_file_with_missing_column(spark):
    path = fresh_path(spark, "stations")
    spark.range(3).write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="columns missing"):
        tables.read_station_csv(spark, path, tables.CO_SCHEMA)


def test_nan_becomes_null_on_reading(spark):
    path = fresh_path(spark, "stations")
    rows = [(1, 1.0), (2, float("nan")), (3, None)]
    spark.createDataFrame(rows, "station int, `Value COT` double").write.option("header", True).csv(path)
    read = tables.read_station_csv(spark, path, StructType([StructField("Value COT", DoubleType()), StructField("station", IntegerType())]))
    assert sorted(tuple(r) for r in read.collect() if r["Value COT"] is not None) == [(1.0, 1)]
    assert read.filter(F.col("Value COT").isNull()).count() == 2


def test_grid_round_trip(spark):
    grid, path = Grid(20.0, 40.0, 0.5, 0.25, 2, 2), fresh_path(spark, "grid")
    cells = spark.createDataFrame([(dt.date(2024, 1, 1), 0, 0, 1.5), (dt.date(2024, 1, 2), 1, 1, None)], "date date, row int, col int, value double")
    pixels.grid_sink(cells, grid, F.col("value"), path)
    got = {r["date"]: (r["lon"], r["lat"], r["value"]) for r in pixels.read_grid(spark, path).collect()}
    assert got[dt.date(2024, 1, 1)] == (20.0, 40.0, 1.5)
    assert got[dt.date(2024, 1, 2)][:2] == (20.5, 39.75) and got[dt.date(2024, 1, 2)][2] == pytest.approx(9.96921e36, rel=1e-6)


def test_pixels_are_row_major(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0])], "k int, a array<double>")
    got = {(r["row"], r["col"]): r["value"] for r in pixels.pixel_scan(df, "a", 3, ["k"]).collect()}
    assert got == {(i // 3, i % 3): float(i) for i in range(6)}


def test_composite_choice(spark):
    sweep = spark.createDataFrame([(0.0, 1.0, 9.0, 5.0), (0.5, 2.0, 1.0, 1.0), (1.0, 3.0, 1.0, 5.0)], "alpha double, testMAE double, otherMAE double, fewSERA double")
    assert precipitation.best_by_composite(sweep).first()["alpha"] == 0.5


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_one_date_is_replaced(spark, tmp_path):
    grid = Grid(20.0, 40.0, 1.0, 1.0, 2, 2)

    def write(rows):
        pixels.grid_sink(spark.createDataFrame(rows, "date date, row int, col int, v double"), grid, F.col("v"), str(tmp_path / "grid"))

    def there():
        return sorted((str(r["date"]), r["row"], r["col"], r["value"]) for r in pixels.read_grid(spark, str(tmp_path / "grid")).collect())

    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    write([(first, 0, 0, 1.0), (first, 1, 1, 2.0), (second, 0, 0, 3.0)])
    write([(first, 0, 1, 9.0)])
    assert there() == [("2024-01-01", 0, 1, 9.0), ("2024-01-02", 0, 0, 3.0)]
    bad = spark.createDataFrame([(second, 0, 0, "x")], "date date, row int, col int, v string")
    with pytest.raises(Exception):
        pixels.grid_sink(bad, grid, F.assert_true(F.lit(False)).cast("double"), str(tmp_path / "grid"))
    assert there() == [("2024-01-01", 0, 1, 9.0), ("2024-01-02", 0, 0, 3.0)]


def test_many_runs_are_one_scan(spark, tmp_path):
    root, runs = str(tmp_path), [f"run {i}+{i}%" for i in range(12)]
    for i, run in enumerate(runs):
        tables.write_stage(spark.createDataFrame([(i, "x")], "a int, b string").select(*(["a", "b"] if i % 2 else ["a"])), root, run, "part")
    got = tables.read_stages(spark, root, [*runs, runs[0]], "part")
    assert {(r["run_id"], r["a"], r["b"]) for r in got.collect()} == {(run, i, "x" if i % 2 else None) for i, run in enumerate(runs)}
    assert got.count() == 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
