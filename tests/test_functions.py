"""Hand-computed values, with NaN, NULL, code and boundary rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import binning, cleaning, fire, grid, physics, temporal

NAN, ND = float("nan"), 9.96921e36


def values(spark, schema, rows, *columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    out = df.orderBy("i").select(*[c.alias(f"c{n}") for n, c in enumerate(columns)]).collect()
    return [tuple(r) for r in out] if len(columns) > 1 else [r[0] for r in out]


def test_nodata_mask_last_write_wins(spark):
    rows = [
        (5.0, 1.0, 1.0, 0.0), (-5.0, 1.0, 1.0, 0.0), (5.0, None, 1.0, 0.0), (5.0, NAN, 1.0, 0.0), (-5.0, -1.0, 1.0, 0.0), (5.0, ND, 1.0, 0.0),
        (5.0, 1.0, None, 0.0), (-5.0, 1.0, 1.0, 1.5), (-5.0, 1.0, 1.0, -1.5), (5.0, 1.0, 1.0, NAN), (5.0, 1.0, 1.0, None), (5.0, 1.0, 1.0, 1.0),
    ]
    mask = cleaning.nodata_mask(F.col("p"), F.col("co"), F.col("tp"), F.col("v"))
    got = values(spark, "p double, co double, tp double, v double", rows, mask)
    assert got == [5.0, 0.0, ND, ND, ND, ND, ND, ND, ND, 5.0, 5.0, 5.0]


def test_quality_mask_is_strict(spark):
    got = values(spark, "v double, qa double", [(1.0, 0.5), (1.0, 0.51), (1.0, NAN), (1.0, None), (NAN, 0.9)], cleaning.quality_mask(F.col("v"), F.col("qa")))
    assert got == [None, 1.0, None, None, None]


def test_fire_label(spark):
    rows = [(7.0,), (7.5,), (8.0,), (9.0,), (10.0,), (32767.0,), (-1.0,), (NAN,), (None,)]
    got = values(spark, "v double", rows, fire.fire_label(F.col("v")), fire.fire_label(F.col("v"), strict=True))
    assert [g[0] for g in got] == [0, 1, 1, 1, 1, 0, 0, 0, 0]
    assert [g[1] for g in got] == [0, 1, 1, 1, 0, 0, 0, 0, 0]


def test_static_features_clear_codes_first(spark):
    cases = {"elevation": (-9999.0, 0.0), "slope": (NAN, 0.0), "aspect": (-32768.0, 0.0), "tpi": (-99999.0, 18 / 32), "fuel": (None, 0.0), "cover": (-32768.0, 0.0), "height": (3.4e38, 0.0)}
    for name, (code, want) in cases.items():
        assert values(spark, "v double", [(code,)], fire.static_feature(name, F.col("v"))) == [want]
    assert values(spark, "v double", [(2977.0,)], fire.static_feature("elevation", F.col("v"))) == [1.0]
    assert values(spark, "v double", [(14.0,)], fire.static_feature("tpi", F.col("v"))) == [1.0]


def test_features_keep_model_order():
    assert fire.enabled_features(["tpi", "seviri_hrv", "seviri_ir39_"]) == ["seviri_ir39_", "seviri_hrv", "tpi"]
    assert fire.enabled_features({"seviri_ir39_": 1, "seviri_vis06_": 0}) == ["seviri_ir39_"]


def test_band_ratio_zero_denominator(spark):
    assert values(spark, "a double, b double", [(2000.0, 0.0), (2000.0, 500.0)], fire.band_ratio(F.col("a"), F.col("b"))) == [2000.0, 4.0]


def test_weather(spark):
    got = values(spark, "u double, v double", [(3.0, 4.0), (0.0, 0.0), (-1.0, 0.0)], physics.wind_speed(F.col("u"), F.col("v")), physics.wind_direction(F.col("u"), F.col("v")))
    assert got[0] == (5.0, pytest.approx(math.fmod(180 + math.degrees(math.atan2(4, 3)), 360)))
    assert got[1] == (0.0, 180.0)
    assert got[2] == (1.0, 0.0)  # 360 wraps to 0
    e = lambda x: 6.1078 * math.exp(17.1 * x / (235 + x))
    assert values(spark, "d double, t double", [(10.0, 20.0)], physics.relative_humidity(F.col("d"), F.col("t"))) == [pytest.approx(e(10) / e(20))]


def test_distances(spark):
    one_degree = 2 * math.pi * 6371000 / 360
    assert values(spark, "x double, y double", [(0.0, 1.0)], physics.haversine_m(F.col("x"), F.col("y"), 0.0, 0.0)) == [pytest.approx(one_degree)]
    got = values(spark, "x double, y double", [(10.0, 51.0), (10.0, 52.0)], physics.distance_to_center(F.col("x"), F.col("y")))
    assert got == [0.0, pytest.approx(math.sqrt(2 * math.pi * 6371.0088 / 360))]


def test_ratio_modes(spark):
    got = values(spark, "a double, b double", [(4.0, 0.0), (4.0, 2.0), (None, 2.0)], physics.cot_cer_ratio(F.col("a"), F.col("b")), physics.cot_cer_ratio(F.col("a"), F.col("b"), "guarded"))
    assert got == [(4.0 / 1e-6, 0.0), (4.0 / (2 + 1e-6), 2.0), (None, None)]


def test_clock(spark):
    ts = dt.datetime(2024, 2, 6, 11, 20, 5, 250000)
    assert values(spark, "t timestamp_ntz", [(ts,)], temporal.seconds_of_day(F.col("t")), temporal.day_of_year(F.col("t"))) == [(40805.25, 37)]
    assert values(spark, "s string", [("5",), ("1230",), ("930",), ("x",)], temporal.hhmm_seconds(F.col("s"))) == [360, 45060, 34260, None]


def test_bins_follow_the_literal_edges(spark):
    xs = [0.0, 0.05, 0.1, 0.2, 0.3, 0.30000000000000004, 0.6, 0.7, 99.9, 100.0, 100.01, -0.1, NAN, None]
    edges = [i * 0.1 for i in range(1001)]

    def brute(x):
        if x is None or math.isnan(x) or x < 0 or x > edges[-1]:
            return None
        return max(1, next(i for i, e in enumerate(edges) if e >= x))

    got = values(spark, "x double", [(x,) for x in xs], binning.cut_uniform(F.col("x"), 0.1, 1000))
    assert got == [brute(x) for x in xs]
    dense = [e for e in edges] + [math.nextafter(e, 1e9) for e in edges[:-1]]
    assert values(spark, "x double", [(x,) for x in dense], binning.cut_uniform(F.col("x"), 0.1, 1000)) == [brute(x) for x in dense]


def test_thresholds_follow_the_literal_values(spark):
    steps = [i * 0.01 for i in range(100)]
    ps = steps + [math.nextafter(s, -1) for s in steps[1:]] + [1.0, 0.999]
    got = values(spark, "p double", [(p,) for p in ps], binning.threshold_index(F.col("p")))
    assert got == [max(i for i, s in enumerate(steps) if s <= p) for p in ps]


def test_cut_on_arbitrary_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (5.0,), (5.1,), (9.0,), (9.5,), (-1.0,), (NAN,), (None,)], "x double")
    got = [r["b"] for r in binning.cut_right_closed(df, "x", [0.0, 0.1, 5.0, 9.0], "b").collect()]
    assert got == [1, 1, 2, 2, 3, 3, None, None, None, None]


def test_grid_covers_region():
    g = grid.Grid.covering(grid.REGION, grid.TARGET_STEP)
    assert (g.cols, g.rows) == (1135, 829)


def test_paths(spark):
    got = values(spark, "p string", [("a/b.tif",), ("/x/b.tif",)], grid.join_path("/r/", F.col("p")), grid.base_name(F.col("p")), grid.name_token(F.col("p"), "/", 5))
    assert got == [("/r/a/b.tif", "b.tif", None), ("/x/b.tif", "b.tif", None)]
    assert values(spark, "p string", [("X.1.930.tif",)], fire.time_feature(F.col("p"))) == [pytest.approx(math.sin(2 * math.pi * 34260 / 86400))]
