import datetime as dt
import random
import re

import numpy as np
import pytest
from gridloom.functions.grid import Grid
from gridloom.operators import align
from gridloom.session import lookup_join

SRC, DST = Grid(0.0, 6.0, 1.0, 1.0, 6, 5), Grid(0.0, 6.0, 0.3, 0.4, 15, 16)


def raster(spark, fn, grid=SRC, **more):
    rows = [(r, c, fn(r, c)) for r in range(grid.rows) for c in range(grid.cols)]
    return spark.createDataFrame([(a, b, None if v is None else float(v)) for a, b, v in rows], "row int, col int, value double")


def brute(values, src, dst, nodata):
    out = {}
    for r in range(dst.rows):
        for c in range(dst.cols):
            fy = (src.y0 - (dst.y0 - (r + 0.5) * dst.dy)) / src.dy - 0.5
            fx = (dst.x0 + (c + 0.5) * dst.dx - src.x0) / src.dx - 0.5
            i, j = int(np.floor(fy)), int(np.floor(fx))
            top = bottom = 0.0
            for a, wy in ((i, 1 - (fy - i)), (i + 1, fy - i)):
                for b, wx in ((j, 1 - (fx - j)), (j + 1, fx - j)):
                    v = values.get((a, b))
                    if v is not None and v != nodata:
                        top, bottom = top + wy * wx * v, bottom + wy * wx
            out[(r, c)] = top / bottom if bottom > 0 else None
    return out


def test_regrid_equals_brute_force(spark):
    draw = random.Random(2)
    values = {(r, c): draw.choice([draw.random(), draw.random(), -1.0, None]) for r in range(6) for c in range(5)}
    wider = Grid(-1.0, 7.0, 0.37, 0.53, 16, 20)
    for dst in (DST, wider):
        got = align.regrid_bilinear(raster(spark, lambda r, c: values[(r, c)]), SRC, dst, nodata=-1.0).collect()
        want = brute(values, SRC, dst, -1.0)
        assert {(r["row"], r["col"]) for r in got} == set(want)
        for r in got:
            assert r["value"] == pytest.approx(want[(r["row"], r["col"])]) if want[(r["row"], r["col"])] is not None else r["value"] is None


def test_regrid_keeps_a_plane(spark):
    got = align.regrid_bilinear(raster(spark, lambda r, c: 2 * r + 3 * c), SRC, DST).collect()
    for r in got:
        fy, fx = (r["row"] + 0.5) * 0.4 - 0.5, (r["col"] + 0.5) * 0.3 - 0.5
        if 0 <= fy <= 5 and 0 <= fx <= 4:
            assert r["value"] == pytest.approx(2 * fy + 3 * fx)


def test_sampled_fields_equal_regrid_then_interpolation(spark):
    hours = [dt.datetime(2024, 2, 6, h) for h in (10, 11, 12)]
    draw = random.Random(4)
    rows = [(v, h, r, c, draw.choice([draw.random(), draw.random(), -9.0])) for v in ("a", "b") for h in hours for r in range(6) for c in range(5)]
    fields = spark.createDataFrame(rows, "variable string, hour timestamp_ntz, row int, col int, value double")
    times = {1: dt.datetime(2024, 2, 6, 10, 20, 59), 2: dt.datetime(2024, 2, 6, 12, 30), 3: dt.datetime(2024, 2, 6, 11, 0)}
    cells = spark.createDataFrame([(o, r, c, t) for o, t in times.items() for r in range(DST.rows) for c in range(0, DST.cols, 3)], "orbit int, row int, col int, ts timestamp_ntz")
    got = align.sample_fields(cells, fields, ["a", "b"], SRC, DST, ["orbit"], nodata=-9.0).collect()
    grids = {(v, h): brute({(r, c): x for vv, hh, r, c, x in rows if (vv, hh) == (v, h)}, SRC, DST, -9.0) for v in ("a", "b") for h in hours}
    assert len(got) == cells.count()
    for r in got:
        t = times[r["orbit"]]
        h0, m = t.replace(minute=0, second=0), t.minute
        for v in ("a", "b"):
            a, b = grids[(v, h0)][(r["row"], r["col"])], grids.get((v, h0 + dt.timedelta(hours=1)), {}).get((r["row"], r["col"]))
            want = None if a is None or b is None else (b * m + a * (60 - m)) / 60
            assert r[v] == (None if want is None else pytest.approx(want))


def test_hourly_interpolation(spark):
    hourly = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), float(h * 10)) for h in (21, 22, 23)], "hour timestamp_ntz, value double")
    obs = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 21, 0, 59)), (2, dt.datetime(2024, 1, 1, 21, 30)), (3, dt.datetime(2024, 1, 1, 23, 10)), (4, dt.datetime(2024, 1, 1, 5, 0))], "i int, ts timestamp_ntz")
    got = {r["i"]: r["value_at"] for r in align.hourly_bracket_interp(obs, hourly).collect()}
    assert got == {1: 210.0, 2: 215.0, 3: None, 4: None}


def test_window_is_half_open_and_skips_one_column(spark):
    rows = [("a", r, c, 20.0 + c, 40.0 - r) for r in range(5) for c in range(5)] + [("b", r, 0, 20.0, 40.0) for r in range(3)] + [("c", 0, 0, 99.0, 0.0)]
    points = spark.createDataFrame(rows, "g string, row int, col int, lon double, lat double")
    windows = align.bbox_index_window(points, (20.0, 37.0, 23.0, 40.0), ["g"])
    got = {r["g"]: tuple(r)[1:] for r in windows.select("g", "col_min", "col_max", "row_min", "row_max", "out_of_range").collect()}
    assert got == {"a": (0, 3, 0, 3, False), "b": (0, 0, 0, 2, True), "c": (0, 0, 0, 0, True)}
    kept = align.slice_window(points, windows, ["g"]).collect()
    assert {(r["g"], r["row"], r["col"]) for r in kept} == {("a", r, c) for r in range(3) for c in range(3)}


def test_nearest_takes_first_of_equals(spark):
    points = spark.createDataFrame([(2, 0, 1.0, 0.0), (1, 5, -1.0, 0.0), (1, 3, 1.0, 0.0), (0, 0, float("nan"), 0.0), (0, 1, 5.0, 5.0)], "row int, col int, lon double, lat double")
    got = align.nearest_pixel(points, 0.0, 0.0).first()
    assert (got["row"], got["col"]) == (1, 3)


def test_dates_and_layers(spark):
    pixels = spark.createDataFrame([(1, "x", 0, 0, 1.0), (1, "y", 0, 0, 2.0), (2, "x", 0, 0, 3.0), (None, "s", 0, 0, 9.0), (3, "y", 0, 0, 1.0), (3, "other", 0, 0, 1.0)], "date int, layer string, row int, col int, value double")
    assert {r["date"] for r in align.complete_dates(pixels, ["x", "y"]).collect()} == {1}
    assert {tuple(r) for r in align.missing_layers(pixels, ["x", "y"]).collect()} == {(2, "y"), (3, "x")}
    dates = spark.createDataFrame([(7,)], "date int")
    assert {tuple(r) for r in align.missing_layers(pixels, ["x", "y"], dates).collect()} == {(7, "x"), (7, "y")}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_shuffled_or_broadcast(spark, how):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 4) for i in range(40)], "i int, k int")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    got = sorted(tuple(r) for r in lookup_join(df, table, ["k"], how).collect())
    names = {1: "a", 2: "b", None: "n"}
    rows = [(i, None if i % 4 == 0 else i % 4) for i in range(40)]
    want = {
        "left": [(i, k, names.get(k)) for i, k in rows], "inner": [(i, k, names[k]) for i, k in rows if k in names],
        "left_semi": [(i, k) for i, k in rows if k in names], "left_anti": [(i, k) for i, k in rows if k not in names],
    }[how]
    assert got == sorted(want)


def test_frequency_of_absent_and_missing_values(spark):
    df = spark.createDataFrame([(0.1 + 0.2,), (0.3,), (None,), (7.0,), (9.0,)], "v double")
    table = spark.createDataFrame([(0.3, 5), (0.1 + 0.2, 1), (None, 9), (9.0, 5000)], "v double, count bigint")
    got = {r["v"]: r["frequency"] for r in align.lookup_frequency(df, table, "v").collect()}
    assert got == {0.1 + 0.2: 1, 0.3: 5, None: 0, 7.0: 0, 9.0: 5000}


def test_swath_fills_every_cell_inside(spark):
    """A plane over a tilted swath: every centre inside it gets the plane's value, also beside missing points."""
    grid = Grid(0.0, 10.0, 0.25, 0.25, 40, 40)
    rows = []
    for scan in range(6):
        for ground in range(6):
            lon, lat = 1.0 + ground * 1.3 + scan * 0.1, 9.0 - scan * 1.2 + ground * 0.15
            rows.append((scan, ground, lon, lat, None if (scan, ground) == (2, 2) else 3.0 * lon - lat))
    points = spark.createDataFrame(rows, "scan int, ground int, lon double, lat double, value double")
    got = {(r["row"], r["col"]): r["value"] for r in align.interpolate_swath(points, grid).collect()}
    corner = {(s, g): (x, y) for s, g, x, y, _ in rows}
    ring = [corner[0, g] for g in range(6)] + [corner[s, 5] for s in range(1, 6)] + [corner[5, g] for g in range(4, -1, -1)] + [corner[s, 0] for s in range(4, 0, -1)]

    def inside(x, y):
        odd = False
        for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
            if (ya > y) != (yb > y) and x < xa + (y - ya) / (yb - ya) * (xb - xa):
                odd = not odd
        return odd

    centres = {(i, j): (0.125 + 0.25 * j, 9.875 - 0.25 * i) for i in range(40) for j in range(40)}
    assert set(got) == {k for k, c in centres.items() if inside(*c)}
    assert all(v is not None for v in got.values())
    x2, y2 = corner[2, 2]
    for k, v in got.items():
        x, y = centres[k]
        if abs(x - x2) > 1.6 or abs(y - y2) > 1.6:
            assert v == pytest.approx(3.0 * x - y)
    assert align.interpolate_swath(points.limit(0), grid).count() == 0


def test_regrid_lists_quads_after_the_shuffle_in_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    monkeypatch.setattr(align, "TASK_QUADS", 500)
    pixels = spark.range(40).selectExpr("id AS tile", "explode(sequence(0, 3)) AS row").selectExpr("*", "explode(sequence(0, 3)) AS col", "cast(row AS double) AS value")
    done = align.regrid_bilinear(pixels, Grid(0.0, 4.0, 1.0, 1.0, 4, 4), Grid(0.0, 4.0, 0.5, 0.5, 8, 8), ["tile"])
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan.partition("REPARTITION_BY_NUM")[2] and "REPARTITION_BY_NUM" in plan, plan
    assert done.rdd.getNumPartitions() > 3
    assert done.count() == 40 * 64


def test_swath_code_is_short_enough_to_be_compiled(spark, capsys):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        points = spark.range(400).selectExpr("id div 20 AS scan", "id % 20 AS ground", "id % 20 * 0.3D AS lon", "10 - id div 20 * 0.3D AS lat", "cast(id AS double) AS value")
        done = align.interpolate_swath(points, Grid(0.0, 10.0, 0.1, 0.1, 100, 100))
        done.explain("codegen")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000, sizes  # the JVM compiles no longer methods
