"""Layers, dates, hours and grids brought together by key."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.grid import Grid, cell_of, in_box
from gridloom.functions.physics import haversine_m
from gridloom.functions.temporal import hour_start
from gridloom.operators.select import arg_best
from gridloom.session import clean, lookup_join, noted, settle

CELL = ["row", "col"]

# Side of the blocks in which quads and cells of a grid are listed, and the quads that a task lists at most, about.
BLOCK, TASK_QUADS = 32, 1 << 18


def _tasks(quads: int) -> int:
    """As many tasks as a number of quads asks for, so that the memory of one does not follow the table."""
    return max(1, -(-quads // TASK_QUADS))


def _columns_of(name: str, kinds: Sequence[object], value: Column) -> list[Column]:
    return [F.max(F.when(F.col(name) == F.lit(kind), value)).alias(str(kind)) for kind in kinds]


def stack_layers(pixels: DataFrame, layers: Sequence[object], keys: Sequence[str] = ("date", "row", "col")) -> DataFrame:
    """Long (layer, value) pixels to one column per layer.

    One conditional aggregation, so one shuffle whatever the number of layers; ``pivot`` would shuffle
    by (cell, layer) and again by cell.
    """
    return pixels.groupBy(*keys).agg(*_columns_of("layer", layers, F.col("value")))


def join_static(dynamic: DataFrame, static: DataFrame, on: Sequence[str] = CELL) -> DataFrame:
    """Date-less layers repeated for every date; a dynamic layer wins over a static one of the same name.

    The static grid is a stored table whose size Spark knows: it is broadcast below the session's
    broadcast limit and shuffled above it.
    """
    extra = [c for c in static.columns if c not in set(dynamic.columns)]
    return dynamic.join(static.select(*on, *[F.col(f"`{c}`") for c in extra]), list(on), "inner")


def _present(pixels: DataFrame) -> DataFrame:
    return pixels.filter(F.col("date").isNotNull()).select("date", "layer").distinct()


def complete_date_list(pixels: DataFrame, layers: Sequence[object]) -> DataFrame:
    wanted = _present(pixels).filter(F.col("layer").isin(list(layers)))
    return wanted.groupBy("date").agg(F.count("*").alias("_n")).filter(F.col("_n") == len(set(layers))).select("date")


def complete_dates(pixels: DataFrame, layers: Sequence[object]) -> DataFrame:
    """Rows of the dates for which every layer exists."""
    return lookup_join(pixels, complete_date_list(pixels, layers), ["date"], "left_semi")


def missing_layers(pixels: DataFrame, layers: Sequence[object], dates: DataFrame | None = None) -> DataFrame:
    """(date, layer) pairs that should exist and do not; dates default to those that have any layer."""
    present = _present(pixels)
    dates = present.select("date").distinct() if dates is None else dates
    expected = dates.select("date", F.explode(F.array(*[F.lit(x) for x in layers])).alias("layer"))
    return expected.join(present, ["date", "layer"], "left_anti")


def bracket_hours(hourly: DataFrame, keys: Sequence[str], hour: str = "hour", value: str = "value") -> DataFrame:
    """Each hour's value beside the next hour's: keys, hour, v0, v1 (v1 NULL when there is no next hour).

    Every row is sent to its own hour and to the one before, so one aggregation pairs them up and its
    output is already distributed by the key that the later join needs.
    """
    own = F.struct(F.col(hour).alias("h"), F.col(value).alias("a"), F.lit(None).cast("double").alias("b"))
    before = F.struct(
        (F.col(hour) - F.expr("interval 1 hour")).alias("h"), F.lit(None).cast("double").alias("a"), F.col(value).alias("b")
    )
    sent = hourly.select(*keys, F.explode(F.array(own, before)).alias("p"))
    paired = sent.groupBy(*keys, F.col("p.h").alias(hour)).agg(F.max("p.a").alias("v0"), F.max("p.b").alias("v1"))
    return paired.filter(F.col("v0").isNotNull())


def hourly_bracket_interp(
    obs: DataFrame, hourly: DataFrame, ts: str = "ts", keys: Sequence[str] = (), hour: str = "hour", value: str = "value",
    out: str = "value_at",
) -> DataFrame:
    """Hourly values at observation times: linear between the hour and the next, by whole minutes.

    ``hourly`` has ``keys`` (e.g. variable, row, col), the hour as a timestamp and the value. An
    observation without both hours gets NULL.
    """
    brackets = bracket_hours(hourly, keys, hour, value)
    timed = obs.withColumn(hour, hour_start(F.col(ts)).cast(hourly.schema[hour].dataType))
    joined = lookup_join(timed, brackets, [*keys, hour])
    minute = F.minute(F.col(ts)).cast("double")
    mixed = (F.col("v1") * minute + F.col("v0") * (F.lit(60.0) - minute)) / F.lit(60.0)
    return joined.withColumn(out, mixed).drop(hour, "v0", "v1")


def sample_fields(
    cells: DataFrame, fields: DataFrame, variables: Sequence[str], src: Grid, dst: Grid, keys: Sequence[str], ts: str = "ts",
    hour: str = "hour", nodata: float | None = None,
) -> DataFrame:
    """Hourly fields (variable, hour, row, col, value) of a coarse grid at cells (keys, row, col, ts) of a finer one.

    Bilinear in space with weights renormalised over valid neighbours, linear in time by whole minutes
    between the hour and the next; NULL where an hour has no valid neighbour. It gives what regridding
    every hour and then interpolating would, but only at the cells asked for.

    A field's pixel goes to the four quads it is a corner of, for its own hour and the one before, and one aggregation
    makes a row of each quad and hour with eight values per variable. Cells are joined to these once and stay one
    row each; the quads are a written table, so a small one is broadcast by its bytes.
    """
    value = clean("value") if nodata is None else F.when(F.col("value") != nodata, clean("value"))
    wide = fields.groupBy(hour, "row", "col").agg(*_columns_of("variable", variables, value))
    hours = [F.col(hour), F.col(hour) - F.expr("interval 1 hour")]
    ends = [F.struct(h.alias("h"), (F.col("row") - i).alias("i"), (F.col("col") - j).alias("j"), F.lit(4 * t + 2 * i + j).alias("k")) for t, h in enumerate(hours) for i in (0, 1) for j in (0, 1)]
    sent = wide.select(F.explode(F.array(*ends)).alias("_e"), *[F.col(v).cast("double").alias(f"_v{n}") for n, v in enumerate(variables)])
    corners = [F.max(F.when(F.col("_e.k") == k, F.col(f"_v{n}"))).alias(f"_c{n}_{k}") for n in range(len(variables)) for k in range(8)]
    quads = sent.groupBy(F.col("_e.h").alias("_h"), F.col("_e.i").alias("_i"), F.col("_e.j").alias("_j")).agg(*corners)
    packed = [F.array(*[F.col(f"_c{n}_{k}") for k in range(8)]) for n in range(len(variables))]
    quads = noted(quads.select("_h", "_i", "_j", F.array(*packed).alias("_q")))

    fy = _position(F.col("row"), src.y0, src.dy, dst.y0, dst.dy, -1.0)
    fx = _position(F.col("col"), src.x0, src.dx, dst.x0, dst.dx, 1.0)
    start = hour_start(F.col(ts)).cast(fields.schema[hour].dataType)
    asked = cells.select(*keys, "row", "col", ts, F.minute(F.col(ts)).cast("double").alias("_m"), start.alias("_h"), fy.alias("_y"), fx.alias("_x"))
    asked = asked.withColumns({"_i": F.floor("_y").cast("int"), "_j": F.floor("_x").cast("int")})
    asked = asked.withColumn("_w", F.array(*_shares(F.col("_y") - F.col("_i"), F.col("_x") - F.col("_j")))).drop("_y", "_x")
    joined = lookup_join(asked, quads, ["_h", "_i", "_j"])

    def at_time(q: Column) -> Column:
        first, then = (_weighted([q[4 * t + k] for k in range(4)], [F.col("_w")[k] for k in range(4)]) for t in (0, 1))
        return (then * F.col("_m") + first * (F.lit(60.0) - F.col("_m"))) / F.lit(60.0)

    # one lambda for all variables: written out for each, the sums outgrow a generated method
    mixed = joined.withColumn("_z", F.transform("_q", at_time))
    return mixed.select(*keys, "row", "col", ts, *[F.get("_z", F.lit(n)).alias(v) for n, v in enumerate(variables)])


def _shares(v: Column, u: Column) -> list[Column]:
    """Weights of the four corners of a quad (upper left, upper right, lower left, lower right) at a place in it."""
    one = F.lit(1.0)
    return [(one - v) * (one - u), (one - v) * u, v * (one - u), v * u]


def _weighted(values: list[Column], weights: list[Column]) -> Column:
    """Mean of the valid values; NULL where none has a weight."""
    none = F.lit(0.0)
    sums = [F.coalesce(w * x, none) for w, x in zip(weights, values)]
    parts = [F.when(x.isNotNull(), w).otherwise(none) for w, x in zip(weights, values)]
    return F.try_divide(sums[0] + sums[1] + sums[2] + sums[3], parts[0] + parts[1] + parts[2] + parts[3])


def bbox_index_window(
    points: DataFrame, box: tuple[float, float, float, float], by: Sequence[str] = (), lon: str = "lon", lat: str = "lat",
    row: str = "row", col: str = "col",
) -> DataFrame:
    """Smallest index window that holds the points inside the box; 0,0,0,0 when none is inside.

    ``out_of_range`` marks a window of a single column (or none), which is to be skipped.
    """
    inside = in_box(F.col(lon), F.col(lat), box)
    found = points.groupBy(*by).agg(
        *[
            F.coalesce(agg(F.when(inside, F.col(c))), F.lit(0)).alias(name)
            for name, agg, c in (
                ("col_min", F.min, col), ("col_max", F.max, col), ("row_min", F.min, row), ("row_max", F.max, row),
            )
        ]
    )
    return found.withColumn("out_of_range", F.col("col_min") == F.col("col_max"))


def slice_window(points: DataFrame, windows: DataFrame, by: Sequence[str], row: str = "row", col: str = "col") -> DataFrame:
    """Points inside their window, which is half-open: the last row and column are left out."""
    kept = lookup_join(points, windows.filter(~F.col("out_of_range")), list(by), "inner")
    kept = kept.filter(
        (F.col(row) >= F.col("row_min")) & (F.col(row) < F.col("row_max"))
        & (F.col(col) >= F.col("col_min")) & (F.col(col) < F.col("col_max"))
    )
    return kept.drop("col_min", "col_max", "row_min", "row_max", "out_of_range")


def nearest_pixel(
    points: DataFrame, lon0: float, lat0: float, by: Sequence[str] = (), keep: Sequence[str] = (), lon: str = "lon",
    lat: str = "lat", row: str = "row", col: str = "col",
) -> DataFrame:
    """Per group, the pixel nearest to a point by great circle; the first in row-major order on ties."""
    distance = haversine_m(clean(lon), clean(lat), lon0, lat0)
    measured = points.select(*by, row, col, *keep, distance.alias("distance_m"))
    return arg_best(measured, "distance_m", [row, col], "min", by)


def lookup_frequency(df: DataFrame, frequencies: DataFrame, value: str, count: str = "count", out: str = "frequency") -> DataFrame:
    """The count of each row's value, 0 when the value is not in the table or missing."""
    table = frequencies.select(F.col(f"`{value}`"), F.col(f"`{count}`").alias(out)).filter(F.col(f"`{value}`").isNotNull())
    return lookup_join(df, table, [value]).withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def bind_columns(df: DataFrame, first: Mapping[str, Column], then: Sequence[str]) -> DataFrame:
    """Transformed columns, then unchanged ones, of the same row: no join by position."""
    return df.select(*[c.alias(n) for n, c in first.items()], *[F.col(f"`{n}`") for n in then])


def _inside(quad: Column, src_from: float, src_step: float, dst_from: float, dst_step: float, count: int) -> Column:
    """Target indexes whose centre may lie in a quad, which begins at the centre of source index ``quad``."""
    lo, hi = (((quad + F.lit(0.5 + k)) * src_step + src_from - dst_from) / dst_step - 0.5 for k in (0, 1))
    first = F.greatest(F.floor(lo), F.lit(0)).cast("int")
    last = F.least(F.ceil(hi), F.lit(count - 1)).cast("int")
    return F.when(first <= last, F.sequence(first, last))


def _first_and_last(count: int, src_from: float, src_step: float, dst_from: float, dst_step: float, sign: float) -> tuple[int, int]:
    """Quads that the first and the last target index are in."""
    at = [((dst_from + sign * (k + 0.5) * dst_step) - src_from) / src_step * sign - 0.5 for k in (0, count - 1)]
    return math.floor(at[0]) - 1, math.floor(at[1]) + 1


def _position(index: Column, src_from: float, src_step: float, dst_from: float, dst_step: float, sign: float) -> Column:
    """Centre of a target index in source index units."""
    center = F.lit(dst_from) + F.lit(sign) * ((index + F.lit(0.5)) * F.lit(dst_step))
    return (center - F.lit(src_from)) / F.lit(src_step) * F.lit(sign) - F.lit(0.5)


def regrid_bilinear(
    pixels: DataFrame, src: Grid, dst: Grid, keys: Sequence[str] = (), nodata: float | None = None, complete: bool = True,
) -> DataFrame:
    """Bilinear resampling between regular grids; weights are renormalised over the valid neighbours.

    A pixel goes to the blocks (BLOCK by BLOCK quads) that its four quads are in, mostly to one, and a raster's empty quads
    go as one row per block. Quads and target cells are listed after that shuffle only, in as many tasks as the rows ask
    for, so neither what is shuffled nor the memory of a task follows the cells. With ``complete`` every target cell of
    every raster is present, NULL where nothing reaches it.
    """
    value = clean("value")
    valid = value.isNotNull() if nodata is None else value.isNotNull() & (value != nodata)

    def blocks(at: Column) -> Column:
        return F.explode(F.array_distinct(F.array(F.floor((at - 1) / BLOCK), F.floor(at / BLOCK))))

    sent = pixels.filter(valid).select(*keys, F.col("row").cast("int").alias("_r"), F.col("col").cast("int").alias("_c"), F.col("value").cast("double").alias("_v"))
    sent = sent.withColumn("_bi", blocks(F.col("_r"))).withColumn("_bj", blocks(F.col("_c")))
    top, bottom = _first_and_last(dst.rows, src.y0, src.dy, dst.y0, dst.dy, -1.0)
    left, right = _first_and_last(dst.cols, src.x0, src.dx, dst.x0, dst.dx, 1.0)

    def listed(block: Column, first: int, last: int) -> Column:
        return F.sequence(F.greatest(block * BLOCK, F.lit(first)).cast("int"), F.least(block * BLOCK + (BLOCK - 1), F.lit(last)).cast("int"))

    if complete:
        rasters = settle(pixels.select(*keys).distinct() if keys else pixels.sparkSession.range(1).select())
        tasks = _tasks(rasters.count() * (bottom - top + 1) * (right - left + 1))
        blank = rasters.withColumn("_bi", F.explode(F.sequence(F.lit(top // BLOCK), F.lit(bottom // BLOCK))))
        blank = blank.withColumn("_bj", F.explode(F.sequence(F.lit(left // BLOCK), F.lit(right // BLOCK))))
        sent = sent.unionByName(blank, allowMissingColumns=True)
    else:
        tasks = _tasks(pixels.filter(valid).count() * 4)
    place = [*keys, "_bi", "_bj"]
    kind = "array<struct<i: int, j: int, k: int>>"
    corners = F.array(*[F.struct((F.col("_r") - i).alias("i"), (F.col("_c") - j).alias("j"), F.lit(2 * i + j).alias("k")) for i in (0, 1) for j in (0, 1)]).cast(kind)
    empty = F.flatten(
        F.transform(
            listed(F.col("_bi"), top, bottom),
            lambda i: F.transform(listed(F.col("_bj"), left, right), lambda j: F.struct(i.alias("i"), j.alias("j"), F.lit(None).cast("int").alias("k"))),
        )
    ).cast(kind)
    held = sent.repartition(tasks, *place).select(*place, "_v", F.explode(F.when(F.col("_r").isNull(), empty).otherwise(corners)).alias("_q")).select(*place, "_v", "_q.*")
    held = held.filter((F.floor(F.col("i") / BLOCK) == F.col("_bi")) & (F.floor(F.col("j") / BLOCK) == F.col("_bj")))
    quads = held.groupBy(*place, "i", "j").agg(*[F.max(F.when(F.col("k") == k, F.col("_v"))).alias(f"_v{k}") for k in range(4)])

    # y grows downwards in row order, hence the mirrored axis
    cells = quads.withColumn("row", F.explode(_inside(F.col("i"), -src.y0, src.dy, -dst.y0, dst.dy, dst.rows)))
    cells = cells.withColumn("_y", _position(F.col("row"), src.y0, src.dy, dst.y0, dst.dy, -1.0)).filter(F.floor("_y") == F.col("i"))
    cells = cells.withColumn("col", F.explode(_inside(F.col("j"), src.x0, src.dx, dst.x0, dst.dx, dst.cols)))
    cells = cells.withColumn("_x", _position(F.col("col"), src.x0, src.dx, dst.x0, dst.dx, 1.0)).filter(F.floor("_x") == F.col("j"))
    found = _weighted([F.col(f"_v{k}") for k in range(4)], _shares(F.col("_y") - F.col("i"), F.col("_x") - F.col("j")))
    out = cells.select(*keys, "row", "col", found.alias("value"))
    return out if complete else out.filter(F.col("value").isNotNull())


def interpolate_swath(
    points: DataFrame, dst: Grid, keys: Sequence[str] = (), scan: str = "scan", ground: str = "ground", lon: str = "lon", lat: str = "lat", value: str = "value",
) -> DataFrame:
    """Values of a swath at the centres of all grid cells inside it: linear in the two triangles of each four neighbours.

    ``points`` has one row per (keys, scan, ground), with its place; a missing value keeps its place but has
    no weight, and the weights of the others are raised to one. A cell whose corners are all missing has
    a missing value; a cell outside of the swath has no row. A centre on a shared edge belongs to the first
    triangle in the order of scan, ground (below 2 ** 20) and triangle.

    Each point goes to the four quads it is a corner of and one aggregation makes a row of each quad. Quads go to the
    blocks (BLOCK by BLOCK cells) that their box touches, and only there are the cells listed, in as many tasks as
    the points ask for: what is shuffled follows the points, not the cells.
    """
    corner = [F.struct((F.col(scan) - i).alias("s"), (F.col(ground) - j).alias("g"), F.lit(2 * i + j).alias("k")) for i in (0, 1) for j in (0, 1)]
    sent = points.select(*keys, clean(F.col(lon)).alias("x"), clean(F.col(lat)).alias("y"), clean(F.col(value)).alias("v"), F.explode(F.array(*corner)).alias("c"))
    parts = [F.max(F.when(F.col("c.k") == k, F.col(n))).alias(f"{n}{k}") for k in range(4) for n in ("x", "y", "v")]
    quads = sent.groupBy(*keys, "c.s", "c.g").agg(*parts).dropna(subset=[f"{n}{k}" for k in range(4) for n in ("x", "y")])

    def reach(name: str, origin: float, step: float, count: int, sign: float) -> tuple[Column, Column]:
        ends = [(F.col(f"{name}{k}") - F.lit(origin)) * F.lit(sign) / F.lit(step) - F.lit(0.5) for k in range(4)]
        return F.greatest(F.ceil(F.least(*ends)), F.lit(0)).cast("int"), F.least(F.floor(F.greatest(*ends)), F.lit(count - 1)).cast("int")

    (r0, r1), (c0, c1) = reach("y", dst.y0, dst.dy, dst.rows, -1.0), reach("x", dst.x0, dst.dx, dst.cols, 1.0)
    boxed = quads.withColumns({"_r0": r0, "_r1": r1, "_c0": c0, "_c1": c1}).filter("_r0 <= _r1 AND _c0 <= _c1")
    for at, first, last in (("_bi", "_r0", "_r1"), ("_bj", "_c0", "_c1")):
        boxed = boxed.withColumn(at, F.explode(F.sequence(F.floor(F.col(first) / BLOCK).cast("int"), F.floor(F.col(last) / BLOCK).cast("int"))))
    boxed = boxed.repartition(_tasks(points.count() * 4), *keys, "_bi", "_bj")

    def inside(block: str, first: str, last: str) -> Column:
        start = F.col(block) * BLOCK
        return F.explode(F.sequence(F.greatest(F.col(first), start), F.least(F.col(last), start + (BLOCK - 1))))

    # what does not depend on the cell is made once for a quad: with all of it in the loop, the code is too long to be compiled by the JVM
    triangles = {0: (0, 1, 2), 1: (3, 2, 1)}
    for t, (a, b, c) in triangles.items():
        xa, ya, xb, yb, xc, yc = (F.col(f"{n}{k}") for k in (a, b, c) for n in ("x", "y"))
        boxed = boxed.withColumns({f"_p{t}": yb - yc, f"_q{t}": xc - xb, f"_s{t}": yc - ya, f"_u{t}": xa - xc, f"_area{t}": (yb - yc) * (xa - xc) + (xc - xb) * (ya - yc)})
    own = [f"{n}{t}" for t, (_, _, c) in triangles.items() for n in ("_p", "_q", "_s", "_u", "_area")]
    boxed = boxed.select(*keys, "s", "g", "_bi", "_bj", "_r0", "_r1", "_c0", "_c1", *own, *[f"{n}{c}" for _, _, c in triangles.values() for n in ("x", "y")], *[f"v{k}" for k in range(4)])
    cells = boxed.withColumn("row", inside("_bi", "_r0", "_r1")).withColumn("_y", F.lit(dst.y0) - (F.col("row") + F.lit(0.5)) * F.lit(dst.dy))
    cells = cells.withColumn("col", inside("_bj", "_c0", "_c1")).withColumn("_x", F.lit(dst.x0) + (F.col("col") + F.lit(0.5)) * F.lit(dst.dx))
    for t, (_, _, c) in triangles.items():
        dx, dy = F.col("_x") - F.col(f"x{c}"), F.col("_y") - F.col(f"y{c}")
        shares = {f"_a{t}": F.try_divide(F.col(f"_p{t}") * dx + F.col(f"_q{t}") * dy, F.col(f"_area{t}")), f"_b{t}": F.try_divide(F.col(f"_s{t}") * dx + F.col(f"_u{t}") * dy, F.col(f"_area{t}"))}
        cells = cells.withColumns(shares)

    def holds(t: int) -> Column:
        wa, wb = F.col(f"_a{t}"), F.col(f"_b{t}")
        return F.least(wa, wb, F.lit(1.0) - wa - wb) >= F.lit(-1e-9)

    cells = cells.withColumn("_t", F.when(holds(0), 0).when(holds(1), 1)).filter(F.col("_t").isNotNull())
    first = F.col("_t") == 0
    chosen = {"_wa": (F.col("_a0"), F.col("_a1")), "_wb": (F.col("_b0"), F.col("_b1"))}
    chosen |= {f"_v{n}": tuple(F.col(f"v{triangles[t][i]}") for t in (0, 1)) for i, n in enumerate("abc")}
    hit = cells.select(
        *keys, "_bi", "_bj", "row", "col", ((F.col("s") * 2**20 + F.col("g")) * 2 + F.col("_t")).alias("o"), *[F.when(first, x).otherwise(y).alias(n) for n, (x, y) in chosen.items()]
    )
    weights, values = [F.col("_wa"), F.col("_wb"), F.lit(1.0) - F.col("_wa") - F.col("_wb")], [F.col(f"_v{n}") for n in "abc"]
    known = [F.when(v.isNotNull(), w).otherwise(F.lit(0.0)) for v, w in zip(values, weights)]
    sums = [F.when(v.isNotNull(), w * v).otherwise(F.lit(0.0)) for v, w in zip(values, weights)]
    hit = hit.withColumns({"_good": known[0] + known[1] + known[2], "_sum": sums[0] + sums[1] + sums[2]})
    found = F.when(F.col("_good") > F.lit(1e-9), F.try_divide(F.col("_sum"), F.col("_good")))
    return hit.groupBy(*keys, "_bi", "_bj", "row", "col").agg(F.min_by(found, "o").alias("value")).drop("_bi", "_bj")


def grid_swath(points: DataFrame, dst: Grid, keys: Sequence[str] = (), lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Mean of the valid points in each cell of a regular grid, clipped to the grid: for points denser than the
    grid. ``interpolate_swath`` fills the cells between points that are not."""
    row, col = cell_of(dst, F.col(lon), F.col(lat))
    placed = points.select(*keys, row.alias("row"), col.alias("col"), clean("value").alias("value")).filter(
        F.col("value").isNotNull() & F.col("row").between(0, dst.rows - 1) & F.col("col").between(0, dst.cols - 1)
    )
    return placed.groupBy(*keys, "row", "col").agg(F.avg("value").alias("value"), F.count("*").alias("n"))
