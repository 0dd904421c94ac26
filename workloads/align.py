"""J: layers, dates, hours and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.cleaning import frequency_class
from gridloom.functions.grid import REGION, TARGET_STEP, Grid
from gridloom.functions.temporal import hour_start
from gridloom.operators import align, metrics, scaling
from workloads import tables as t
from workloads.registry import Registry

registry = Registry()
query = registry.add

STACK_SQL = f"""SELECT date, "row", col, {', '.join(f"max(value) FILTER (layer = '{x}') AS {x}" for x in t.LAYERS)}
  FROM ({t.ALL_LAYER_SQL}) GROUP BY date, "row", col"""


def stacked(spark, d):
    return align.stack_layers(t.layer_pixels(spark, d, complete=True), t.LAYERS)


@query("j1_stack_layers", STACK_SQL)
def j1(spark, d):
    return stacked(spark, d)


@query(
    "j2_join_static",
    f"""WITH s AS (SELECT "row", col, max(value) FILTER (layer = 'L1') AS "S1", max(value) FILTER (layer = 'L2') AS "S2"
      FROM ({t.ALL_LAYER_SQL}) GROUP BY "row", col)
    SELECT d.*, s."S1", s."S2" FROM ({STACK_SQL}) d JOIN s USING ("row", col)""",
)
def j2(spark, d):
    static = align.stack_layers(t.layer_pixels(spark, d, complete=True), t.LAYERS, ["row", "col"])
    static = static.select("row", "col", F.lit(-1.0).alias("L0"), F.col("L1").alias("S1"), F.col("L2").alias("S2"))
    return align.join_static(stacked(spark, d), static)


@query(
    "j3_complete_dates",
    f"""SELECT * FROM ({t.LAYER_SQL}) WHERE date IN (SELECT date FROM ({t.LAYER_SQL}) GROUP BY date HAVING count(DISTINCT layer) = 5)""",
)
def j3(spark, d):
    return align.complete_dates(t.layer_pixels(spark, d), t.LAYERS)


@query(
    "j4_missing_layers",
    f"""SELECT date, layer FROM (SELECT DISTINCT date FROM ({t.LAYER_SQL})), (SELECT unnest(['L0', 'L1', 'L2', 'L3', 'L4']) AS layer)
    EXCEPT SELECT date, layer FROM ({t.LAYER_SQL})""",
)
def j4(spark, d):
    return align.missing_layers(t.layer_pixels(spark, d), t.LAYERS)


@query(
    "j5_hourly_bracket_interp",
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS v FROM events GROUP BY ALL)
    SELECT e.event_id, round((b.v * minute(e.ts) + a.v * (60 - minute(e.ts))) / 60, 9) AS value_at
    FROM events e LEFT JOIN h a ON a.event_type = e.event_type AND a.hour = date_trunc('hour', e.ts)
    LEFT JOIN h b ON b.event_type = e.event_type AND b.hour = date_trunc('hour', e.ts) + INTERVAL '1 hour'""",
)
def j5(spark, d):
    events = t.table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    hourly = events.groupBy("event_type", hour_start(F.col("ts")).alias("hour")).agg(F.avg("value").alias("value"))
    found = align.hourly_bracket_interp(events.drop("value"), hourly, keys=["event_type"])
    return found.select("event_id", t.r6(F.col("value_at"), 9).alias("value_at"))


BOX_TEST = f"lon BETWEEN {t.BOX[0]}::DOUBLE AND {t.BOX[2]}::DOUBLE AND lat BETWEEN {t.BOX[1]}::DOUBLE AND {t.BOX[3]}::DOUBLE"
WINDOW_SQL = f"""SELECT *, col_min = col_max AS out_of_range FROM (SELECT orbit,
  coalesce(min(ground) FILTER ({BOX_TEST}), 0) AS col_min, coalesce(max(ground) FILTER ({BOX_TEST}), 0) AS col_max,
  coalesce(min(scan) FILTER ({BOX_TEST}), 0) AS row_min, coalesce(max(scan) FILTER ({BOX_TEST}), 0) AS row_max
  FROM ({t.SWATH_SQL}) GROUP BY orbit)"""


@query(
    "j6_bbox_index_window",
    f"""SELECT w.*, s.event_id FROM ({WINDOW_SQL}) w JOIN ({t.SWATH_SQL}) s USING (orbit)
    WHERE NOT out_of_range AND scan >= row_min AND scan < row_max AND ground >= col_min AND ground < col_max""",
)
def j6(spark, d):
    points = t.swath(spark, d).select("orbit", "scan", "ground", "lon", "lat", "event_id")
    windows = align.bbox_index_window(points, t.BOX, ["orbit"], row="scan", col="ground")
    kept = align.slice_window(points.select("orbit", "scan", "ground", "event_id"), windows, ["orbit"], "scan", "ground")
    return kept.select("orbit", "event_id").join(windows, "orbit")


@query(
    "j7_nearest_pixel",
    f"""WITH p AS (SELECT *, sin(radians(lat - lat0) / 2) AS sl, sin(radians(lon - lon0) / 2) AS so FROM ({t.SWATH_SQL}),
      (SELECT 24.879166666666666::DOUBLE AS lon0, 38.379166666666666::DOUBLE AS lat0)),
    a AS (SELECT *, sl * sl + cos(radians(lat0)) * cos(radians(lat)) * so * so AS a FROM p),
    dist AS (SELECT *, 2 * 6371000.0::DOUBLE * atan2(sqrt(a), sqrt(1 - a)) AS dist FROM a)
    SELECT orbit, scan, ground, ts, round(dist, 4) AS distance_m FROM dist
    QUALIFY row_number() OVER (PARTITION BY orbit ORDER BY round(dist, 4), scan, ground) = 1""",
)
def j7(spark, d):
    points = t.swath(spark, d)
    found = align.nearest_pixel(points, 24.879166666666666, 38.379166666666666, ["orbit"], ["ts"], row="scan", col="ground")
    return found.select("orbit", "scan", "ground", "ts", t.r6(F.col("distance_m"), 4).alias("distance_m"))


@query(
    "j8_lookup_frequency",
    """WITH v AS (SELECT event_id, event_type, floor(value) AS value FROM events),
    f AS (SELECT value, count(*) AS n FROM v WHERE value % 7 <> 3 GROUP BY value)
    SELECT event_id, coalesce(n, 0) AS frequency FROM v LEFT JOIN f USING (value)""",
)
def j8(spark, d):
    v = t.table(spark, d, "events").select("event_id", "event_type", F.floor("value").cast("double").alias("value"))
    known = metrics.value_counts(v.filter(F.col("value") % 7 != 3), "value")  # the table to look up in lacks some values
    return align.lookup_frequency(v, known, "value").select("event_id", "frequency")


@query(
    "j9_bind_columns",
    f"""WITH f AS ({t.FEATURES_SQL}), s AS (SELECT avg(cot) AS mc, stddev_pop(cot) AS sc, avg(cwp) AS mw, stddev_pop(cwp) AS sw FROM f)
    SELECT round((cot - mc) / sc, 6) AS cot, round((cwp - mw) / sw, 6) AS cwp, l_orderkey, l_linenumber FROM f, s""",
)
def j9(spark, d):
    rows = t.feature_rows(spark, d)
    scaled = scaling.apply_standardize(rows, scaling.fit_standardize(rows, ["cot", "cwp"]), ["cot", "cwp"])
    return align.bind_columns(scaled, {"cot": t.r6(F.col("cot")), "cwp": t.r6(F.col("cwp"))}, ["l_orderkey", "l_linenumber"])


@query(
    "j10_regrid_bilinear",
    f"""WITH s AS (SELECT tile, "row", col, value FROM ({t.TILES_SQL}) WHERE NOT bad),
    n AS (SELECT r, c, floor(fy) AS i, floor(fx) AS j, fy - floor(fy) AS v, fx - floor(fx) AS u FROM
      (SELECT r, c, 8.0::DOUBLE - (8.0::DOUBLE - (r + 0.5::DOUBLE) * 0.5::DOUBLE) - 0.5::DOUBLE AS fy, (c + 0.5::DOUBLE) * 0.5::DOUBLE - 0.5::DOUBLE AS fx
       FROM range(16) a(r), range(16) b(c))),
    k AS (SELECT r, c, i AS y, j AS x, (1 - u) * (1 - v) AS w FROM n UNION ALL SELECT r, c, i, j + 1, u * (1 - v) FROM n
      UNION ALL SELECT r, c, i + 1, j, (1 - u) * v FROM n UNION ALL SELECT r, c, i + 1, j + 1, u * v FROM n),
    g AS (SELECT tile, r, c, sum(w * value) / nullif(sum(w), 0) AS value FROM s JOIN k ON s."row" = k.y AND s.col = k.x GROUP BY tile, r, c)
    SELECT e.tile, CAST(e.r AS INTEGER) AS "row", CAST(e.c AS INTEGER) AS col, round(g.value, 6) AS value
    FROM (SELECT vec_id AS tile, r, c FROM embeddings, range(16) a(r), range(16) b(c)) e
    LEFT JOIN g ON g.tile = e.tile AND g.r = e.r AND g.c = e.c""",
)
def j10(spark, d):
    value = F.when(F.col("bad"), F.lit(t.TILE_NODATA)).otherwise(F.col("value"))
    pixels = t.tiles(spark, d).select("tile", "row", "col", value.alias("value"))
    grid = align.regrid_bilinear(pixels, t.TILE_GRID, t.HALF_GRID, ["tile"], t.TILE_NODATA)
    return grid.withColumn("value", t.r6(F.col("value")))


@query(
    "j11_grid_swath",
    f"""SELECT orbit, CAST(floor((41.83333333333333::DOUBLE - lat) / 0.008333333333333333218::DOUBLE) AS INTEGER) AS "row",
      CAST(floor((lon - 20.15::DOUBLE) / 0.008333333333333333218::DOUBLE) AS INTEGER) AS col, round(avg(value), 6) AS value, count(*) AS n
    FROM ({t.SWATH_SQL}) WHERE qa > 0.5 GROUP BY ALL HAVING "row" BETWEEN 0 AND 828 AND col BETWEEN 0 AND 1134""",
)
def j11(spark, d):
    good = t.swath(spark, d).filter(F.col("qa") > 0.5)
    grid = align.grid_swath(good, Grid.covering(REGION, TARGET_STEP), ["orbit"])
    return grid.withColumn("value", t.r6(F.col("value")))


FINE = Grid.covering(REGION, 0.05)


def triangle_sql(a, b, c, number):
    area = f"((y{b} - y{c}) * (x{a} - x{c}) + (x{c} - x{b}) * (y{a} - y{c}))"
    wa = f"((y{b} - y{c}) * (cx - x{c}) + (x{c} - x{b}) * (cy - y{c})) / {area}"
    wb = f"((y{c} - y{a}) * (cx - x{c}) + (x{a} - x{c}) * (cy - y{c})) / {area}"
    return f"""SELECT orbit, "row", col, (s * 1048576 + g) * 2 + {number} AS o, CASE WHEN ka + kb + kc > 1e-9 THEN (ka * coalesce(va, 0) + kb * coalesce(vb, 0) + kc * coalesce(vc, 0)) / (ka + kb + kc) END AS value FROM (
      SELECT *, CASE WHEN va IS NULL THEN 0 ELSE wa END AS ka, CASE WHEN vb IS NULL THEN 0 ELSE wb END AS kb, CASE WHEN vc IS NULL THEN 0 ELSE 1 - wa - wb END AS kc FROM (
        SELECT orbit, "row", col, s, g, {wa} AS wa, {wb} AS wb, v{a} AS va, v{b} AS vb, v{c} AS vc FROM cell) WHERE least(wa, wb, 1 - wa - wb) >= -1e-9)"""


def corner_sql():
    columns = ", ".join(f"{t}.lon AS x{k}, {t}.lat AS y{k}, {t}.value AS v{k}" for k, t in enumerate("abcd"))
    joins = " ".join(f"JOIN p {t} ON {t}.orbit = a.orbit AND {t}.scan = a.scan + {i} AND {t}.ground = a.ground + {j}" for t, i, j in (("b", 0, 1), ("c", 1, 0), ("d", 1, 1)))
    return f"SELECT a.orbit, a.scan AS s, a.ground AS g, {columns} FROM p a {joins}"


@query(
    "j11_interpolate_swath",
    f"""WITH p AS ({t.SMOOTH_SWATH_SQL}), q AS ({corner_sql()}),
    box AS (SELECT *, unnest(range(greatest(CAST(ceil(({FINE.y0!r}::DOUBLE - greatest(y0, y1, y2, y3)) / {FINE.dy!r}::DOUBLE - 0.5) AS INT), 0),
      least(CAST(floor(({FINE.y0!r}::DOUBLE - least(y0, y1, y2, y3)) / {FINE.dy!r}::DOUBLE - 0.5) AS INT), {FINE.rows - 1}) + 1)) AS "row" FROM q),
    cell AS (SELECT *, {FINE.x0!r}::DOUBLE + (col + 0.5) * {FINE.dx!r}::DOUBLE AS cx, {FINE.y0!r}::DOUBLE - ("row" + 0.5) * {FINE.dy!r}::DOUBLE AS cy FROM (
      SELECT *, unnest(range(greatest(CAST(ceil((least(x0, x1, x2, x3) - {FINE.x0!r}::DOUBLE) / {FINE.dx!r}::DOUBLE - 0.5) AS INT), 0),
      least(CAST(floor((greatest(x0, x1, x2, x3) - {FINE.x0!r}::DOUBLE) / {FINE.dx!r}::DOUBLE - 0.5) AS INT), {FINE.cols - 1}) + 1)) AS col FROM box)),
    h AS ({triangle_sql(0, 1, 2, 0)} UNION ALL {triangle_sql(3, 2, 1, 1)})
    SELECT orbit, CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, round(first(value ORDER BY o), 6) + 0 AS value FROM h GROUP BY ALL""",
)
def j11_interpolated(spark, d):
    grid = align.interpolate_swath(t.smooth_swath(spark, d), FINE, ["orbit"])
    return grid.withColumn("value", t.r6(F.col("value")))


def frequency_classes(spark, d):
    v = t.table(spark, d, "events").select("event_id", F.floor("value").cast("double").alias("value"))
    return align.lookup_frequency(v, metrics.value_counts(v, "value"), "value").withColumn("class", frequency_class(F.col("frequency")))
