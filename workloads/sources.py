"""S and P: sources, sinks, projections, filters, missing values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import cleaning as clean_fn
from gridloom.functions.grid import Grid
from gridloom.operators import metrics, rows
from gridloom.session import fresh_path
from gridloom.sources import catalogue, pixels, tables as stores
from workloads import tables as t
from workloads.registry import Registry

registry = Registry()
query = registry.add

RECORD = "Α/Α ΕΓΓΡΑΦΗΣ"


@query("s1_read_station_csv", f"SELECT event_id AS record_id, event_type, y AS imerg FROM ({t.STATIONS_SQL})")
def s1(spark, d):
    schema = T.StructType(
        [T.StructField(RECORD, T.LongType()), T.StructField("event type", T.StringType()), T.StructField("Value IMERG", T.DoubleType())]
    )
    path = fresh_path(spark, "stations.csv")
    t.stations(spark, d).select(
        F.col("y").alias("Value IMERG"), F.col("user_id").alias("unused"), F.col("event_id").alias(RECORD), F.col("event_type").alias("event type")
    ).write.option("header", True).csv(path)
    read = stores.read_station_csv(spark, path, schema)
    return rows.rename(read, {RECORD: "record_id", "event type": "event_type", "Value IMERG": "imerg"})


@query("s2_write_read_stage", f"SELECT event_id, user_id, ts, y FROM ({t.STATIONS_SQL})")
def s2(spark, d):
    root = fresh_path(spark, "stages")
    stores.write_stage(t.stations(spark, d).select("event_id", "user_id", "ts", "y"), root, "run1", "stations")
    return stores.read_stage(spark, root, "run1", "stations")


@query(
    "s3_read_stages",
    f"""SELECT event_id, y, NULL::BIGINT AS user_id, 'a' AS run_id FROM ({t.STATIONS_SQL})
    UNION ALL SELECT event_id, y, user_id, 'b' FROM ({t.STATIONS_SQL})""",
)
def s3(spark, d):
    root = fresh_path(spark, "stages")
    stores.write_stage(t.stations(spark, d).select("event_id", "y"), root, "a", "part")
    stores.write_stage(t.stations(spark, d).select("event_id", "y", "user_id"), root, "b", "part")
    return stores.read_stages(spark, root, ["a", "b"], "part")


@query("s4_write_read_dict", f"SELECT y AS key, count(*) AS value FROM ({t.STATIONS_SQL}) WHERE y IS NOT NULL GROUP BY y")
def s4(spark, d):
    path = fresh_path(spark, "value_counts.json")
    counts = metrics.value_counts(t.stations(spark, d), "y")
    stores.write_dict(counts, path, "y", "count")
    return stores.read_dict(spark, path)


@query("s5_pixel_scan", f'SELECT tile, "row", col, value FROM ({t.TILES_SQL})')
def s5(spark, d):
    return t.tiles(spark, d).drop("bad")


@query(
    "s6_grid_sink",
    f"""SELECT DATE '2020-01-01' + CAST(tile // 5 AS INTEGER) AS date, CAST((tile % 5) * 8 + "row" AS INTEGER) AS "row", col,
      20.15::DOUBLE + col * 0.008333333333333333218::DOUBLE AS lon,
      41.83333333333333::DOUBLE + ((tile % 5) * 8 + "row") * -0.008333333333333333218::DOUBLE AS lat,
      CAST(CASE WHEN bad THEN 9.96921e36::DOUBLE ELSE value END AS FLOAT) AS value FROM ({t.TILES_SQL})""",
)
def s6(spark, d):
    path = fresh_path(spark, "grid")
    grid = Grid(20.15, 41.83333333333333, 0.008333333333333333218, 0.008333333333333333218, 40, 8)
    cells = t.tiles(spark, d).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.expr("cast(tile div 5 as int)")).alias("date"),
        ((F.col("tile") % 5) * 8 + F.col("row")).cast("int").alias("row"), "col", F.when(~F.col("bad"), F.col("value")).alias("value"),
    )
    pixels.grid_sink(cells, grid, F.col("value"), path)
    return pixels.read_grid(spark, path)


@query(
    "s7_catalogue_search",
    f"""SELECT id, name, "start", "end" FROM ({t.PRODUCTS_SQL}) WHERE contains(name, '_F_L2')
      AND "start" > date_trunc('day', "start") + INTERVAL '5 hours'
      AND "end" < date_trunc('day', "start") + INTERVAL '16 hours 59 minutes 59 seconds'
      AND "start" >= TIMESTAMP '1995-01-01' AND "start" < TIMESTAMP '2001-08-02'
      AND x0 <= {t.BOX[2]} AND x1 >= {t.BOX[0]} AND y0 <= {t.BOX[3]} AND y1 >= {t.BOX[1]}""",
)
def s7(spark, d):
    found = catalogue.catalogue_search(t.products(spark, d), "_F_L2", dt.date(1995, 1, 1), dt.date(2001, 8, 1), t.BOX)
    return found.select("id", "name", "start", "end")


@query("s8_product_filter", f"SELECT id, name FROM ({t.PRODUCTS_SQL}) WHERE split_part(name, '_', 13) = '03' AND starts_with(name, 'S5P_')")
def s8(spark, d):
    return catalogue.product_filter(t.products(spark, d)).select("id", "name")


@query("p1_rename", f'SELECT event_id, y AS "Band 2", user_id AS "Band 3" FROM ({t.STATIONS_SQL})')
def p1(spark, d):
    raw = t.stations(spark, d).select("event_id", F.col("y").alias("Band 2_y"), F.col("user_id").alias("Band 3_y"))
    return rows.rename(raw, {"Band 2_y": "Band 2", "Band 3_y": "Band 3", "Band 4_y": "Band 4"})


@query("p2_select_features", "SELECT l_tax, l_quantity, l_discount, l_extendedprice FROM lineitem")
def p2(spark, d):
    return rows.select_features(t.table(spark, d, "lineitem"), ["l_tax", "l_quantity", "l_discount", "l_extendedprice"])


@query("p3_split_xy", "SELECT event_id, user_id, event_type FROM events")
def p3(spark, d):
    x, _ = rows.split_xy(rows.drop_columns(t.table(spark, d, "events"), ["ts", "props"]), "value")
    return x


METRICS_SQL = f"""SELECT category AS alpha, avg(abs(yhat - y)) AS "testMAE", sqrt(avg((yhat - y) * (yhat - y))) AS "testRMSE",
  max(abs(yhat - y)) AS "otherMAE", sum((yhat - y) * (yhat - y)) AS "fewSERA" FROM ({t.REGRESSION_SQL}) GROUP BY category"""


def metric_table(spark, d):
    e = F.col("yhat") - F.col("y")
    return t.regression(spark, d).groupBy(F.col("category").alias("alpha")).agg(
        F.avg(F.abs(e)).alias("testMAE"), F.sqrt(F.avg(e * e)).alias("testRMSE"), F.max(F.abs(e)).alias("otherMAE"), F.sum(e * e).alias("fewSERA")
    )


@query("p4_select_by_name", f'SELECT round("testMAE", 6) AS "testMAE", round("testRMSE", 6) AS "testRMSE" FROM ({METRICS_SQL})')
def p4(spark, d):
    kept = rows.select_by_name(rows.drop_by_prefix(metric_table(spark, d), "other"), ["MAE", "RMSE"])
    return kept.select(t.r6(F.col("testMAE")).alias("testMAE"), t.r6(F.col("testRMSE")).alias("testRMSE"))


@query("p5_select_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def p5(spark, d):
    return rows.select_numeric(t.table(spark, d, "part"))


@query(
    "p6_missing_profile",
    f"""SELECT 'cot' AS "column", count(*) FILTER (cot IS NULL OR isnan(cot)) AS missing FROM ({t.DIRTY_SQL})
    UNION ALL SELECT 'cer', count(*) FILTER (cer IS NULL OR isnan(cer)) FROM ({t.DIRTY_SQL})
    UNION ALL SELECT 'l_linenumber', count(*) FILTER (l_linenumber IS NULL) FROM ({t.DIRTY_SQL})""",
)
def p6(spark, d):
    return rows.missing_profile(t.dirty_rows(spark, d), ["cot", "cer", "l_linenumber"])


@query("p7_drop_missing", f"SELECT l_orderkey, l_partkey, cer FROM ({t.DIRTY_SQL}) WHERE cot IS NOT NULL AND NOT isnan(cot) AND cer IS NOT NULL")
def p7(spark, d):
    return rows.drop_missing(t.dirty_rows(spark, d), ["cot", "cer"]).select("l_orderkey", "l_partkey", "cer")


@query(
    "p8_fill_missing",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN isnan(cot) THEN -1 ELSE cot END AS cot, coalesce(cer, -1) AS cer, cwp
    FROM ({t.DIRTY_SQL}) WHERE cot IS NOT NULL""",
)
def p8(spark, d):
    return rows.fill_missing(t.dirty_rows(spark, d), ["cot", "cer"]).select("l_orderkey", "l_linenumber", "cot", "cer", "cwp")


@query(
    "p9_inf_to_missing",
    f"SELECT l_orderkey, l_linenumber, CASE WHEN isinf(cot) OR isnan(cot) THEN NULL ELSE cot END AS cot FROM ({t.DIRTY_SQL})",
)
def p9(spark, d):
    return t.dirty_rows(spark, d).select("l_orderkey", "l_linenumber", clean_fn.inf_to_missing(F.col("cot")).alias("cot"))


@query(
    "p10_filter_class",
    f"""SELECT 1 AS wanted, tile, label, "Class_2" FROM ({t.SEGMENTS_SQL}) WHERE "Class_2" = 1
    UNION ALL SELECT 2, tile, label, "Class_2" FROM ({t.SEGMENTS_SQL})""",
)
def p10(spark, d):
    data = t.segments(spark, d).select("tile", "label", "Class_2")
    parts = [rows.filter_class(data, c).select(F.lit(c).alias("wanted"), "*") for c in (1, 2)]
    return rows.stack_rows(*parts)


@query("p11_quality_mask", f"SELECT event_id, CASE WHEN qa > 0.5 THEN value END AS value FROM ({t.SWATH_SQL})")
def p11(spark, d):
    return t.swath(spark, d).select("event_id", clean_fn.quality_mask(F.col("value"), F.col("qa")).alias("value"))


@query("p12_with_constant", f'SELECT event_id, 6 AS "month", 37200.5::DOUBLE AS "Total Seconds" FROM ({t.STATIONS_SQL})')
def p12(spark, d):
    return rows.with_constant(t.stations(spark, d).select("event_id"), {"month": 6, "Total Seconds": 37200.5})


@query(
    "p13_nodata_mask",
    f"""WITH a AS (SELECT *, 9.96921e36::DOUBLE AS nd FROM ({t.MASK_SQL})),
    s1 AS (SELECT * REPLACE (CASE WHEN co IS NULL THEN nd ELSE pred END AS pred) FROM a),
    s2 AS (SELECT * REPLACE (CASE WHEN co < 0 THEN nd ELSE pred END AS pred) FROM s1),
    s3 AS (SELECT * REPLACE (CASE WHEN co = nd THEN nd ELSE pred END AS pred) FROM s2),
    s4 AS (SELECT * REPLACE (CASE WHEN tp IS NULL THEN nd ELSE pred END AS pred) FROM s3),
    s5 AS (SELECT * REPLACE (CASE WHEN pred < 0 THEN 0 ELSE pred END AS pred) FROM s4),
    s6 AS (SELECT * REPLACE (CASE WHEN ndvi > 1 THEN nd ELSE pred END AS pred) FROM s5),
    s7 AS (SELECT * REPLACE (CASE WHEN ndvi < -1 THEN nd ELSE pred END AS pred) FROM s6)
    SELECT l_orderkey, l_linenumber, pred AS value FROM s7""",
)
def p13(spark, d):
    value = clean_fn.nodata_mask(F.col("pred"), F.col("co"), F.col("tp"), F.col("ndvi"))
    return t.masked_cells(spark, d).select("l_orderkey", "l_linenumber", value.alias("value"))


@query("p14_clamp_non_negative", f"SELECT event_id, CASE WHEN y - 50 < 0 THEN 0 ELSE y - 50 END AS value FROM ({t.STATIONS_SQL})")
def p14(spark, d):
    return t.stations(spark, d).select("event_id", clean_fn.clamp_non_negative(F.col("y") - 50).alias("value"))


@query(
    "p15_rescale",
    f"""SELECT l_orderkey, l_linenumber, round(imerg / 10, 6) AS imerg, round(cwp / 255, 6) AS hrv,
    round((cot - 3) / 10000, 6) AS ndvi FROM ({t.FEATURES_SQL})""",
)
def p15(spark, d):
    return t.feature_rows(spark, d).select(
        "l_orderkey", "l_linenumber", t.r6(clean_fn.rescale(F.col("imerg"), 10)).alias("imerg"),
        t.r6(clean_fn.rescale(F.col("cwp"), 255)).alias("hrv"), t.r6(clean_fn.rescale(F.col("cot"), 10000, 3)).alias("ndvi"),
    )


@query(
    "p16_era_switch",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'OFFL' ELSE 'RPRO' END AS line,
    o_orderdate < DATE '1996-06-01' AS packaged FROM orders""",
)
def p16(spark, d):
    return t.table(spark, d, "orders").select(
        "o_orderkey", clean_fn.product_line(F.col("o_orderdate"), dt.date(1998, 1, 1)).alias("line"),
        clean_fn.is_packaged(F.col("o_orderdate"), dt.date(1996, 6, 1)).alias("packaged"),
    )


@query(
    "p17_class_name",
    f"""SELECT tile, "Class_2", CASE "Class_2" WHEN 1 THEN 'small' WHEN 0 THEN 'medium' WHEN -1 THEN 'large' END AS name FROM ({t.SEGMENTS_SQL})""",
)
def p17(spark, d):
    return t.segments(spark, d).select("tile", "Class_2", clean_fn.class_name(F.col("Class_2")).alias("name"))


@query("p18_select_date", "SELECT event_id, ts, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def p18(spark, d):
    return rows.select_date(t.table(spark, d, "events").select("event_id", "ts", "value"), "ts", dt.date(2024, 1, 15))
