"""Stand-ins for stations, tiles, products, swaths and predictions, derived from the given tables.

Each ``*_SQL`` string is the same derivation for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.grid import Grid
from gridloom.sources.pixels import pixel_scan

TILE_GRID = Grid(0.0, 8.0, 1.0, 1.0, 8, 8)
HALF_GRID = Grid(0.0, 8.0, 0.5, 0.5, 16, 16)
TILE_NODATA = -32767.0
LAYERS = ["L0", "L1", "L2", "L3", "L4"]
BOX = (20.15, 34.925, 29.608333333333334, 41.83333333333333)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column, digits: int = 6) -> Column:
    """Rounded, with minus zero made zero."""
    return F.round(c, digits) + F.lit(0.0)


STATIONS_SQL = """SELECT event_id, user_id, ts, event_type,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS y FROM events"""


def stations(spark: SparkSession, d: str) -> DataFrame:
    y = F.when(F.col("event_id") % 17 != 0, F.col("value"))
    return table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", y.alias("y"))


FEATURES_SQL = """SELECT l_quantity AS cot, l_tax AS cer, l_extendedprice / 1000 AS cwp, l_discount * 100 AS imerg,
  l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem"""


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("cot"), F.col("l_tax").alias("cer"), (F.col("l_extendedprice") / 1000).alias("cwp"),
        (F.col("l_discount") * 100).alias("imerg"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    )


DIRTY_SQL = """SELECT l_orderkey, l_partkey, l_linenumber,
  CASE l_partkey % 17 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 'infinity'::DOUBLE WHEN 2 THEN '-infinity'::DOUBLE
    ELSE l_quantity END AS cot,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_tax END AS cer, l_extendedprice AS cwp FROM lineitem"""


def dirty_rows(spark: SparkSession, d: str) -> DataFrame:
    left = F.col("l_partkey") % 17
    cot = (
        F.when(left == 0, F.lit(float("nan"))).when(left == 1, F.lit(float("inf")))
        .when(left == 2, F.lit(float("-inf"))).otherwise(F.col("l_quantity"))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", cot.alias("cot"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_tax")).alias("cer"), F.col("l_extendedprice").alias("cwp"),
    )


TILES_SQL = """SELECT vec_id AS tile, CAST(pos // 8 AS INTEGER) AS "row", CAST(pos % 8 AS INTEGER) AS col, value,
  (pos + vec_id) % 29 = 0 AS bad
  FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"""


def tiles(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("tile"), "embedding")
    bad = (F.col("row") * 8 + F.col("col") + F.col("tile")) % 29 == 0
    return pixel_scan(vectors, "embedding", 8, ["tile"]).withColumn("bad", bad)


ALL_LAYER_SQL = f"""SELECT tile // 5 AS date, 'L' || (tile % 5) AS layer, "row", col, value FROM ({TILES_SQL})"""
LAYER_SQL = f"{ALL_LAYER_SQL} WHERE tile % 23 <> 0"


def layer_pixels(spark: SparkSession, d: str, complete: bool = False) -> DataFrame:
    """Tiles as layers of dates; unless ``complete``, some tiles are missing, as files may be."""
    kept = tiles(spark, d) if complete else tiles(spark, d).filter(F.col("tile") % 23 != 0)
    layer = F.concat(F.lit("L"), (F.col("tile") % 5).cast("string"))
    return kept.select(F.expr("tile div 5").alias("date"), layer.alias("layer"), "row", "col", "value")


PRODUCTS_SQL = """SELECT o_orderkey AS id,
  concat_ws('_', 'S5P', o_orderstatus, 'L2', 'CO', 'a', 'b', 'c', 'd', 'e', 'f', 'g', substr(o_orderpriority, 1, 1),
    lpad(CAST(o_orderkey % 4 AS VARCHAR), 2, '0')) AS name,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "start",
  o_orderdate + to_hours(CAST(o_orderkey % 24 + 1 AS INTEGER)) AS "end",
  10.0::DOUBLE + o_custkey % 30 AS x0, 25.0::DOUBLE + o_custkey % 20 AS y0,
  12.0::DOUBLE + o_custkey % 30 AS x1, 28.0::DOUBLE + o_custkey % 20 AS y1 FROM orders"""


def products(spark: SparkSession, d: str) -> DataFrame:
    fixed = [F.lit(x) for x in ("L2", "CO", "a", "b", "c", "d", "e", "f", "g")]
    name = F.concat_ws(
        "_", F.lit("S5P"), F.col("o_orderstatus"), *fixed, F.substring("o_orderpriority", 1, 1),
        F.lpad((F.col("o_orderkey") % 4).cast("string"), 2, "0"),
    )
    east, north = F.col("o_custkey") % 30, F.col("o_custkey") % 20
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), name.alias("name"),
        F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int), 0, 0)").alias("start"),
        F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 + 1 as int), 0, 0)").alias("end"),
        (F.lit(10.0) + east).alias("x0"), (F.lit(25.0) + north).alias("y0"),
        (F.lit(12.0) + east).alias("x1"), (F.lit(28.0) + north).alias("y1"),
    )


SEGMENTS_SQL = """SELECT l_orderkey AS tile, l_quantity / 50 AS prob,
  CASE WHEN l_quantity + (l_partkey * 7 + l_suppkey * 13) % 21 - 10 > 30 THEN 1 ELSE 0 END AS label,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 WHEN 'R' THEN -1 END AS "Class_2" FROM lineitem"""


def segments(spark: SparkSession, d: str) -> DataFrame:
    shifted = F.col("l_quantity") + (F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 21 - 10
    flag = F.col("l_returnflag")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("tile"), (F.col("l_quantity") / 50).alias("prob"),
        F.when(shifted > 30, 1).otherwise(0).alias("label"),
        F.when(flag == "A", 1).when(flag == "N", 0).when(flag == "R", -1).alias("Class_2"),
    )


REGRESSION_SQL = """SELECT l_extendedprice AS y,
  l_extendedprice * (0.9::DOUBLE + 0.02::DOUBLE * ((l_partkey * 7 + l_suppkey * 13) % 11)) AS yhat,
  l_linenumber AS category FROM lineitem"""


def regression(spark: SparkSession, d: str) -> DataFrame:
    off = F.lit(0.9) + F.lit(0.02) * ((F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 11)
    return table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_extendedprice") * off).alias("yhat"), F.col("l_linenumber").alias("category")
    )


SWATH_SQL = """SELECT user_id % 10 AS orbit, event_id // 40 AS scan, event_id % 40 AS ground,
  20.15::DOUBLE + (event_id % 97) / 10.0::DOUBLE AS lon, 34.925::DOUBLE + (event_id % 71) / 10.0::DOUBLE AS lat,
  value, (event_id % 100) / 100.0::DOUBLE AS qa, ts, event_id FROM events"""


def swath(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, d, "events").select(
        (F.col("user_id") % 10).alias("orbit"), F.expr("event_id div 40").alias("scan"), (e % 40).alias("ground"),
        (F.lit(20.15) + (e % 97) / F.lit(10.0)).alias("lon"), (F.lit(34.925) + (e % 71) / F.lit(10.0)).alias("lat"),
        "value", ((e % 100) / F.lit(100.0)).alias("qa"), "ts", "event_id",
    )


SMOOTH_SWATH_SQL = """SELECT event_id // 2000 AS orbit, event_id % 2000 // 40 AS scan, event_id % 40 AS ground,
  20.0::DOUBLE + (event_id % 40) * 0.23::DOUBLE + (event_id % 2000 // 40) * 0.013::DOUBLE AS lon,
  42.0::DOUBLE - (event_id % 2000 // 40) * 0.14::DOUBLE + (event_id % 40) * (event_id % 40) * 0.0005::DOUBLE AS lat,
  CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events"""


def smooth_swath(spark: SparkSession, d: str) -> DataFrame:
    """Scans that lie side by side, a little bent, with missing values."""
    ground, scan = F.col("event_id") % 40, F.expr("event_id % 2000 div 40")
    return table(spark, d, "events").select(
        F.expr("event_id div 2000").alias("orbit"), scan.alias("scan"), ground.alias("ground"),
        (F.lit(20.0) + ground * F.lit(0.23) + scan * F.lit(0.013)).alias("lon"), (F.lit(42.0) - scan * F.lit(0.14) + ground * ground * F.lit(0.0005)).alias("lat"),
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"),
    )


WEATHER_SQL = """SELECT l_orderkey, l_linenumber, l_quantity - 25 AS u, CAST(l_partkey % 51 - 25 AS DOUBLE) AS v,
  CAST(l_linenumber AS DOUBLE) AS d2m, l_linenumber + l_discount * 100 AS t2m FROM lineitem"""


def weather(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") - 25).alias("u"), (F.col("l_partkey") % 51 - 25).cast("double").alias("v"),
        F.col("l_linenumber").cast("double").alias("d2m"), (F.col("l_linenumber") + F.col("l_discount") * 100).alias("t2m"),
    )


MASK_SQL = """SELECT l_orderkey, l_linenumber, l_quantity - 10 AS pred,
  CASE l_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN -1.0::DOUBLE WHEN 2 THEN 9.96921e36::DOUBLE ELSE l_quantity END AS co,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_tax END AS tp, (l_linenumber - 4) / 2.0::DOUBLE AS ndvi FROM lineitem"""


def masked_cells(spark: SparkSession, d: str) -> DataFrame:
    left = F.col("l_partkey") % 11
    co = F.when(left == 1, F.lit(-1.0)).when(left == 2, F.lit(9.96921e36)).when(left != 0, F.col("l_quantity"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") - 10).alias("pred"), co.alias("co"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_tax")).alias("tp"), ((F.col("l_linenumber") - 4) / F.lit(2.0)).alias("ndvi"),
    )
