"""F: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import fire, grid, physics, temporal
from workloads import tables as t
from workloads.align import frequency_classes
from workloads.registry import Registry

registry = Registry()
query = registry.add


@query(
    "f1_month_of",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS by_date,
    CAST(substr(split_part('IMERG_aggregated_' || strftime(o_orderdate, '%Y%m%d') || '_1000m.tif', '_', 3), 5, 2) AS INTEGER) AS by_name FROM orders""",
)
def f1(spark, d):
    name = F.concat(F.lit("/data/IMERG_aggregated_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_1000m.tif"))
    return t.table(spark, d, "orders").select(
        "o_orderkey", temporal.month_of(F.col("o_orderdate")).alias("by_date"), temporal.month_of_name(name).alias("by_name")
    )


PATH_SQL = {
    "Band 1": "strftime(o_orderdate, 'Wind_resampled_combined2/%Y%m%d_wind_res/band_1.tif')",
    "Band 2": "strftime(o_orderdate, 'Wind_resampled_combined2/%Y%m%d_wind_res/band_2.tif')",
    "Band 3": "strftime(o_orderdate, 'Wind_resampled_combined2/%Y%m%d_wind_res/band_3.tif')",
    "Band 4": "strftime(o_orderdate, 'Wind_resampled_combined2/%Y%m%d_wind_res/band_4.tif')",
    "Value WVC": "strftime(o_orderdate, 'resampled_water_vapor/%Y/%m/ColumnWV_%Y_%m_%d.tif')",
    "Value IMERG": "strftime(o_orderdate, 'resampled_imerg_1000m_aggregated/IMERG_aggregated_%Y%m%d_1000m.tif')",
    "Value CER": "strftime(o_orderdate, 'resampled_modis_combined/CER/cer_res_A%Y%j.tif')",
    "Value COT": "strftime(o_orderdate, 'resampled_modis_combined/COT/cot_res_A%Y%j.tif')",
    "Value CWP": "strftime(o_orderdate, 'resampled_modis_combined/CWP/cwp_res_A%Y%j.tif')",
}


@query("f2_layer_path", "SELECT o_orderkey, " + ", ".join(f"""'/data/' || {sql} AS "{n}" """ for n, sql in PATH_SQL.items()) + " FROM orders")
def f2(spark, d):
    paths = [temporal.layer_path(n, F.col("o_orderdate"), "/data").alias(n) for n in PATH_SQL]
    return t.table(spark, d, "orders").select("o_orderkey", *paths)


@query(
    "f3_date_range",
    """WITH r AS (SELECT CAST(unnest(generate_series((SELECT date_trunc('day', min(o_orderdate)) FROM orders),
      (SELECT date_trunc('day', max(o_orderdate)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT r.date, count(o_orderkey) AS n FROM r LEFT JOIN orders ON CAST(o_orderdate AS DATE) = r.date GROUP BY r.date""",
)
def f3(spark, d):
    orders = t.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"))
    first, last = orders.agg(F.min("date"), F.max("date")).first()
    counts = orders.groupBy("date").agg(F.count("*").alias("n"))
    return temporal.date_range(spark, first, last).join(counts, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "f4_day_of_year_seconds",
    """SELECT event_id, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
    round((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6::DOUBLE, 6) AS seconds,
    CAST(hour(ts) * 3600 + minute(ts) * 60 + 60 AS INTEGER) AS file_seconds FROM events""",
)
def f4(spark, d):
    ts = F.col("ts")
    stamp = F.date_format(ts, "HHmm").cast("int").cast("string")  # leading zeros lost, as in file names
    return t.table(spark, d, "events").select(
        "event_id", temporal.day_of_year(ts).alias("day_of_year"), t.r6(temporal.seconds_of_day(ts)).alias("seconds"),
        temporal.hhmm_seconds(stamp).alias("file_seconds"),
    )


@query(
    "f5_cyclic_sin",
    """SELECT event_id, round(sin(2 * pi() * dayofyear(ts) / 365), 6) + 0 AS day_sin,
    round(sin(2 * pi() * ((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6::DOUBLE) / 86400), 6) + 0 AS time_sin,
    round(sin(2 * pi() * value / 360), 6) + 0 AS angle_sin FROM events""",
)
def f5(spark, d):
    ts, sin = F.col("ts"), temporal.cyclic_sin
    return t.table(spark, d, "events").select(
        "event_id", t.r6(sin(temporal.day_of_year(ts), temporal.DAYS_PER_YEAR)).alias("day_sin"),
        t.r6(sin(temporal.seconds_of_day(ts), temporal.SECONDS_PER_DAY)).alias("time_sin"),
        t.r6(sin(F.col("value"), temporal.DEGREES_PER_TURN)).alias("angle_sin"),
    )


@query("f6_log_unlog", f"SELECT event_id, round(ln(1 + y), 6) AS logged, round(exp(ln(1 + y)) - 1, 6) AS back FROM ({t.STATIONS_SQL})")
def f6(spark, d):
    logged = physics.log_target(F.col("y"))
    return t.stations(spark, d).select("event_id", t.r6(logged).alias("logged"), t.r6(physics.unlog_target(logged)).alias("back"))


@query(
    "f7_cot_cer_ratio",
    f"""SELECT l_orderkey, l_linenumber, round(cot / (cer + 1e-6::DOUBLE), 4) AS train,
    round(CASE WHEN cer > 1e-6::DOUBLE THEN cot / cer ELSE 0 END, 4) AS guarded FROM ({t.FEATURES_SQL})""",
)
def f7(spark, d):
    ratio = physics.cot_cer_ratio
    return t.feature_rows(spark, d).select(
        "l_orderkey", "l_linenumber", t.r6(ratio(F.col("cot"), F.col("cer")), 4).alias("train"),
        t.r6(ratio(F.col("cot"), F.col("cer"), "guarded"), 4).alias("guarded"),
    )


@query("f8_cwp_squared", f"SELECT l_orderkey, l_linenumber, round(cwp * cwp, 4) AS cwp_squared FROM ({t.FEATURES_SQL})")
def f8(spark, d):
    return t.feature_rows(spark, d).select("l_orderkey", "l_linenumber", t.r6(physics.cwp_squared(F.col("cwp")), 4).alias("cwp_squared"))


@query(
    "f9_relative_humidity",
    f"""SELECT l_orderkey, l_linenumber, round((6.1078::DOUBLE * exp(17.1::DOUBLE * d2m / (235 + d2m))) /
    (6.1078::DOUBLE * exp(17.1::DOUBLE * t2m / (235 + t2m))), 6) AS humidity FROM ({t.WEATHER_SQL})""",
)
def f9(spark, d):
    ratio = physics.relative_humidity(F.col("d2m"), F.col("t2m"))
    return t.weather(spark, d).select("l_orderkey", "l_linenumber", t.r6(ratio).alias("humidity"))


@query(
    "f10_wind",
    f"""SELECT l_orderkey, l_linenumber, round(sqrt(u * u + v * v), 6) AS speed,
    round((180 + degrees(atan2(v, u))) % 360, 6) + 0 AS direction FROM ({t.WEATHER_SQL})""",
)
def f10(spark, d):
    u, v = F.col("u"), F.col("v")
    return t.weather(spark, d).select(
        "l_orderkey", "l_linenumber", t.r6(physics.wind_speed(u, v)).alias("speed"), t.r6(physics.wind_direction(u, v)).alias("direction")
    )


def haversine_sql(lon0, lat0, radius):
    a = f"""(pow(sin(radians(lat - {lat0}) / 2), 2) + cos(radians({lat0})) * cos(radians(lat)) * pow(sin(radians(lon - {lon0}) / 2), 2))"""
    return f"2 * {radius}::DOUBLE * atan2(sqrt({a}), sqrt(1 - {a}))"


@query("f11_haversine", f"SELECT event_id, round({haversine_sql('24.88::DOUBLE', '38.38::DOUBLE', 6371000.0)}, 4) AS meters FROM ({t.SWATH_SQL})")
def f11(spark, d):
    meters = physics.haversine_m(F.col("lon"), F.col("lat"), 24.88, 38.38)
    return t.swath(spark, d).select("event_id", t.r6(meters, 4).alias("meters"))


@query("f12_distance_to_center", f"SELECT event_id, round(sqrt({haversine_sql('10.0::DOUBLE', '51.0::DOUBLE', 6371.0088)}), 6) AS distance FROM ({t.SWATH_SQL})")
def f12(spark, d):
    return t.swath(spark, d).select("event_id", t.r6(physics.distance_to_center(F.col("lon"), F.col("lat"))).alias("distance"))


@query(
    "f13_pixel_coords",
    f"""SELECT tile, "row", col, round(20.15::DOUBLE + col * 0.008333333333333333218::DOUBLE, 9) AS lon,
    round(41.83333333333333::DOUBLE - "row" * 0.008333333333333333218::DOUBLE, 9) AS lat FROM ({t.TILES_SQL})""",
)
def f13(spark, d):
    lon, lat = grid.pixel_coords(grid.Grid.covering(grid.REGION, grid.TARGET_STEP), F.col("row"), F.col("col"))
    return t.tiles(spark, d).select("tile", "row", "col", t.r6(lon, 9).alias("lon"), t.r6(lat, 9).alias("lat"))


@query(
    "f14_fire_label",
    """SELECT event_id, CASE WHEN v > 7 AND v <> 32767 THEN 1 ELSE 0 END AS label, CASE WHEN v > 7 AND v <= 9 THEN 1 ELSE 0 END AS strict_label
    FROM (SELECT event_id, CASE WHEN event_id % 19 = 0 THEN 32767.0::DOUBLE WHEN event_id % 23 = 0 THEN 'nan'::DOUBLE WHEN event_id % 29 = 0 THEN -1
      ELSE floor(value) END AS v FROM events) WHERE NOT isnan(v)
    UNION ALL SELECT event_id, 0, 0 FROM events WHERE event_id % 23 = 0 AND event_id % 19 <> 0""",
)
def f14(spark, d):
    e = F.col("event_id")
    v = F.when(e % 19 == 0, F.lit(32767.0)).when(e % 23 == 0, F.lit(float("nan"))).when(e % 29 == 0, F.lit(-1.0)).otherwise(F.floor("value").cast("double"))
    return t.table(spark, d, "events").select("event_id", fire.fire_label(v).alias("label"), fire.fire_label(v, strict=True).alias("strict_label"))


def wide_pixels(spark, d):
    """Pixels with eleven bands and a visible one, all from the tile values."""
    bands = [(F.floor(F.col("value") * 1000) + F.col("row") * i).cast("double").alias(f"b{i}") for i in range(1, 12)]
    return t.tiles(spark, d).select("tile", "row", "col", *bands, (F.col("col") * 30).cast("double").alias("hrv"))


WIDE_SQL = 'SELECT tile, "row", col, ' + ", ".join(f'floor(value * 1000) + "row" * {i} AS b{i}' for i in range(1, 12)) + f", col * 30.0::DOUBLE AS hrv FROM ({t.TILES_SQL})"


@query(
    "f15_band_feature",
    'SELECT tile, "row", col, round(b1 / 1000, 6) + 0 AS "seviri_vis06_", round(b4 / 1000, 6) + 0 AS "seviri_ir39_", '
    f'round(b9 / 1000, 6) + 0 AS "seviri_ir108_", round(hrv / 255, 6) AS "seviri_hrv" FROM ({WIDE_SQL})',
)
def f15(spark, d):
    on = fire.enabled_features({"seviri_hrv": 1, "seviri_ir108_": 1, "seviri_wv62_": 0, "seviri_vis06_": 1, "seviri_ir39_": 1})
    return wide_pixels(spark, d).select("tile", "row", "col", *[t.r6(fire.band_feature(n)).alias(n) for n in on])


@query(
    "f16_band_ratio_difference",
    f"""SELECT tile, "row", col, round((b4 / 1000) / (CASE WHEN b3 = 0 THEN 0.001::DOUBLE ELSE b3 / 1000 END), 6) + 0 AS r43,
    round((b9 / 1000) / (CASE WHEN b4 = 0 THEN 0.001::DOUBLE ELSE b4 / 1000 END), 6) + 0 AS r94, round(b4 / 1000 - b9 / 1000, 6) + 0 AS d49 FROM ({WIDE_SQL})""",
)
def f16(spark, d):
    names = {"r43": "seviri_ir39/seviri_nir16", "r94": "seviri_ir108/seviri_ir39", "d49": "seviri_ir39-seviri_ir108"}
    return wide_pixels(spark, d).select("tile", "row", "col", *[t.r6(fire.band_feature(f)).alias(n) for n, f in names.items()])


STATIC = {
    "elevation": (-9999.0, "v / 2977"), "slope": (float("nan"), "v / 40"), "aspect": (-32768.0, "sin(2 * pi() * v / 360)"),
    "tpi": (-99999.0, "(v + 18) / 32"), "fuel": (float("nan"), "v / 10"), "cover": (-32768.0, "v"), "height": (3.4e38, "v / 33"),
}


@query(
    "f17_static_feature",
    "SELECT event_id, " + ", ".join(f"round({sql}, 8) + 0 AS {n}" for n, (_, sql) in STATIC.items())
    + " FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 0 ELSE value END AS v FROM events)",
)
def f17(spark, d):
    def layer(name, code):
        raw = F.when(F.col("event_id") % 13 == 0, F.lit(code)).otherwise(F.col("value"))
        return t.r6(fire.static_feature(name, raw), 8).alias(name)

    return t.table(spark, d, "events").select("event_id", *[layer(n, code) for n, (code, _) in STATIC.items()])


@query(
    "f18_frequency_class",
    """WITH v AS (SELECT event_id, floor(value) AS value FROM events), f AS (SELECT value, count(*) AS n FROM v GROUP BY value)
    SELECT event_id, n AS frequency, CASE WHEN n BETWEEN 2 AND 20 THEN 'few' WHEN n BETWEEN 21 AND 100 THEN 'medium' WHEN n > 100 THEN 'many' ELSE 'other' END AS "class"
    FROM v JOIN f USING (value)""",
)
def f18(spark, d):
    return frequency_classes(spark, d).select("event_id", "frequency", "class")


@query(
    "f19_join_split_path",
    """SELECT page_id, '/data/tiles/' || url AS joined, parse_filename(url) AS base, split_part(url, '/', 4) AS token,
    '/abs/' || page_id AS kept FROM pages""",
)
def f19(spark, d):
    url = F.col("url")
    absolute = F.concat(F.lit("/abs/"), F.col("page_id").cast("string"))
    return t.table(spark, d, "pages").select(
        "page_id", grid.join_path("/data/tiles", url).alias("joined"), grid.base_name(url).alias("base"),
        grid.name_token(url, "/", 3).alias("token"), grid.join_path("/data", absolute).alias("kept"),
    )
