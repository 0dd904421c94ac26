"""A and U: counts, metric tables, regression and segmentation evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import metrics, rows
from gridloom.operators.select import arg_best
from workloads import tables as t
from workloads.registry import Registry
from workloads.sources import METRICS_SQL, metric_table

registry = Registry()
query = registry.add


@query("a1_value_counts", f"SELECT y, count(*) AS count FROM ({t.STATIONS_SQL}) WHERE y IS NOT NULL AND event_id % 19 <> 0 GROUP BY y")
def a1(spark, d):
    with_nan = F.when(F.col("event_id") % 19 == 0, F.lit(float("nan"))).otherwise(F.col("y"))
    return metrics.value_counts(t.stations(spark, d).withColumn("y", with_nan), "y")


@query("a2_category_distribution", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def a2(spark, d):
    return metrics.category_distribution(t.table(spark, d, "events"), "event_type")


@query(
    "a3_min_max_scale",
    f"""WITH f AS (SELECT *, 7.0::DOUBLE AS same FROM ({t.FEATURES_SQL})),
    m AS (SELECT min(cot) AS a, max(cot) AS b, min(cwp) AS c, max(cwp) AS e FROM f)
    SELECT l_orderkey, l_linenumber, round((cot - a) / (b - a), 6) AS cot, round((cwp - c) / (e - c), 6) AS cwp, NULL::DOUBLE AS same FROM f, m""",
)
def a3(spark, d):
    data = t.feature_rows(spark, d).withColumn("same", F.lit(7.0))
    scaled = metrics.min_max_scale(data, ["cot", "cwp", "same"])
    return scaled.select("l_orderkey", "l_linenumber", t.r6(F.col("cot")).alias("cot"), t.r6(F.col("cwp")).alias("cwp"), "same")


SCORE_SQL = f"""WITH m AS ({METRICS_SQL}), r AS (SELECT min("testMAE") AS a, max("testMAE") AS b, min("testRMSE") AS c, max("testRMSE") AS e,
  min("fewSERA") AS g, max("fewSERA") AS h FROM m)
  SELECT alpha, -(("testMAE" - a) / (b - a) + ("testRMSE" - c) / (e - c) + ("fewSERA" - g) / (h - g)) AS composite_score FROM m, r"""


def scored(spark, d):
    kept = rows.drop_by_prefix(metric_table(spark, d), "other")
    scaled = metrics.min_max_scale(kept, ["testMAE", "testRMSE", "fewSERA"])
    return metrics.composite_score(scaled).select("alpha", "composite_score")


@query("a4_composite_score", f"SELECT alpha, round(composite_score, 6) + 0 AS composite_score FROM ({SCORE_SQL})")
def a4(spark, d):
    return scored(spark, d).withColumn("composite_score", t.r6(F.col("composite_score")))


@query(
    "a5_arg_best",
    f"""SELECT 'least' AS kind, event_type, arg_min(event_id, row(y, event_id)) AS event_id, min(y) AS y FROM ({t.STATIONS_SQL}) WHERE y IS NOT NULL GROUP BY event_type
    UNION ALL SELECT 'greatest', event_type, arg_min(event_id, row(-y, event_id)), max(y) FROM ({t.STATIONS_SQL}) WHERE y IS NOT NULL GROUP BY event_type""",
)
def a5(spark, d):
    data = t.stations(spark, d).select("event_id", "event_type", "y")
    least = arg_best(data, "y", "event_id", "min", ["event_type"]).select(F.lit("least").alias("kind"), "*")
    greatest = arg_best(data, "y", "event_id", "max", ["event_type"]).select(F.lit("greatest").alias("kind"), "*")
    return rows.stack_rows(least, greatest)


@query("a6_mean_fold_metric", f"SELECT event_type, round(avg(y), 6) AS mean_metric FROM ({t.STATIONS_SQL}) GROUP BY event_type")
def a6(spark, d):
    table = metrics.mean_fold_metric(t.stations(spark, d), "y", ["event_type"])
    return table.withColumn("mean_metric", t.r6(F.col("mean_metric")))


def error_sql(source, group=""):
    key = f"{group}, " if group else ""
    return f"""SELECT {key}count(*) AS n, round(avg(abs(yhat - y)), 6) AS mae, round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
      round(1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*)), 6) AS r2, round(corr(y, yhat), 6) AS pearson_r
      FROM ({source}) {f'GROUP BY {group} HAVING count(*) >= 2' if group else ''}"""


def rounded(table, names):
    return table.withColumns({n: t.r6(F.col(n)) for n in names})


ERRORS = ["mae", "rmse", "r2", "pearson_r"]


@query("a7_regression_metrics", error_sql(t.REGRESSION_SQL))
def a7(spark, d):
    return rounded(metrics.regression_metrics(t.regression(spark, d), "y", "yhat"), ERRORS)


LOG_SQL = f"SELECT exp(ln(1 + y / 1000)) - 1 AS y, exp(ln(1 + yhat / 1000)) - 1 AS yhat, category FROM ({t.REGRESSION_SQL})"


@query("a8_regression_metrics_by_class", error_sql(LOG_SQL, "category"))
def a8(spark, d):
    data = t.regression(spark, d)
    logs = data.select(F.log1p(F.col("y") / 1000).alias("y"), F.log1p(F.col("yhat") / 1000).alias("yhat"), "category")
    return rounded(metrics.regression_metrics_by_class(logs, "y", "yhat", "category", log_scale=True), ERRORS)


def phi_sql(source, group, columns):
    """Rows of ``source`` with phi, control points per group."""
    on = f"USING ({group})"
    return f"""WITH src AS ({source}),
    q AS (SELECT {group}, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS x1, quantile_cont(y, 0.75) AS q3 FROM src WHERE y IS NOT NULL GROUP BY {group}),
    w AS (SELECT {group}, any_value(x1) AS x1, min(y) AS lowest, max(y) AS highest, min(y) FILTER (y >= q1 - 1.5::DOUBLE * (q3 - q1)) AS lo,
      max(y) FILTER (y <= q3 + 1.5::DOUBLE * (q3 - q1)) AS hi FROM src JOIN q {on} WHERE y IS NOT NULL GROUP BY {group}),
    cp AS (SELECT {group}, CASE WHEN lowest < lo THEN lo ELSE lowest END AS x0, CASE WHEN lowest < lo THEN 1.0::DOUBLE ELSE 0 END AS f0, x1,
      CASE WHEN highest > hi THEN hi ELSE highest END AS x2, CASE WHEN highest > hi THEN 1.0::DOUBLE ELSE 0 END AS f2 FROM w),
    tt AS (SELECT *, (y - x1) / nullif(x2 - x1, 0) AS tr, (y - x0) / nullif(x1 - x0, 0) AS tl FROM src JOIN cp {on}),
    phi AS (SELECT {columns}, CASE WHEN y >= x2 THEN f2 WHEN y >= x1 THEN f2 * (3 * tr * tr - 2 * tr * tr * tr)
      WHEN y > x0 THEN f0 - f0 * (3 * tl * tl - 2 * tl * tl * tl) WHEN y IS NOT NULL THEN f0 END AS phi FROM tt)"""


@query(
    "a9_sera",
    phi_sql(
        f"SELECT category AS g, y, yhat FROM ({t.REGRESSION_SQL}) UNION ALL SELECT -1, y, yhat FROM ({t.REGRESSION_SQL})", "g", "g, y, yhat"
    ) + " SELECT g AS category, round(sum(phi * (yhat - y) * (yhat - y)) / 1e6, 4) AS sera FROM phi GROUP BY g",
)
def a9(spark, d):
    data = t.regression(spark, d)
    whole = metrics.sera(data, "y", "yhat").select(F.lit(-1).alias("category"), "sera")
    parts = rows.stack_rows(whole, metrics.sera(data, "y", "yhat", ["category"]))
    return parts.withColumn("sera", t.r6(F.col("sera") / 1e6, 4))


@query(
    "a9_sera_curve",
    phi_sql(f"SELECT 1 AS g, y, yhat FROM ({t.REGRESSION_SQL})", "g", "g, y, yhat")
    + """, k AS (SELECT i, i * 0.01::DOUBLE AS t FROM range(101) r(i)),
    e AS (SELECT phi, sum((yhat - y) * (yhat - y)) AS s FROM phi GROUP BY phi)
    SELECT round(k.t, 6) AS t, round(coalesce(sum(e.s) FILTER (e.phi >= k.t), 0) / 1e6, 4) AS ser FROM k, e GROUP BY k.t""",
)
def a9_curve(spark, d):
    curve = metrics.sera_curve(t.regression(spark, d), "y", "yhat")
    return curve.select(t.r6(F.col("t")).alias("t"), t.r6(F.col("ser") / 1e6, 4).alias("ser"))


def counts_sql(source, threshold, group=""):
    key = f"{group}, " if group else ""
    return f"""SELECT {key}count(*) FILTER (label = 0 AND prob < {threshold}) AS "TN", count(*) FILTER (label = 0 AND prob >= {threshold}) AS "FP",
      count(*) FILTER (label = 1 AND prob < {threshold}) AS "FN", count(*) FILTER (label = 1 AND prob >= {threshold}) AS "TP"
      FROM ({source}) {f'GROUP BY {group}' if group else ''}"""


RATES_SQL = """round(coalesce("TP" / nullif("TP" + "FN", 0), 0), 6) AS recall, round(coalesce("TP" / nullif("TP" + "FP", 0), 0), 6) AS precision,
  round(coalesce(2 * "TP" / nullif(2 * "TP" + "FP" + "FN", 0), 0), 6) AS f1_score, round("TP" / nullif("TP" + "FN" + "FP", 0), 6) AS "IOU",
  "TN", "FP", "FN", "TP" """
RATES = ["recall", "precision", "f1_score", "IOU"]


@query("a10_confusion", counts_sql(t.SEGMENTS_SQL, "0.5::DOUBLE", '"Class_2"'))
def a10(spark, d):
    return metrics.confusion(t.segments(spark, d), "label", "prob", 0.5, ["Class_2"])


@query("a11_segmentation_metrics", f'SELECT "Class_2", {RATES_SQL} FROM ({counts_sql(t.SEGMENTS_SQL, "0.5::DOUBLE", chr(34) + "Class_2" + chr(34))})')
def a11(spark, d):
    counts = metrics.confusion(t.segments(spark, d), "label", "prob", 0.5, ["Class_2"])
    return rounded(metrics.segmentation_metrics(counts), RATES)


SWEEP_SQL = f"""SELECT k.t AS threshold, count(*) FILTER (label = 0 AND prob < k.t) AS "TN", count(*) FILTER (label = 0 AND prob >= k.t) AS "FP",
  count(*) FILTER (label = 1 AND prob < k.t) AS "FN", count(*) FILTER (label = 1 AND prob >= k.t) AS "TP"
  FROM ({t.SEGMENTS_SQL}), (SELECT i * 0.01::DOUBLE AS t FROM range(100) r(i)) k GROUP BY k.t"""
BEST_SQL = f"""SELECT * FROM ({SWEEP_SQL}) QUALIFY row_number() OVER (ORDER BY coalesce(2 * "TP" / nullif(2 * "TP" + "FP" + "FN", 0), 0) DESC, threshold) = 1"""


@query("a12_threshold_sweep", f"SELECT threshold, {RATES_SQL} FROM ({SWEEP_SQL})")
def a12_sweep(spark, d):
    return rounded(metrics.threshold_sweep(t.segments(spark, d), "label", "prob"), RATES).drop("i")


@query("a12_best_threshold", f"SELECT threshold, {RATES_SQL} FROM ({BEST_SQL})")
def a12(spark, d):
    return rounded(metrics.best_threshold(t.segments(spark, d), "label", "prob"), RATES)


REPORT_SQL = f"""WITH s AS (SELECT *, CASE "Class_2" WHEN 1 THEN 'small' WHEN 0 THEN 'medium' ELSE 'large' END AS "Class" FROM ({t.SEGMENTS_SQL})),
  two AS (SELECT tile, label, prob, "Class" FROM s UNION ALL SELECT tile, label, prob, 'All' FROM s),
  b AS (SELECT threshold FROM ({BEST_SQL})),
  c AS (SELECT "Class", any_value(threshold) AS threshold, count(DISTINCT tile) AS "Num_Tiles",
    count(*) FILTER (label = 0 AND prob < threshold) AS "TN", count(*) FILTER (label = 0 AND prob >= threshold) AS "FP",
    count(*) FILTER (label = 1 AND prob < threshold) AS "FN", count(*) FILTER (label = 1 AND prob >= threshold) AS "TP" FROM two, b GROUP BY "Class")
  SELECT "Class", threshold, "Num_Tiles", {RATES_SQL} FROM c"""


@query("a13_metrics_by_class_report", REPORT_SQL)
def a13(spark, d):
    return rounded(metrics.metrics_by_class_report(t.segments(spark, d), "label", "prob", "Class_2", "tile"), RATES)


Q_SQL = "least(greatest(prob, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE)"
BCE_SQL = f"avg(-(label * ln({Q_SQL}) + (1 - label) * ln(1 - {Q_SQL})))"
DICE_SQL = "(2 * sum(label * prob) + 1) / (sum(label) + sum(prob) + 1)"


@query("a14_mean_bce", f'SELECT "Class_2", round({BCE_SQL}, 6) AS bce FROM ({t.SEGMENTS_SQL}) GROUP BY "Class_2"')
def a14(spark, d):
    return rounded(metrics.mean_bce(t.segments(spark, d), "label", "prob", ["Class_2"]), ["bce"])


@query("a15_dice", f'SELECT "Class_2", round({DICE_SQL}, 6) AS dice, round(1 - {DICE_SQL}, 6) AS dice_loss FROM ({t.SEGMENTS_SQL}) GROUP BY "Class_2"')
def a15(spark, d):
    return rounded(metrics.dice(t.segments(spark, d), "label", "prob", ["Class_2"]), ["dice", "dice_loss"])


@query(
    "a16_soft_prf",
    f"""SELECT "Class_2", round(r, 6) AS recall, round(p, 6) AS precision, round(2 * (p * r / (p + r + 1e-7::DOUBLE)), 6) AS f1 FROM
    (SELECT "Class_2", sum(round_even(label * prob, 0)) / (sum(label) + 1e-7::DOUBLE) AS r,
      sum(round_even(label * prob, 0)) / (sum(round_even(least(greatest(prob, 0), 1), 0)) + 1e-7::DOUBLE) AS p
     FROM ({t.SEGMENTS_SQL}) GROUP BY "Class_2")""",
)
def a16(spark, d):
    return rounded(metrics.soft_prf(t.segments(spark, d), "label", "prob", ["Class_2"]), ["recall", "precision", "f1"])


@query("a17_combined_loss", f"SELECT round((1 - 0.816::DOUBLE) * (1 - {DICE_SQL}) + 0.816::DOUBLE * {BCE_SQL}, 6) AS loss FROM ({t.SEGMENTS_SQL})")
def a17(spark, d):
    return rounded(metrics.combined_loss(t.segments(spark, d), "label", "prob", 0.816), ["loss"])


@query(
    "u1_stack_rows",
    f"""SELECT 'All' AS "Class", * FROM ({counts_sql(t.SEGMENTS_SQL, '0.5::DOUBLE')}) UNION ALL
    SELECT CASE "Class_2" WHEN 1 THEN 'small' WHEN 0 THEN 'medium' ELSE 'large' END, "TN", "FP", "FN", "TP"
    FROM ({counts_sql(t.SEGMENTS_SQL, '0.5::DOUBLE', chr(34) + 'Class_2' + chr(34))})""",
)
def u1(spark, d):
    data = t.segments(spark, d)
    reports = [metrics.confusion(data, "label", "prob", 0.5).select(F.lit("All").alias("Class"), "*")]
    for number, name in ((1, "small"), (0, "medium"), (-1, "large")):
        one = rows.filter_class(data, number)
        reports.append(metrics.confusion(one, "label", "prob", 0.5).select("TP", "FN", "FP", "TN", F.lit(name).alias("Class")))
    return rows.stack_rows(*reports)
