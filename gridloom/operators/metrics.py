"""Counts, scaling of metrics, regression and segmentation evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.binning import threshold_index
from gridloom.functions.cleaning import class_name
from gridloom.operators.relevance import with_relevance
from gridloom.operators.rows import names_containing
from gridloom.operators.select import arg_best
from gridloom.session import clean, settle, with_params

# Fixed values.
THRESHOLDS, THRESHOLD_STEP = 100, 0.01
PROBABILITY_EPSILON = 1e-7
DICE_SMOOTH = 1.0


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Count per distinct value; missing values are left out."""
    known = clean(_c(value)) if df.schema[value].dataType.typeName() in ("double", "float") else _c(value)
    return df.filter(known.isNotNull()).groupBy(_c(value)).agg(F.count("*").alias("count"))


def category_distribution(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(_c(category)).agg(F.count("*").alias("count"))


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) over all rows; a constant column becomes missing."""
    limits = df.agg(*[f(clean(_c(c))).alias(f"{side}{i}") for i, c in enumerate(columns) for side, f in (("lo", F.min), ("hi", F.max))])
    scaled = {
        c: F.try_divide(clean(_c(c)) - F.col(f"_fit.lo{i}"), F.col(f"_fit.hi{i}") - F.col(f"_fit.lo{i}"))
        for i, c in enumerate(columns)
    }
    return with_params(df, limits).withColumns(scaled).drop("_fit")


def composite_score(df: DataFrame, texts: Sequence[str] = ("MAE", "RMSE", "SERA"), out: str = "composite_score") -> DataFrame:
    """Negative sum of all columns whose name contains one of the texts; missing counts as 0."""
    total: Column = F.lit(0.0)
    for text in texts:
        for name in names_containing(df, text):
            total = total + F.coalesce(clean(_c(name)), F.lit(0.0))
    return df.withColumn(out, -total)


def mean_fold_metric(df: DataFrame, metric: str, params: Sequence[str], out: str = "mean_metric") -> DataFrame:
    return df.groupBy(*params).agg(F.avg(_c(metric)).alias(out))


def _error_metrics(y: Column, yhat: Column) -> list[Column]:
    e = yhat - y
    return [
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count("*"))).alias("r2"),
        F.corr(y, yhat).alias("pearson_r"),
    ]


def _pairs(df: DataFrame, y: str, yhat: str, log_scale: bool) -> DataFrame:
    a, b = clean(_c(y)), clean(_c(yhat))
    if log_scale:
        a, b = F.expm1(a), F.expm1(b)
    return df.withColumns({"_y": a, "_yhat": b}).filter(F.col("_y").isNotNull() & F.col("_yhat").isNotNull())


def regression_metrics(df: DataFrame, y: str, yhat: str, log_scale: bool = False) -> DataFrame:
    """n, mae, rmse, r2, pearson_r in one pass; ``log_scale`` undoes log1p first."""
    return _pairs(df, y, yhat, log_scale).agg(*_error_metrics(F.col("_y"), F.col("_yhat")))


def regression_metrics_by_class(
    df: DataFrame, y: str, yhat: str, category: str, log_scale: bool = False, minimum: int = 2
) -> DataFrame:
    """The same per category; categories with fewer than ``minimum`` rows are left out."""
    table = _pairs(df, y, yhat, log_scale).groupBy(_c(category)).agg(*_error_metrics(F.col("_y"), F.col("_yhat")))
    return table.filter(F.col("n") >= minimum)


def sera(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), log_scale: bool = False) -> DataFrame:
    """Squared error weighted by relevance. Control points come from the rows (of each group) passed in."""
    pairs = _pairs(df, y, yhat, log_scale).select(*by, "_y", "_yhat")
    weighted = with_relevance(pairs, "_y", by=by, out="_phi")
    e = F.col("_yhat") - F.col("_y")
    return weighted.groupBy(*by).agg(F.sum(F.col("_phi") * e * e).alias("sera"))


def _at_or_above(hist: DataFrame, by: Sequence[str], index: str, sums: Sequence[str], count: int) -> DataFrame:
    """For every index 0..count-1: sums over the histogram rows at or above it, and over all rows.

    The histogram has at most ``count`` rows per group, so this is at most count squared small rows.
    """
    spread = hist.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    reached = F.col("i") <= F.col(index)
    return spread.groupBy(*by, "i").agg(
        *[F.coalesce(F.sum(F.when(reached, F.col(s))), F.lit(0)).alias(s) for s in sums],
        *[F.sum(s).alias(f"{s}_total") for s in sums],
    )


def sera_curve(df: DataFrame, y: str, yhat: str, steps: int = 100) -> DataFrame:
    """(t, ser): squared error of the rows whose relevance is at least t, for t = i / steps."""
    weighted = with_relevance(_pairs(df, y, yhat, False).select("_y", "_yhat"), "_y", out="_phi")
    e = F.col("_yhat") - F.col("_y")
    index = threshold_index(F.col("_phi"), 1.0 / steps, steps + 1)
    hist = weighted.groupBy(index.alias("b")).agg(F.sum(e * e).alias("ser"))
    curve = _at_or_above(hist, [], "b", ["ser"], steps + 1)
    return curve.select((F.col("i") * F.lit(1.0 / steps)).alias("t"), "ser")


def confusion_columns(label: Column, prob: Column, threshold: Column) -> list[Column]:
    said = clean(prob) >= threshold
    return [
        F.count_if((label == 0) & ~said).alias("TN"),
        F.count_if((label == 0) & said).alias("FP"),
        F.count_if((label == 1) & ~said).alias("FN"),
        F.count_if((label == 1) & said).alias("TP"),
    ]


def confusion(df: DataFrame, label: str, prob: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN, TP with a probability at the threshold counting as positive."""
    return df.groupBy(*by).agg(*confusion_columns(_c(label), _c(prob), F.lit(float(threshold))))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a.cast("double"), b))


def segmentation_columns() -> dict[str, Column]:
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    return {
        "recall": _ratio(tp, tp + fn),
        "precision": _ratio(tp, tp + fp),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        "IOU": F.try_divide(tp.cast("double"), tp + fn + fp),
    }


def segmentation_metrics(counts: DataFrame) -> DataFrame:
    """Recall, precision, F1 and intersection over union from the four counts."""
    return counts.withColumns(segmentation_columns())


def _threshold_histogram(df: DataFrame, label: str, prob: str, by: Sequence[str]) -> DataFrame:
    """Positives and rows per (group, last threshold not above the probability): one pass over the data."""
    index = threshold_index(_c(prob), THRESHOLD_STEP, THRESHOLDS)
    known = df.filter(_c(label).isNotNull() & clean(_c(prob)).isNotNull())
    return known.groupBy(*by, index.alias("b")).agg(F.sum(_c(label).cast("bigint")).alias("pos"), F.count("*").alias("all"))


def _threshold_counts(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    table = _at_or_above(hist, by, "b", ["pos", "all"], THRESHOLDS)
    return table.select(
        *by, "i", (F.col("i") * F.lit(THRESHOLD_STEP)).alias("threshold"),
        F.col("pos").alias("TP"), (F.col("all") - F.col("pos")).alias("FP"),
        (F.col("pos_total") - F.col("pos")).alias("FN"),
        (F.col("all_total") - F.col("pos_total") - (F.col("all") - F.col("pos"))).alias("TN"),
    )


def threshold_sweep(df: DataFrame, label: str, prob: str) -> DataFrame:
    """The four counts and the metrics at each of the 100 thresholds."""
    return segmentation_metrics(_threshold_counts(_threshold_histogram(df, label, prob, []), []))


def best_threshold(df: DataFrame, label: str, prob: str) -> DataFrame:
    """The threshold with the highest F1, the lowest one on ties."""
    return arg_best(threshold_sweep(df, label, prob), "f1_score", "i", "max").drop("i")


def metrics_by_class_report(df: DataFrame, label: str, prob: str, class_id: str, tile: str) -> DataFrame:
    """One row for all tiles and one per size class, all at the threshold that is best for all tiles.

    The data is read once into a histogram by class and threshold; every number of the report comes
    from it. Tiles are counted by a second, two-column pass.
    """
    everywhere = F.explode(F.array(F.coalesce(class_name(_c(class_id)), F.lit("none")), F.lit("All")))
    hist = _threshold_histogram(df, label, prob, [class_id])
    hist = hist.withColumn("Class", everywhere).groupBy("Class", "b").agg(F.sum("pos").alias("pos"), F.sum("all").alias("all"))
    hist = settle(hist)  # a few hundred rows, used for the threshold and for the report
    table = segmentation_metrics(_threshold_counts(hist, ["Class"]))
    best = F.max_by(F.col("i"), F.when(F.col("Class") == "All", F.struct("f1_score", -F.col("i"))))
    chosen = with_params(table, table.agg(best.alias("i"))).filter(F.col("i") == F.col("_fit.i")).drop("_fit", "i")
    tiles = df.select(_c(class_id), _c(tile)).distinct().withColumn("Class", everywhere)
    counts = tiles.groupBy("Class").agg(F.count_distinct(_c(tile)).alias("Num_Tiles"))
    return chosen.filter(F.col("Class") != "none").join(counts, "Class")


def _label_and_probability(label: str, prob: str) -> tuple[Column, Column]:
    return _c(label).cast("double"), clean(_c(prob).cast("double"))


def bce_columns(label: str, prob: str) -> list[Column]:
    y, p = _label_and_probability(label, prob)
    q = F.least(F.greatest(p, F.lit(PROBABILITY_EPSILON)), F.lit(1.0 - PROBABILITY_EPSILON))
    return [F.avg(-(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))).alias("bce")]


def dice_columns(label: str, prob: str) -> list[Column]:
    y, p = _label_and_probability(label, prob)
    dice = (F.lit(2.0) * F.sum(y * p) + DICE_SMOOTH) / (F.sum(y) + F.sum(p) + DICE_SMOOTH)
    return [dice.alias("dice"), (F.lit(1.0) - dice).alias("dice_loss")]


def mean_bce(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean binary cross-entropy with clipped probabilities."""
    return df.groupBy(*by).agg(*bce_columns(label, prob))


def dice(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Smoothed dice coefficient and 1 - dice."""
    return df.groupBy(*by).agg(*dice_columns(label, prob))


def soft_prf(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Recall, precision and F1 from rounded (half to even) label-probability products."""
    y, p = _label_and_probability(label, prob)

    def rounded(x: Column) -> Column:
        return F.sum(F.bround(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)), 0))

    sums = df.groupBy(*by).agg(rounded(y * p).alias("tp"), rounded(y).alias("pp"), rounded(p).alias("sp"))
    epsilon = F.lit(PROBABILITY_EPSILON)
    sums = sums.withColumns({"recall": F.col("tp") / (F.col("pp") + epsilon), "precision": F.col("tp") / (F.col("sp") + epsilon)})
    both = F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + epsilon)
    return sums.select(*by, "recall", "precision", (F.lit(2.0) * both).alias("f1"))


def combined_loss(df: DataFrame, label: str, prob: str, alpha: float = 0.816, by: Sequence[str] = ()) -> DataFrame:
    """(1 - alpha) * dice loss + alpha * cross-entropy, in one pass."""
    parts = df.groupBy(*by).agg(*dice_columns(label, prob), *bce_columns(label, prob))
    loss = F.lit(1.0 - alpha) * F.col("dice_loss") + F.lit(float(alpha)) * F.col("bce")
    return parts.select(*by, loss.alias("loss"))
