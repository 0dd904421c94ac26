"""Fitted scalers: standardisation, tile z-scores, normal quantile scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.quantiles import percentile_row
from gridloom.session import clean, lookup_join, with_params


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def fit_standardize(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std): population deviation, 1 where it is 0. A small table to keep with the model."""
    stats = [F.struct(F.lit(c).alias("column"), F.avg(clean(_c(c))).alias("mean"), F.stddev_pop(clean(_c(c))).alias("std")) for c in columns]
    table = train.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    return table.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def standardize_columns(columns: Sequence[str], fitted: str = "_fit") -> dict[str, Column]:
    return {c: (clean(_c(c)) - F.col(f"{fitted}.m{i}")) / F.col(f"{fitted}.s{i}") for i, c in enumerate(columns)}


def apply_standardize(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / std with parameters from ``fit_standardize``, matched by column name."""
    wide = fitted.agg(
        *[F.max(F.when(F.col("column") == c, F.col(p))).alias(f"{p[0]}{i}") for i, c in enumerate(columns) for p in ("mean", "std")]
    )
    return with_params(df, wide).withColumns(standardize_columns(columns)).drop("_fit")


def tile_zscore(pixels: DataFrame, tile: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Per tile (x - mean) / max(std, 1/sqrt(n)), population deviation; ``columns`` maps output to input.

    The statistics of all columns are one partial-then-final aggregation joined back, so a very large
    tile is not gathered in one task as it would be by a window.
    """
    stats = []
    for i, c in enumerate(columns.values()):
        x = clean(_c(c))
        stats += [F.avg(x).alias(f"_mean{i}"), F.stddev_pop(x).alias(f"_std{i}"), F.count(x).alias(f"_n{i}")]
    joined = lookup_join(pixels, pixels.groupBy(*tile).agg(*stats), list(tile))
    scores = {}
    for i, (out, c) in enumerate(columns.items()):
        n = F.col(f"_n{i}")
        floor = F.lit(1.0) / F.sqrt(n.cast("double"))
        z = (clean(_c(c)) - F.col(f"_mean{i}")) / F.greatest(F.col(f"_std{i}"), floor)
        scores[out] = F.when(n > 0, z)
    made = [f"_{name}{i}" for i in range(len(columns)) for name in ("mean", "std", "n")]
    return joined.withColumns(scores).drop(*made)


# Acklam's rational approximation of the inverse normal distribution.
TAIL = 0.02425
CENTRAL_A = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
CENTRAL_B = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0]
TAIL_C = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
TAIL_D = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0]
PROBABILITY_CLIP = 1e-7


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    total = x * coefficients[0] + coefficients[1]
    for c in coefficients[2:]:
        total = total * x + c
    return total


def _array(values: Sequence[float]) -> Column:
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def _present(x: Column) -> Column:
    """Whether ``x`` is not NULL. The lambda keeps a projection out of whole-stage code: there all its columns would be one method
    that the JVM does not compile, so each column's expression becomes methods of its own."""
    return F.exists(F.array(x), lambda v: v.isNotNull())


def inverse_normal(p: Column) -> Column:
    """Normal quantile of p in (0, 1); the lower tail is evaluated for both sides and mirrored."""
    q = p - 0.5
    r = F.sqrt(F.log(F.least(p, 1.0 - p)) * -2.0)
    tail = F.try_divide(_polynomial(TAIL_C, r), _polynomial(TAIL_D, r))
    middle = F.try_divide(_polynomial(CENTRAL_A, q * q) * q, _polynomial(CENTRAL_B, q * q))
    return F.when(F.abs(q) <= 0.5 - TAIL, middle).otherwise(-F.signum(q) * tail)


def fit_quantiles(train: DataFrame, columns: Sequence[str], landmarks: int = 100) -> DataFrame:
    """One row: for each column its landmarks at equal probability steps."""
    return percentile_row(train, columns, [k / (landmarks - 1) for k in range(landmarks)])


def apply_quantile_normalize(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column to a normal score by the landmarks of ``fit_quantiles`` (one row, read here); see ``normal_scores``."""
    row = fitted.first()
    return normal_scores(df, {c: row[c] for c in columns})


def normal_scores(df: DataFrame, landmarks: Mapping[str, Sequence[float] | None]) -> DataFrame:
    """Each column to a normal score: interpolated position among its landmarks, then the inverse normal.

    Among equal landmarks the positions from the left and from the right are averaged. Missing stays
    missing. The landmarks (one row, 100 numbers per column) become the splits of a Bucketizer, so a
    position is a binary search in the JVM and no row leaves its partition.
    """
    columns, splits, positions, places = list(landmarks), [], [], []
    infinite = float("inf")
    for c, q in landmarks.items():
        q = q or [0.0]  # no value: nothing to place
        first, last = {v: i for i, v in reversed(list(enumerate(q)))}, {v: i for i, v in enumerate(q)}
        finite = sorted(v for v in first if abs(v) != infinite) or [0.0]
        places.append((q, finite, [first.get(v, 0) for v in finite], [last.get(v, 0) for v in finite]))
        splits.append([-infinite, *finite, infinite])
    work = df.withColumns({f"_x{i}": clean(_c(c).cast("double")) for i, c in enumerate(columns)})
    marks = [f"_b{i}" for i in range(len(columns))]
    finder = Bucketizer(splitsArray=splits, inputCols=[f"_x{i}" for i in range(len(columns))], outputCols=marks, handleInvalid="keep")
    # k is the last finite landmark not above x
    work = finder.transform(work).withColumns({f"_k{i}": F.get(F.transform(F.array(m), lambda b: b.cast("int") - 1), F.lit(0)) for i, m in enumerate(marks)})
    for i, (q, finite, first, last) in enumerate(places):
        x, k = F.col(f"_x{i}"), F.col(f"_k{i}")
        marks_at = _array(finite)
        left, right = F.get(marks_at, k), F.get(marks_at, k + 1)
        # between a finite and an infinite landmark a value is at the finite one
        inside = F.when(k < 0, F.lit(float(first[0]))).otherwise(F.get(_array(last), k) + F.coalesce(F.try_divide(x - left, right - left), F.lit(0.0)))
        on = F.get(_array([(a + b) / 2.0 for a, b in zip(first, last)]), k)
        p = F.when(x == left, on).otherwise(inside) / F.lit(float(max(1, len(q) - 1)))
        p = F.when(x <= q[0], F.lit(PROBABILITY_CLIP)).when(x >= q[-1], F.lit(1.0 - PROBABILITY_CLIP)).otherwise(p)
        p = F.least(F.greatest(p, F.lit(PROBABILITY_CLIP)), F.lit(1.0 - PROBABILITY_CLIP))
        positions.append(F.when(_present(x), p))
    # positions and scores are steps of their own: a score names its position some sixty times, so written into one another they
    # are half a million nodes for 17 columns. Not inside a lambda: those are interpreted, node by node, for every value
    work = work.withColumns({f"_p{i}": p for i, p in enumerate(positions)})
    scores = {c: F.when(_present(F.col(f"_p{i}")), inverse_normal(F.col(f"_p{i}"))) for i, c in enumerate(columns)}
    return work.withColumns(scores).select(*[_c(c) for c in df.columns])


def quantile_normalize(df: DataFrame, columns: Sequence[str], landmarks: int = 100) -> DataFrame:
    return apply_quantile_normalize(df, fit_quantiles(df, columns, landmarks), columns)


class _ScoreParams(HasInputCols):
    """Columns that are replaced by their normal scores, and what a missing score becomes (NaN: it stays missing)."""

    missing = Param(Params._dummy(), "missing", "value of a missing score", typeConverter=TypeConverters.toFloat)


class NormalScores(Estimator, _ScoreParams, DefaultParamsReadable, DefaultParamsWritable):
    """Normal scores as a stage of a Pipeline: inside a cross-validation its landmarks are fitted on the rows of the other
    folds only."""

    count = Param(Params._dummy(), "count", "number of landmarks", typeConverter=TypeConverters.toInt)

    def __init__(self, inputCols: Sequence[str] | None = None, missing: float = float("nan"), count: int = 100) -> None:
        super().__init__()
        self._setDefault(missing=float("nan"), count=100)
        self._set(missing=missing, count=count, **({"inputCols": list(inputCols)} if inputCols is not None else {}))

    def _fit(self, dataset: DataFrame) -> NormalScoresModel:
        columns = self.getInputCols()
        row = fit_quantiles(dataset, columns, self.getOrDefault(self.count)).first()
        return NormalScoresModel(columns, [list(row[c] or []) for c in columns], self.getOrDefault(self.missing))


class NormalScoresModel(Model, _ScoreParams, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted stage: its landmarks are a parameter, so they are saved with the pipeline and loaded again."""

    landmarks = Param(Params._dummy(), "landmarks", "landmarks of each column", typeConverter=TypeConverters.identity)

    def __init__(self, inputCols: Sequence[str] | None = None, landmarks: Sequence[Sequence[float]] | None = None, missing: float = float("nan")) -> None:
        super().__init__()
        self._setDefault(missing=float("nan"))
        self._set(missing=missing, **({} if inputCols is None else {"inputCols": list(inputCols), "landmarks": [list(q) for q in landmarks or []]}))

    def by_column(self) -> dict[str, list[float]]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.landmarks)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored, missing = normal_scores(dataset, self.by_column()), self.getOrDefault(self.missing)
        if missing != missing:
            return scored
        return scored.withColumns({c: F.coalesce(_c(c), F.lit(missing)) for c in self.getInputCols()})
