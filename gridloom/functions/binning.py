"""Bins on literal edges. The arithmetic guess is always corrected against the edges themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import clean


def edge(i: Column, step: float) -> Column:
    return i.cast("double") * F.lit(float(step))


def threshold_index(p: Column, step: float = 0.01, count: int = 100) -> Column:
    """Index of the last threshold ``i * step`` (i below ``count``) that is not above ``p``; p >= 0."""
    p = clean(p)
    guess = F.least(F.greatest(F.floor(p / F.lit(step)), F.lit(0)), F.lit(count - 1)).cast("int")
    up = (guess + 1 < count) & (edge(guess + 1, step) <= p)
    down = (guess > 0) & (edge(guess, step) > p)
    return F.when(up, guess + 1).when(down, guess - 1).when(p.isNotNull(), guess)


def cut_uniform(x: Column, width: float, count: int) -> Column:
    """Right-closed bin 1..count of ``x`` on edges ``i * width``; the first bin also holds 0; outside: NULL."""
    x = clean(x)
    guess = F.greatest(F.ceil(x / F.lit(width)), F.lit(1)).cast("int")
    up, down = edge(guess, width) < x, (guess > 1) & (edge(guess - 1, width) >= x)
    index = F.when(up, guess + 1).when(down, guess - 1).otherwise(guess)
    return F.when((x >= 0) & (x <= F.lit(count * width)), index)


def count_below(df: DataFrame, searches: list[tuple[Column, Column, str, bool]], size: int) -> DataFrame:
    """Binary search in sorted arrays of ``size`` elements, all searches in step.

    Each search is (value, array, output name, inclusive): the output is how many elements are below
    the value (or not above it, when inclusive). Every halving is one projection inside the same
    code-generation stage.
    """
    names = [name for _, _, name, _ in searches]
    df = df.withColumns({name: F.lit(0) for name in names})
    step = 1 << (size.bit_length() - 1)
    while step:
        moved = {}
        for value, array, name, inclusive in searches:
            at = F.col(name) + step
            probe = F.get(array, at - 1)
            hit = probe <= value if inclusive else probe < value
            moved[name] = F.when((at <= size) & hit, at).otherwise(F.col(name))
        df = df.withColumns(moved)
        step //= 2
    return df


def cut_right_closed(df: DataFrame, x: str, edges: list[float], out: str) -> DataFrame:
    """Right-closed bin number 1..len(edges)-1 on arbitrary sorted edges; first bin holds its left edge."""
    value, last = clean(F.col(x)), len(edges) - 1
    literal = F.array(*[F.lit(float(e)) for e in edges])
    df = count_below(df, [(value, literal, out, False)], len(edges))
    return df.withColumn(
        out,
        F.when(value == edges[0], F.lit(1)).when((value > edges[0]) & (value <= edges[last]), F.col(out)),
    )
