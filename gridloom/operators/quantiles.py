"""Exact order statistics, percentiles and global ranks without a single-task sort of the whole table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import clean, lookup_join, noted

# A value's image has so many bits after the whole part of its logarithm to base 2; OFFSET makes all logarithms positive.
FRACTION_BITS, OFFSET = 41, 1100.0

# Levels of the selection tree, as the low bits of an image that a level leaves out: of values and of md5 texts.
VALUE_LEVELS = (35, 23, 11, 0)
MD5_LEVELS = (44, 36, 28, 20, 8, 0)

# Rows of a cell that are ordered together without another level.
LEAF = 1 << 16

# Rows that share an md5 prefix, at most about: the prefix grows with the table.
PREFIX_ROWS = 100_000


def image(v: Column) -> Column:
    """A whole number of 53 bits and a sign that follows the order of doubles: a greater one never has a smaller image.

    It is the logarithm to base 2 in fixed point, so its high digits are sign and exponent and a few codes far outside do
    not stretch the cells of the others. Logarithm, sum, product and floor all keep the order.
    """
    size = F.floor((F.log2(F.abs(v)) + F.lit(OFFSET)) * F.lit(float(1 << FRACTION_BITS))).cast("bigint")
    far = F.lit(1 << (FRACTION_BITS + 12)).cast("bigint")
    size = F.when(v == 0, F.lit(0).cast("bigint")).when(F.abs(v) == float("inf"), far).otherwise(size)
    return F.when(v < 0, -size).otherwise(size)


def _holding(parts: Column, rank: Column) -> Column:
    """The part that holds a rank, and the number of values before it, from an ordered array of counted parts."""
    none = F.struct(F.lit(0).cast("bigint").alias("before"), F.get(parts, F.lit(-1)).alias("part"), F.lit(0).cast("bigint").alias("total"))

    def add(state: Column, part: Column) -> Column:
        total = state["total"] + part["size"]
        here = state["part"].isNull() & (rank < total)
        return F.struct(
            F.when(here, state["total"]).otherwise(state["before"]).alias("before"), F.when(here, part).otherwise(state["part"]).alias("part"), total.alias("total")
        )

    return F.aggregate(parts, none, add)


def located(
    rows: DataFrame, keys: Sequence[str], levels: Sequence[int], wants: Callable[[DataFrame], DataFrame], leaf: int = LEAF
) -> tuple[DataFrame, DataFrame]:
    """Where wanted ranks are: the rows of the small cells that hold one (with ``_cell``), and the wanted ranks counted inside
    their cell.

    ``rows`` has ``keys`` and ``image``. Images are counted by their high digits, for all keys in one aggregation, and only
    the cells that hold a wanted rank by their next digits, until no such cell has more than ``leaf`` rows of
    different images. ``wants`` makes the ranks (column ``rank``) from the first counts: a table of keys, ``n`` and ``_parts``.
    """
    keys, wanted, cells = list(keys), None, rows
    for shift in levels:
        cell = F.shiftright("image", shift)
        parent = [] if wanted is None else ["_cell"]
        counts = cells.groupBy(*keys, *parent, cell.alias("cell")).agg(F.count("*").alias("size"), (F.min("image") < F.max("image")).alias("open"))
        parts = counts.groupBy(*keys, *parent).agg(F.sort_array(F.collect_list(F.struct("cell", "size", "open"))).alias("_parts"), F.sum("size").alias("n"))
        if wanted is None:
            wanted = wants(parts)
        else:
            wanted = lookup_join(wanted, parts.drop("n"), [*keys, "_cell"], "inner")
        found = wanted.withColumn("_in", _holding(F.col("_parts"), F.col("rank"))).filter("_in.part IS NOT NULL")
        kept = [c for c in wanted.columns if c not in ("rank", "_parts", "_cell")]
        wanted = noted(found.select(*kept, (F.col("rank") - F.col("_in.before")).alias("rank"), F.col("_in.part.cell").alias("_cell"), "_in.part.size", "_in.part.open"))
        cells = lookup_join(rows.withColumn("_cell", cell), wanted.select(*keys, "_cell"), [*keys, "_cell"], "left_semi")
        largest = wanted.filter("open").agg(F.max("size")).first()[0]
        wanted = wanted.drop("size", "open")
        if largest is None or largest <= leaf:
            break
    return cells, wanted


def exact_percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), leaf: int = LEAF) -> DataFrame:
    """by..., name, n, q: linearly interpolated percentiles of each column (per group), exact at any size.

    A selection tree over the values' images (``located``): all columns and groups are counted together, level by
    level, and only the cells that hold a wanted rank are looked at again. What is left is counted by value and
    ranked, so a task never orders more than ``leaf`` rows that differ. A column (of a group) without a value has
    no row. An infinite value is an ordinary one at its end of the order.
    """
    by = list(by)
    keys = [*by, "name"]
    values = [F.struct(F.lit(c).alias("name"), clean(F.col(f"`{c}`").cast("double")).alias("value")) for c in columns]
    rows = df.select(*by, F.explode(F.array(*values)).alias("_c")).select(*by, "_c.*").filter(F.col("value").isNotNull()).withColumn("image", image(F.col("value")))
    at = F.col("p") * (F.col("n") - 1)

    def wants(parts: DataFrame) -> DataFrame:
        wanted = parts.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        return wanted.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))))

    cells, wanted = located(rows, keys, VALUE_LEVELS, wants, leaf)
    place = [*keys, "_cell"]
    counted = cells.groupBy(*place, "value").agg(F.count("*").alias("size"))
    counted = counted.withColumn("before", F.sum("size").over(Window.partitionBy(*place).orderBy("value")) - F.col("size"))
    found = lookup_join(counted, wanted, place, "inner").filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("size")))

    low, high, share = F.min("value"), F.max("value"), F.first(at - F.floor(at))
    between = F.when((high > low) & (share > 0), low + (high - low) * share).otherwise(low)
    pairs = found.groupBy(*keys, "n", "p").agg(between.alias("value"))
    by_p = F.map_from_entries(F.collect_list(F.struct("p", "value")))  # one entry per probability
    picked = F.transform(F.array(*[F.lit(float(p)) for p in probs]), lambda p: F.element_at(F.col("_m"), p))
    return noted(pairs.groupBy(*keys, "n").agg(by_p.alias("_m")).select(*keys, "n", picked.alias("q")))


def percentile_row(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row with an array of percentiles for each column, under the column's name."""
    table = exact_percentiles(df, columns, probs)
    return table.agg(*[F.max(F.when(F.col("name") == c, F.col("q"))).alias(c) for c in columns])


def md5_order(seed: int, key: str) -> Column:
    """Position of a row in the reproducible shuffle of ``seed``."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))


def rows_at(rows: DataFrame, wanted: DataFrame, keys: list[str], key: str) -> DataFrame:
    """The rows at wanted places of the md5 order of their group: ``wanted`` with ``_cut``, a struct of h and k.

    ``rows`` has ``keys``, the md5 text ``_h`` and the unique ``key``; ``wanted`` has ``keys`` and ``take``, counted from
    1. It is a descent in the digits of the md5 text: each level counts 256 parts of what holds a cut, and nothing else.
    """
    others = [c for c in wanted.columns if c not in keys]
    digits = F.conv(F.substring("_h", 1, 13), 16, 10).cast("bigint")
    imaged = rows.select(*keys, "_h", F.col(key).alias("_k"), digits.alias("image"))
    cells, placed = located(imaged, keys, MD5_LEVELS, lambda parts: lookup_join(wanted.withColumn("rank", F.col("take") - 1), parts.drop("n"), keys, "inner"))
    nth = F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy("_h", "_k")) - 1
    found = lookup_join(cells.withColumn("_nth", nth), placed, [*keys, "_cell"], "inner").filter("_nth = rank")
    return found.select(*keys, *others, F.struct(F.col("_h").alias("h"), F.col("_k").alias("k")).alias("_cut"))


def shuffled_rank(df: DataFrame, seed: int, key: str, out: str = "rank") -> DataFrame:
    """0-based global rank in the shuffle order.

    md5 spreads rows evenly over its prefixes, so ranks are counted per prefix and completed by a sort inside
    each prefix. The prefix is as long as the number of rows asks for, so a task's share does not grow.
    """
    digits = 2
    rows = df.count()
    while rows > PREFIX_ROWS * 16**digits:
        digits += 1
    marked = df.withColumn("_h", md5_order(seed, key)).withColumn("_p", F.substring("_h", 1, digits))
    sizes = marked.groupBy("_p").agg(F.count("*").alias("size"))
    # the running total of the counts: first within groups of prefixes, then over the groups
    half = digits // 2
    group = F.substring("_p", 1, half)
    within = F.sum("size").over(Window.partitionBy(group).orderBy("_p")) - F.col("size")
    totals = sizes.groupBy(group.alias("_g")).agg(F.sum("size").alias("_t"))
    order = F.array_sort(F.collect_list(F.struct("_g", "_t")))
    one = totals.agg(order.alias("groups"))
    counted = sizes.select("_p", within.alias("_w"), one.scalar().alias("_groups"))
    earlier = F.aggregate(
        F.filter(F.col("_groups"), lambda g: g["_g"] < F.substring(F.col("_p"), 1, half)),
        F.lit(0).cast("bigint"), lambda total, g: total + g["_t"],
    )
    starts = counted.select("_p", (F.col("_w") + earlier).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)) - 1 + F.col("_start")
    return lookup_join(marked, starts, ["_p"]).withColumn(out, rank.cast("bigint")).drop("_h", "_p", "_start")
