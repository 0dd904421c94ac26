"""What every operator needs from the session: a checkpoint folder, settled tables, null-safe joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one is made only on a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="gridloom-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, so that later uses neither recompute it nor depend
    on the executors that made it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def noted(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder and read again. The optimizer then knows its bytes, so a join
    with a small one moves no row of the other side; ``settle`` leaves that to the end of a shuffle."""
    path = fresh_path(df.sparkSession, "noted")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """``df`` in the executors' memory, on their disks where that ends, from its first use until ``unpersist``: for rows that are
    read many times for a while and can be made again from settled ones. A pass reads only its columns."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def lookup_join(df: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a per-key table (unique on ``on``) to a large ``df``; NULL keys match NULL keys.

    It is a plain join: adaptive execution broadcasts the table if it turns out small, and splits skewed
    partitions of ``df`` if it does not.
    """
    renamed = table.select(
        *[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(on)],
        *[F.col(f"`{c}`") for c in table.columns if c not in on],
    )
    left, right = df.alias("_df"), renamed.alias("_table")
    matched = None
    for i, k in enumerate(on):
        same = F.col(f"_df.`{k}`").eqNullSafe(F.col(f"_table._key{i}"))
        matched = same if matched is None else matched & same
    joined = left.join(right, matched, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_key{i}" for i in range(len(on))])


def with_params(df: DataFrame, fitted: DataFrame, name: str = "_fit") -> DataFrame:
    """Add the one row of ``fitted`` to every row as the struct column ``name``.

    It is a scalar subquery: Spark runs it once, fails if it has more than one row, and the rows of
    ``df`` see a constant. No join is planned.
    """
    one = fitted.select(F.struct(*[F.col(f"`{c}`") for c in fitted.columns]).alias(name))
    return df.select("*", one.scalar().alias(name))


def clean(c: Column | str) -> Column:
    """NaN means missing: turn it into NULL before any comparison (Spark orders NaN above all numbers)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def with_row_key(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A number per row for tables that have no key, made from the row itself: a hash of all its columns, and
    among equal rows their count. So it does not change with the files, their order or the cluster."""
    hashed = df.withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    twin = F.row_number().over(Window.partitionBy("_h").orderBy(*[F.col(f"`{c}`") for c in df.columns])) - 1
    return hashed.withColumn(name, F.when(twin == 0, F.col("_h")).otherwise(F.xxhash64("_h", twin))).drop("_h")
