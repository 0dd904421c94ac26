"""W: splits, folds, shuffles, batches, rare bins."""

from __future__ import annotations

from gridloom.operators import quantiles, split
from workloads import tables as t
from workloads.registry import Registry

registry = Registry()
query = registry.add


def split_ctes(name, source, percent, hashed, key, stratum, by=""):
    """CTEs ending in ``name``: the rows of ``source`` with is_test."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"{by}, {stratum}" if by else stratum
    return f"""{name}_n AS (SELECT {group}, count(*) AS n_s FROM {source} GROUP BY {group}),
    {name}_t AS (SELECT *, sum(n_s) OVER ({part}) AS n FROM {name}_n),
    {name}_b AS (SELECT *, ((n * {percent} + 99) // 100 * n_s) // n AS base, ((n * {percent} + 99) // 100 * n_s) % n AS rest, (n * {percent} + 99) // 100 AS n_test FROM {name}_t),
    {name}_q AS (SELECT {group}, CASE WHEN n_s = 1 THEN 0 ELSE base + CASE WHEN row_number() OVER ({part} ORDER BY rest DESC, {stratum}) <= n_test - sum(base) OVER ({part})
      THEN 1 ELSE 0 END END AS quota FROM {name}_b),
    {name} AS (SELECT s.*, row_number() OVER (PARTITION BY {group} ORDER BY {hashed}, {key}) <= quota AS is_test FROM {source} s JOIN {name}_q USING ({group}))"""


@query(
    "w1_stratified_split",
    f"""WITH e AS (SELECT event_id, event_type FROM events),
    {split_ctes('one', 'e', 30, "md5('42' || event_id)", 'event_id', 'event_type')},
    held AS (SELECT event_id, event_type FROM one WHERE is_test),
    {split_ctes('two', 'held', 50, "md5('41' || event_id)", 'event_id', 'event_type')}
    SELECT event_id, event_type, 'train' AS part FROM one WHERE NOT is_test
    UNION ALL SELECT event_id, event_type, CASE WHEN is_test THEN 'test' ELSE 'val' END FROM two""",
)
def w1(spark, d):
    return split.train_val_test(t.table(spark, d, "events").select("event_id", "event_type"), "event_id", "event_type")


@query(
    "w2_repeated_holdout",
    f"""WITH f AS (SELECT event_id, event_type, fold, seed FROM events, (VALUES (0, 81), (1, 14), (2, 3)) v(fold, seed)),
    {split_ctes('one', 'f', 20, "md5(seed || '' || event_id)", 'event_id', 'event_type', 'fold')}
    SELECT event_id, event_type, fold, seed, is_test FROM one""",
)
def w2(spark, d):
    return split.repeated_holdout(t.table(spark, d, "events").select("event_id", "event_type"), "event_id", "event_type")


@query(
    "w3_kfold",
    """SELECT o_orderkey, CAST(CASE WHEN r < (n % 10) * (n // 10 + 1) THEN r // (n // 10 + 1) ELSE (r - n % 10) // (n // 10) END AS INTEGER) AS fold
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42' || o_orderkey), o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders)""",
)
def w3(spark, d):
    return split.kfold(t.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 10)


@query("w4_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('7' || doc_id), doc_id) - 1 AS position FROM documents")
def w4(spark, d):
    return quantiles.shuffled_rank(t.table(spark, d, "documents").select("doc_id"), 7, "doc_id", "position")


@query(
    "w5_batches",
    """SELECT vec_id, (row_number() OVER (ORDER BY md5('42' || vec_id), vec_id) - 1) // 16 AS batch, (SELECT count(*) // 16 FROM embeddings) AS steps FROM embeddings""",
)
def w5(spark, d):
    vectors = t.table(spark, d, "embeddings").select("vec_id")
    steps = split.steps_per_epoch(vectors, 16).scalar()
    return split.batches(vectors, 16, 42, "vec_id").withColumn("steps", steps)


@query(
    "w6_bin_and_merge_rare",
    f"""WITH e AS (SELECT i AS bin, (i - 1) * 0.1::DOUBLE AS lo, i * 0.1::DOUBLE AS hi FROM range(1, 1001) r(i)),
    b AS (SELECT event_id, bin FROM ({t.STATIONS_SQL}) s LEFT JOIN e ON (s.y > e.lo AND s.y <= e.hi) OR (s.y = 0 AND e.bin = 1)),
    n AS (SELECT bin, count(*) AS size FROM b GROUP BY bin)
    SELECT event_id, CASE WHEN b.bin IS NULL THEN NULL WHEN size < 2 THEN 'Other' ELSE CAST(b.bin AS VARCHAR) END AS bin FROM b LEFT JOIN n USING (bin)""",
)
def w6(spark, d):
    return split.bin_and_merge_rare(t.stations(spark, d), "y").select("event_id", "bin")
