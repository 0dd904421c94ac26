"""E and M: fitted features, weights and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import binning, cleaning
from gridloom.operators import models, relevance, rows, scaling, split, weights
from gridloom.session import fresh_path, settle
from gridloom.sources import models as store
from workloads import tables as t
from workloads.evaluate import phi_sql
from workloads.registry import Registry
from workloads.splits import split_ctes

registry = Registry()
query = registry.add


@query(
    "e1_standardize",
    f"""WITH f AS (SELECT *, 7.0::DOUBLE AS same FROM ({t.FEATURES_SQL})),
    s AS (SELECT avg(cot) AS mc, stddev_pop(cot) AS sc, avg(cwp) AS mw, stddev_pop(cwp) AS sw FROM f WHERE l_linenumber <> 7)
    SELECT l_orderkey, l_linenumber, round((cot - mc) / sc, 6) + 0 AS cot, round((cwp - mw) / sw, 6) + 0 AS cwp, 0.0::DOUBLE AS same FROM f, s""",
)
def e1(spark, d):
    data = t.feature_rows(spark, d).withColumn("same", F.lit(7.0))
    fitted = scaling.fit_standardize(data.filter(F.col("l_linenumber") != 7), ["cot", "cwp", "same"])  # fitted on the training lines
    done = scaling.apply_standardize(data, fitted, ["cot", "cwp", "same"])
    return done.select("l_orderkey", "l_linenumber", *[t.r6(F.col(c)).alias(c) for c in ("cot", "cwp", "same")])


@query(
    "e2_tile_zscore",
    f"""SELECT tile, "row", col, round((value - avg(value) OVER w) / greatest(stddev_pop(value) OVER w, 1 / sqrt(count(value) OVER w)), 6) + 0 AS zscore
    FROM ({t.TILES_SQL}) WINDOW w AS (PARTITION BY tile)""",
)
def e2(spark, d):
    done = scaling.tile_zscore(t.tiles(spark, d).select("tile", "row", "col", "value"), ["tile"], {"zscore": "value"})
    return done.select("tile", "row", "col", t.r6(F.col("zscore")).alias("zscore"))


PHI_SQL = phi_sql(f"SELECT 1 AS g, event_id, y FROM ({t.STATIONS_SQL})", "g", "event_id")


@query("e3_relevance_phi", PHI_SQL + " SELECT event_id, round(phi, 6) + 0 AS phi FROM phi")
def e3(spark, d):
    done = relevance.with_relevance(t.stations(spark, d).select("event_id", "y"), "y")
    return done.select("event_id", t.r6(F.col("phi")).alias("phi"))


@query("e4_relevance_class", PHI_SQL + " SELECT event_id, CASE WHEN phi = 0 THEN 'low' WHEN phi < 1 THEN 'medium' WHEN phi >= 1 THEN 'high' END AS \"class\" FROM phi")
def e4(spark, d):
    done = relevance.with_relevance(t.stations(spark, d).select("event_id", "y"), "y")
    return done.select("event_id", cleaning.relevance_class(F.col("phi")).alias("class"))


def density_sql(source):
    """Weights for alpha 0, 0.9 and 1 of (event_id, y)."""
    return f"""WITH s AS ({source}),
    p AS (SELECT lo, 0.9::DOUBLE * CASE WHEN iqr > 0 THEN least(sd, iqr) ELSE sd END * pow(n, -0.2::DOUBLE) / 8 AS step FROM
      (SELECT min(y) AS lo, stddev_pop(y) AS sd, (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / 1.34::DOUBLE AS iqr, count(y)::DOUBLE AS n FROM s)),
    x AS (SELECT event_id, y, (y - lo) / step AS pos, CAST(floor((y - lo) / step) AS BIGINT) AS k FROM s, p),
    c AS (SELECT k, count(*) AS c, sum(pos - k) AS r FROM x WHERE y IS NOT NULL GROUP BY k),
    m AS (SELECT k, sum(m) AS m FROM (SELECT k, c - r AS m FROM c UNION ALL SELECT k + 1, r FROM c) GROUP BY k),
    g AS (SELECT k + o AS k, sum(m * exp(-0.5::DOUBLE * pow(o / 8.0::DOUBLE, 2))) AS d FROM m, range(-48, 49) t(o) GROUP BY 1),
    dens AS (SELECT event_id, a.d + (pos - x.k) * (b.d - a.d) AS p FROM x LEFT JOIN g a ON a.k = x.k LEFT JOIN g b ON b.k = x.k + 1),
    w AS (SELECT event_id, CASE WHEN p IS NOT NULL THEN greatest(1 - 0.9::DOUBLE * ((p - pmin) / (pmax - pmin)), 1e-6::DOUBLE) END AS half,
      CASE WHEN p IS NOT NULL THEN greatest(1 - (p - pmin) / (pmax - pmin), 1e-6::DOUBLE) END AS whole FROM dens, (SELECT min(p) AS pmin, max(p) AS pmax FROM dens))
    SELECT event_id, round(half / (SELECT avg(half) FROM w), 6) AS w09, round(whole / (SELECT avg(whole) FROM w), 6) AS w10,
      CASE WHEN half IS NOT NULL THEN 1.0::DOUBLE END AS w00 FROM w"""


def weighed(rows):
    names = {"w00": 0.0, "w09": 0.9, "w10": 1.0}
    done = weights.density_weights(rows, "y", names)
    return done.select("event_id", *[t.r6(F.col(n)).alias(n) for n in names])


@query("e5_density_weight", density_sql(f"SELECT event_id, y FROM ({t.STATIONS_SQL})"))
def e5(spark, d):
    return weighed(t.stations(spark, d).select("event_id", "y"))


@query("e5_density_weight_heavy", density_sql(f"SELECT event_id, exp(y / 60.0::DOUBLE) AS y FROM ({t.STATIONS_SQL})"))
def e5_heavy(spark, d):
    """The same on a target with a long tail, whose grid has many empty intervals."""
    return weighed(t.stations(spark, d).select("event_id", F.exp(F.col("y") / F.lit(60.0)).alias("y")))


EDGES = [0.0, 0.1, 0.5, 1.0, 2.5, 10.0, 33.3, 50.0, 100.0]


@query(
    "e6_cut_right_closed",
    f"""WITH e AS (SELECT i AS bin, (i - 1) * 0.1::DOUBLE AS lo, i * 0.1::DOUBLE AS hi FROM range(1, 1001) r(i))
    SELECT event_id, CAST(e.bin AS INTEGER) AS fine, CAST(CASE {' '.join(f'WHEN y >= {a}::DOUBLE AND y <= {b}::DOUBLE THEN {i + 1}' if i == 0 else f'WHEN y > {a}::DOUBLE AND y <= {b}::DOUBLE THEN {i + 1}'
    for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))} END AS INTEGER) AS coarse
    FROM ({t.STATIONS_SQL}) s LEFT JOIN e ON (s.y > e.lo AND s.y <= e.hi) OR (s.y = 0 AND e.bin = 1)""",
)
def e6(spark, d):
    fine = t.stations(spark, d).select("event_id", "y", binning.cut_uniform(F.col("y"), 0.1, 1000).alias("fine"))
    return binning.cut_right_closed(fine, "y", EDGES, "coarse").drop("y")


def normal_sql(p):
    def poly(c, x):
        out = f"({c[0]!r})::DOUBLE"
        for k in c[1:]:
            out = f"({out} * {x} + ({k!r})::DOUBLE)"
        return out

    def tail(q):
        r = f"sqrt(-2 * ln({q}))"
        return f"({poly(scaling.TAIL_C, r)} / {poly(scaling.TAIL_D, r)})"

    q = f"({p} - 0.5::DOUBLE)"
    middle = f"({poly(scaling.CENTRAL_A, f'({q} * {q})')} * {q} / {poly(scaling.CENTRAL_B, f'({q} * {q})')})"
    return f"CASE WHEN {p} < 0.02425::DOUBLE THEN {tail(p)} WHEN {p} > 1 - 0.02425::DOUBLE THEN -{tail(f'(1 - {p})')} ELSE {middle} END"


def normalize_sql(column):
    """Per column: position p among the 100 landmarks, then the normal score."""
    f, b = f"len(list_filter(q, lambda v: v <= {column}))", f"len(list_filter(q, lambda v: v < {column}))"
    between = "({k} - 1 + ({c} - q[{k}]) / (q[{k} + 1] - q[{k}])) / 99.0::DOUBLE"
    p = f"""CASE WHEN {column} <= q[1] THEN 0 WHEN {column} >= q[100] THEN 1 ELSE
      ({between.format(k='f', c=column)} + {between.format(k='b', c=column)}) / 2 END"""
    return f"""SELECT id, round({normal_sql('p')}, 5) + 0 AS z FROM (SELECT id, CASE WHEN {column} IS NOT NULL THEN
      least(greatest({p}, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE) END AS p FROM (SELECT id, {column}, q, {f} AS f, {b} AS b FROM src,
      (SELECT quantile_cont({column}, [k / 99.0::DOUBLE for k in range(100)]) AS q FROM src)))"""


@query(
    "e7_quantile_normalize",
    f"""WITH src AS (SELECT event_id AS id, y, floor(y / 10) AS ties FROM ({t.STATIONS_SQL})), a AS ({normalize_sql('y')}), b AS ({normalize_sql('ties')})
    SELECT a.id AS event_id, a.z AS y, b.z AS ties FROM a JOIN b USING (id)""",
)
def e7(spark, d):
    data = t.stations(spark, d).select("event_id", "y", F.floor(F.col("y") / 10).cast("double").alias("ties"))
    done = scaling.quantile_normalize(data, ["y", "ties"])
    return done.select("event_id", t.r6(F.col("y"), 5).alias("y"), t.r6(F.col("ties"), 5).alias("ties"))


# Models: trees differ between libraries, so these are checked by rows only. m1, m2 and m4 to m6 are registered with
# fewer candidates and trees than the defaults of the functions, on whole tables; m3 with the defaults.
FEATURES = ["part_size", "part_price", "quantity", "month"]


def price_rows(spark, d):
    """One row per order: features from the order's lines and parts, the target from its total price."""
    lines = t.table(spark, d, "lineitem").join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sums = lines.groupBy("l_orderkey").agg(
        F.avg("p_size").alias("part_size"), F.avg("p_retailprice").alias("part_price"), F.sum("l_quantity").alias("quantity")
    )
    orders = t.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.month("o_orderdate").cast("double").alias("month"), F.log1p("o_totalprice").alias("target"))
    return orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


def parts(spark, d):
    rows_ = settle(split.stratified_split(settle(price_rows(spark, d)), 20, 42, "o_orderkey", "o_orderpriority"))
    return rows_.filter(~F.col("is_test")).drop("is_test"), rows_.filter("is_test").drop("is_test")


SMALL = models.BoostParams(trees=5, depth=3, rate=0.2, row_fraction=0.8, column_fraction=0.8)


@query("m1_fit_boosted")
def m1(spark, d):
    train, test = parts(spark, d)
    weighted = settle(weights.density_weight(train, "target", 0.5))
    model = models.fit_boosted(weighted, FEATURES, "target", "weight", SMALL)
    return model.transform(models.numbers_only(test, FEATURES)).select("o_orderkey", "target", "prediction")


def stump_rows(spark, d):
    """Two features of few values, so that every value is a split candidate, and a weight per order."""
    rows_ = price_rows(spark, d).withColumns({"tens": F.floor(F.col("quantity") / 10).cast("double"), "weight": (F.col("o_orderkey") % 3 + 1).cast("double")})
    return rows_.select("o_orderkey", "o_orderpriority", "month", "tens", "weight", "target")


@query(
    "m1_weighted_stump",
    f"""WITH q AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
    e AS (SELECT o_orderkey, o_orderpriority, month(o_orderdate)::DOUBLE AS month, floor(quantity / 10)::DOUBLE AS tens, o_orderkey % 3 + 1 AS w, ln(1 + o_totalprice) AS y FROM orders JOIN q ON o_orderkey = l_orderkey),
    {split_ctes('one', 'e', 20, "md5('42' || o_orderkey)", 'o_orderkey', 'o_orderpriority')},
    tr AS (SELECT * FROM one WHERE NOT is_test), f AS (SELECT 0 AS k, month AS v, y, w FROM tr UNION ALL SELECT 1, tens, y, w FROM tr),
    h AS (SELECT k, v, sum(w) AS sw, sum(w * y) AS sy FROM f GROUP BY k, v),
    r AS (SELECT k, v, sum(sw) OVER o AS wl, sum(sy) OVER o AS yl, sum(sw) OVER (PARTITION BY k) AS wt, sum(sy) OVER (PARTITION BY k) AS yt FROM h WINDOW o AS (PARTITION BY k ORDER BY v)),
    b AS (SELECT k, v, yl / wl AS low, (yt - yl) / (wt - wl) AS high FROM r WHERE wt > wl ORDER BY yl * yl / wl + (yt - yl) * (yt - yl) / (wt - wl) DESC LIMIT 1)
    SELECT o_orderkey, round(CASE WHEN (CASE k WHEN 0 THEN month ELSE tens END) <= v THEN low ELSE high END, 6) AS prediction FROM one, b WHERE is_test""",
)
def m1_stump(spark, d):
    """One weighted tree of one split has a closed form: the split of least weighted variance, and the means beside it."""
    split_rows = settle(split.stratified_split(stump_rows(spark, d), 20, 42, "o_orderkey", "o_orderpriority"))
    train, test = split_rows.filter(~F.col("is_test")), split_rows.filter("is_test")
    model = models.fit_boosted(train, ["month", "tens"], "target", "weight", models.BoostParams(trees=1, depth=1))
    return model.transform(models.numbers_only(test, ["month", "tens"])).select("o_orderkey", t.r6(F.col("prediction")).alias("prediction"))


@query("m2_random_search")
def m2(spark, d):
    train, _ = parts(spark, d)
    tried = [SMALL, models.BoostParams(trees=3, depth=4, rate=0.1)]
    _, table = models.random_search(train, FEATURES, "target", "o_orderkey", k=2, candidates=tried)
    return table


@query("m3_alpha_sweep")
def m3(spark, d):
    train, test = parts(spark, d)

    def fit(rows_, weight):
        return models.fit_boosted(rows_, FEATURES, "target", weight)

    sweep, _ = models.alpha_sweep(train, test, FEATURES, "target", models.PRECIPITATION_ALPHAS, fit)
    best = models.best_alpha(sweep, "testMAE").select(F.col("alpha").alias("best_alpha"))
    return sweep.withColumn("is_best", F.col("alpha") == best.scalar())


@query("m4_fit_forest_cascade")
def m4(spark, d):
    train, test = parts(spark, d)
    cascade = models.fit_forest_cascade(train, FEATURES, "target", "o_orderkey", max_layers=2, forests=2, trees=5, depth=4, k=2)
    return cascade.transform(test).select("o_orderkey", "target", "prediction")


HELD_SQL = f"""WITH e AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey)),
  {split_ctes('one', 'e', 20, "md5('42' || o_orderkey)", 'o_orderkey', 'o_orderpriority')}
  SELECT o_orderkey, TRUE AS same FROM one WHERE is_test"""


@query("m5_score", HELD_SQL)
def m5(spark, d):
    """Scores of the held-out rows beside what the predictions give by the rule: back from the log scale, not below 0."""
    train, test = parts(spark, d)
    model = models.fit_boosted(train, FEATURES, "target", None, SMALL)
    kept = settle(model.transform(models.numbers_only(test, FEATURES)).select("o_orderkey", "prediction"))
    scored = models.score(test, model, FEATURES).select("o_orderkey", "score").join(kept, "o_orderkey")
    return scored.select("o_orderkey", (F.col("score") == F.greatest(F.expm1("prediction"), F.lit(0.0))).alias("same"))


@query("m6_save_load_model", HELD_SQL)
def m6(spark, d):
    """Whether each held-out row's prediction after saving and loading the model is the one before."""
    train, test = parts(spark, d)
    root = fresh_path(spark, "models")
    model = models.fit_boosted(train, FEATURES, "target", None, SMALL)
    store.save_model(model, root, "price", rows.select_features(train, FEATURES))
    names = store.load_signature(spark, root, "price").names
    before = models.score(test, model, FEATURES).select("o_orderkey", F.col("score").alias("before"))
    after = models.score(test, store.load_model(root, "price"), names).select("o_orderkey", "score")
    return before.join(after, "o_orderkey").select("o_orderkey", (F.col("before") == F.col("score")).alias("same"))
