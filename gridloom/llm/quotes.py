"""Quotation linking of conversations: quoted passages are found by their normalised hash in earlier
messages, which gives the reply tree. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridloom.session import fresh_path, settle

# Turns of a conversation that one ordered pass looks at together.
SPAN = 256

# Fixed value: quote marks at the start of a line, each with at most one blank after it.
MARKS = r"^((?:>[ \t]?)+)"


def normalised(line: Column) -> Column:
    """Lower case, one space for any white space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def parsed(messages: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Messages with ``_lines`` (level, the number of quote marks; body; normalised body) and ``_units``: level and hash of each
    line and of each passage, the lines of one level in a row up to a blank one, joined."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 1)
        body = F.substring(x, F.length(marks) + 1, F.length(x))
        return F.struct(F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), body.alias("body"), normalised(body).alias("plain"))

    at = F.sequence(F.lit(0), F.size("_lines") - 1)

    def breaks(i: Column, other: Column) -> Column:
        here, beside = F.get("_lines", i), F.get("_lines", other)
        return (here["plain"] != "") & (beside.isNull() | (beside["level"] != here["level"]) | (beside["plain"] == ""))

    def passage(first: Column, last: Column) -> Column:
        own = F.transform(F.slice("_lines", first + 1, last - first + 1), lambda x: x["plain"])
        return F.struct(F.get("_lines", first)["level"].alias("level"), F.xxhash64(F.array_join(own, " ")).alias("hash"))

    single = F.transform(F.filter("_lines", lambda x: x["plain"] != ""), lambda x: F.struct(x["level"].alias("level"), F.xxhash64(x["plain"]).alias("hash")))
    joined = F.zip_with(F.filter(at, lambda i: breaks(i, i - 1)), F.filter(at, lambda i: breaks(i, i + 1)), passage)
    return messages.select(*keys, F.transform(lines, line).alias("_lines")).withColumn("_units", F.array_distinct(F.concat(single, joined)))


def latest_before(rows: DataFrame, by: list[str]) -> DataFrame:
    """For each row that asks, the last turn before its own of a row in the same group (``by``) that answers.

    ``rows`` has ``by``, ``turn`` and ``asks``. A group may be any size: turns are cut into spans of SPAN, an
    ordered pass runs inside each, and another over one row per span gives what lies in earlier spans.
    """
    spans = rows.withColumn("_span", F.floor(F.col("turn") / SPAN))
    answer = F.when(~F.col("asks"), F.col("turn"))
    inside = W.partitionBy(*by, "_span").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    over = W.partitionBy(*by).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    tops = spans.groupBy(*by, "_span").agg(F.max(answer).alias("_top")).withColumn("_earlier", F.max("_top").over(over)).drop("_top")
    near = spans.withColumn("_near", F.max(answer).over(inside)).filter("asks")
    return near.join(tops, [*by, "_span"]).withColumn("source", F.coalesce("_near", "_earlier")).drop("_near", "_earlier", "_span").filter("source IS NOT NULL")


def rooted(replies: DataFrame) -> DataFrame:
    """``thread`` (first message) and ``depth`` of every reply, by doubling of the steps taken at once."""
    now = settle(replies.select("_conv", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = now.select(F.col("_conv").alias("_c"), F.col("turn").alias("_t"), F.col("thread").alias("_up"), F.col("depth").alias("_more"))
        step = now.join(up, (F.col("_conv") == F.col("_c")) & (F.col("thread") == F.col("_t")), "left")
        step = step.select("_conv", "turn", F.coalesce("_up", "thread").alias("thread"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_up").isNotNull().alias("_moved"))
        now = settle(step)
        moved = now.filter("_moved").count()
        now = now.drop("_moved")
        if not moved:
            return now


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conversation, turn, role, ``text`` without quoted lines, ``n_quoted`` lines, ``max_level``,
    ``reply_to`` (turn, null if it answers no message by quotation), ``thread`` (turn of the first message of its chain
    of replies, its own if it answers none), ``depth`` and ``position``, its place in the reply-ordered conversation from 1.

    A line's level is the number of ``>`` marks before it. Each quoted line, and each quoted passage as its lines
    joined (so line breaks may differ), is looked up by the hash of its normalised form in earlier turns of the
    conversation, at one level less: what a message quotes at level two its parent quoted at level one. Only a message
    that finds nothing so is linked by its deeper quotes to the unquoted originals. Of the turns that have a line or passage
    the latest counts. A message replies to the turn that most of its lines and passages lead to, on a tie to the
    latest. Order by conversation, thread and turn puts each reply after what it answers.

    Messages equal in all four columns are one. Others with the same turn stay apart, and count as one place to
    reply to. Messages with a null conversation or turn are kept, have no position and neither quote nor are quoted. A
    null or empty text gives an empty one, with no lines quoted. Texts are never cut; an empty table gives an empty table.
    """
    named = messages.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("_text")).distinct()
    path = fresh_path(messages.sparkSession, "messages")
    parsed(named, ["_conv", "turn", "role"], "_text").select(
        "_conv", "turn", "role",
        F.array_join(F.transform(F.filter("_lines", lambda x: x.level == 0), lambda x: x.body), "\n").alias("text"),
        F.size(F.filter("_lines", lambda x: x.level > 0)).cast("long").alias("n_quoted"),
        F.array_max(F.transform("_lines", lambda x: x.level)).cast("long").alias("max_level"), "_units",
    ).write.parquet(path)
    told = messages.sparkSession.read.parquet(path)
    units = told.filter("_conv IS NOT NULL AND turn IS NOT NULL").select("_conv", "turn", F.explode("_units").alias("u")).select("_conv", "turn", "u.level", "u.hash")

    # where a unit is looked up: at one level less, or (second choice) unquoted
    above = F.struct((F.col("level") - 1).alias("at"), F.lit(1).alias("choice"))
    plain = F.when(F.col("level") > 1, F.struct(F.lit(0).alias("at"), F.lit(2).alias("choice")))
    asks = units.filter("level > 0").withColumn("w", F.explode(F.array_compact(F.array(above, plain))))
    asks = asks.select("_conv", "turn", F.xxhash64("hash", "w.at").alias("h"), "w.choice").groupBy("_conv", "turn", "h").agg(F.min("choice").alias("choice"))
    asked = asks.select("_conv", "h").distinct()
    has = units.select("_conv", "turn", F.xxhash64("hash", "level").alias("h")).distinct().join(asked, ["_conv", "h"], "left_semi")
    both = asks.withColumn("asks", F.lit(True)).unionByName(has.withColumns({"asks": F.lit(False), "choice": F.lit(0)}))
    found = latest_before(both, ["_conv", "h"])
    votes = found.groupBy("_conv", "turn", "choice", "source").agg(F.count("*").alias("n"))
    best = F.max(F.struct((-F.col("choice")).alias("first"), "n", "source")).alias("best")
    replies = settle(votes.groupBy("_conv", "turn").agg(best).select("_conv", "turn", F.col("best.source").alias("reply_to")))
    roots = rooted(replies).join(replies, ["_conv", "turn"])
    out = told.drop("_units").join(roots, ["_conv", "turn"], "left").withColumn("thread", F.coalesce("thread", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    out = with_position(out)
    return out.select(F.col("_conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), "text", "n_quoted", "max_level", "reply_to", "thread", "depth", "position")


def with_position(told: DataFrame) -> DataFrame:
    """Adds ``position``, from 1, in the order of thread and turn inside the conversation. Messages are ranked inside spans of
    threads; what lies in earlier spans is added up over one row per span."""
    spans = told.withColumn("_span", F.floor(F.col("thread") / SPAN))
    inside = W.partitionBy("_conv", "_span").orderBy("thread", "turn", "role", "text", "n_quoted", "max_level", "reply_to")
    over = W.partitionBy("_c").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    sizes = spans.filter("_span IS NOT NULL").groupBy(F.col("_conv").alias("_c"), F.col("_span").alias("_s")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(over), F.lit(0))).select("_c", "_s", "_before")
    joined = spans.withColumn("_rank", F.row_number().over(inside)).join(before, (F.col("_conv") == F.col("_c")) & (F.col("_span") == F.col("_s")), "left")
    return joined.withColumn("position", (F.col("_rank") + F.col("_before")).cast("long")).drop("_span", "_rank", "_before", "_c", "_s")


def in_reply_order(linked: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The messages sorted by conversation and position over all partitions; a long conversation may span several."""
    return linked.repartitionByRange(conv, "position").sortWithinPartitions(conv, "position")
