"""Conversation structure repair: the cheapest edits by a dynamic program that keeps its backward costs at checkpoints only."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.taskcontext import TaskContext

from gridloom.llm.text import give_back
from gridloom.session import lookup_join, settle

WHITE = r"\x20\x09-\x0D"

# Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
FAR = 1 << 60

# Characters of repaired text in one row, where a conversation is in more than one partition.
CHUNK = 1 << 20

# What has been given out: nothing, a system row, a user row, an assistant row. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (START, ASSISTANT)

# The only row that an inserted or rerolled one can be in each state, and the state after it.
ASKED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}

# Rows by the initial of their role; a row of another initial cannot be kept.
KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
OTHER = 0
FOLLOWS = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
LEGAL = {"su", "ua", "au"}

Costs = tuple[int, int, int, int]


class Row(NamedTuple):
    """A row of which ``n`` equal ones stand side by side; ``gone`` if even the first must be deleted."""

    role: str
    text: str | None
    n: int
    gone: bool
    truncated: bool


def with_inserts(costs: list[int]) -> Costs:
    """Costs to the end where rows may be inserted first: two at most are of use."""
    out = []
    for s in STATES:
        one, two = ASKED[s], ASKED[ASKED[s]]
        out.append(min(costs[s], INSERT + costs[one], 2 * INSERT + costs[two], FAR))
    return tuple(out)


END: Costs = with_inserts([0 if s in ENDS else FAR for s in STATES])


def edits(kind: int, truncated: bool, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of what can be done with a row, without insertions."""
    stays = TRUNCATED * truncated
    found = [("D", DELETE, state)]
    if (state, kind) in FOLLOWS:
        found.append(("K", stays, kind))
    found.append(("R", REROLE + stays, ASKED[state]))
    return found


EDITS = {(k, t): [edits(k, t, s) for s in STATES] for k in (OTHER, SYSTEM, USER, ASSISTANT) for t in (False, True)}


def before(live: tuple[int, bool], after: Costs) -> Costs:
    """Costs to the end from before a row, for each state, given those after it."""
    return with_inserts([min(cost + after[to] for _, cost, to in EDITS[live][s]) for s in STATES])


def backward(rows: list[tuple[int, bool]], end: Costs) -> Costs:
    """Costs from before the first row: only one vector is held."""
    for live in reversed(rows):
        end = before(live, end)
    return end


def tight(rows: list[tuple[int, bool]], state: int, end: Costs) -> Iterator[str]:
    """For each row the initials of its edits (insertions before it first), of all cheapest the ASCII-least.

    Backward costs are stored at every square root of the rows only; between two of these they are computed again
    while walking forward. The least initial among the edits that lose nothing is taken; it determines the next state.
    """
    step = max(1, math.isqrt(len(rows)))
    marks = {len(rows): end}
    costs = end
    for i in range(len(rows) - 1, -1, -1):
        costs = before(rows[i], costs)
        if i % step == 0:
            marks[i] = costs
    for low in range(0, len(rows), step):
        high = min(low + step, len(rows))
        block = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            block.append(before(rows[i], block[-1]))
        for i in range(low, high):
            now, after = block[high - i], block[high - i - 1]
            done = ""
            while True:
                options = [e for e in EDITS[rows[i]][state] if e[1] + after[e[2]] == now[state]]
                if INSERT + now[ASKED[state]] == now[state]:
                    options.append(("I", INSERT, ASKED[state]))
                edit, _, to = min(options)
                done, state = done + edit, to
                if edit != "I":
                    break
            yield done


def state_after(rows: list[tuple[int, bool]], done: list[str], state: int) -> int:
    for (kind, _), edits_ in zip(rows, done, strict=True):
        for e in edits_:
            state = kind if e == "K" else state if e == "D" else ASKED[state]
    return state


def last_inserts(state: int, end: Costs) -> tuple[str, int]:
    """Insertions after the last row."""
    done = ""
    while end[state]:
        done, state = done + "I", ASKED[state]
    return done, state


def live_rows(rows: list[Row]) -> list[tuple[int, bool]]:
    """What the program looks at: rows that are no blank or duplicate; all others are deleted whatever the state."""
    return [(KINDS.get(r.role[:1], OTHER), r.truncated) for r in rows if not r.gone]


def repaired(rows: list[Row], done: list[str], state: int) -> Iterator[tuple[str, str]]:
    """(edits, repaired text) of each row in order; a text is ``role:text`` of what it leaves, each after a line feed."""
    at = iter(done)
    for r in rows:
        if r.gone:
            yield "D" * r.n, ""
            continue
        edits_, out = next(at), []
        for e in edits_:
            if e == "K":
                state = KINDS[r.role[:1]]
                out.append(f"\n{r.role}:{r.text}")
            elif e != "D":
                state = ASKED[state]
                out.append(f"\n{NAMES[state]}:{r.text if e == 'R' else ''}")
        yield edits_ + "D" * (r.n - 1), "".join(out)


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``_conv``, ``_turn``, ``role``, ``text`` and ``n`` (1, or 2 where a row is repeated) after the damage; null roles and texts are one space."""
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn)]
    fault = F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")), F.lit(20))
    names, said = F.coalesce(F.col(f"`{role}`"), F.lit(" ")), F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    marked = rows.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("_turn"), names.alias("role"), said.alias("text"), fault.alias("_f"))
    return marked.filter("_f <> 0").select(
        "_conv", "_turn", F.when(F.col("_f") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_f") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number ``n``, and the faults of the first of them: ``blank``, ``again`` (its role and text
    stand in an earlier turn) and ``truncated``."""
    own = rows.groupBy("_conv", "_turn", "role", "text").agg(F.sum("n").alias("n"))
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    own = own.withColumn("_same", same)
    # a struct orders a null turn first, as the rows are
    first = own.groupBy("_conv", "_same").agg(F.min(F.struct("_turn")).alias("_first")).select(F.col("_conv").alias("_c"), F.col("_same").alias("_s"), "_first")
    joined = own.join(first, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_same") == F.col("_s")))
    blank = ~F.col("text").rlike(f"[^{WHITE}]")
    again = ~blank & (F.struct("_turn") > F.col("_first"))
    cut = ~blank & ~again & ~F.col("text").rlike(rf"[.!?][{WHITE}]*\z")
    return joined.select("_conv", "_turn", "role", "text", "n", blank.alias("blank"), again.alias("again"), cut.alias("truncated"))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[object, Row]]:
    columns = [batch.column(c).to_pylist() for c in ("_conv", "role", "text", "n", "gone", "truncated")]
    for conv, *rest in zip(*columns, strict=True):
        yield conv, Row(*rest)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Row]]]:
    """The rows of one conversation after another, as they lie in a partition."""
    conv, rows = None, []
    for batch in batches:
        for c, row in rows_of(batch):
            if rows and c != conv:
                yield conv, rows
                rows = []
            conv = c
            rows.append(row)
    if rows:
        yield conv, rows


def illegal_in(rows: list[Row]) -> int:
    """Neighbours whose initials are not legal; equal ones never are."""
    pairs = sum(a.role[:1] + b.role[:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    return pairs + sum(r.n - 1 for r in rows)


class Piece(NamedTuple):
    """What one partition has of a conversation that is in others too: the costs after it, the state before it, whether it
    is the first or the last one, and 1 if its first row and the one before it are no legal neighbours."""

    end: Costs = END
    state: int = START
    first: bool = True
    last: bool = True
    joint: int = 0


def mapped(ordered: DataFrame, fields: str, run) -> DataFrame:
    """``run(part, batches)`` on each partition of the ordered rows; it gives dictionaries of ``_conv`` and ``fields``."""
    schema = T.StructType([ordered.schema["_conv"], *T.StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in run(TaskContext.get().partitionId(), batches):
            yield pa.RecordBatch.from_pylist([row], schema=arrow)
        give_back()

    return ordered.mapInArrow(each, schema)


def spread_conversations(ordered: DataFrame) -> dict[tuple[int, object], Piece]:
    """The pieces of conversations that are in more than one partition, by partition and conversation. A partition has two
    such pieces at most, its first and its last conversation; so many rows pass the driver.

    A piece is four vectors, one for each state after it; multiplied from the last piece to the first they give the costs
    after each piece, and with these each piece tells in which state it ends, for each state before it.
    """
    slim = ordered.select("_conv", "role", F.lit(None).cast("string").alias("text"), "n", "gone", "truncated")

    def ends(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        kept: list = []
        for conv, rows in runs(batches):
            kept = [*kept[:1], (conv, rows)]
        for conv, rows in kept:
            units = [backward(live_rows(rows), tuple(0 if s == to else FAR for s in STATES)) for to in STATES]
            yield {"_conv": conv, "part": part, "costs": [units[to][s] for s in STATES for to in STATES], "first": rows[0].role[:1], "last": rows[-1].role[:1]}

    found: dict[object, list] = {}
    for r in sorted(mapped(slim, "part int, costs array<bigint>, first string, last string", ends).collect(), key=lambda r: r["part"]):
        found.setdefault(r["_conv"], []).append(r)
    spread = {conv: rows for conv, rows in found.items() if len(rows) > 1}
    if not spread:
        return {}
    after: dict[tuple[int, object], Costs] = {}
    for conv, rows in spread.items():
        end = END
        for r in reversed(rows):
            after[r["part"], conv] = end
            end = tuple(min(FAR, *(r["costs"][4 * s + to] + end[to] for to in STATES)) for s in STATES)

    def exits(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, rows in runs(batches):
            if (part, conv) in after:
                live, end = live_rows(rows), after[part, conv]
                yield {"_conv": conv, "part": part, "exits": [state_after(live, list(tight(live, s, end)), s) for s in STATES]}

    leaves = {(r["part"], r["_conv"]): r["exits"] for r in mapped(slim, "part int, exits array<int>", exits).collect()}
    out = {}
    for conv, rows in spread.items():
        state = START
        for i, r in enumerate(rows):
            joint = int(i > 0 and rows[i - 1]["last"] + r["first"] not in LEGAL)
            out[r["part"], conv] = Piece(after[r["part"], conv], state, i == 0, i == len(rows) - 1, joint)
            state = leaves[r["part"], conv][state]
    return out


def edited(ordered: DataFrame) -> DataFrame:
    """For each conversation, or each chunk of one that is in several partitions: ``audit``, ``cost``, ``illegal`` and ``sha`` of
    the repaired text; chunks have their place (``part``, ``k``) and their ``text`` instead of ``sha``."""
    spread = spread_conversations(ordered)

    def run(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, rows in runs(batches):
            piece = spread.get((part, conv))
            own, live = piece or Piece(), live_rows(rows)
            done = list(tight(live, own.state, own.end))
            inserts, _ = last_inserts(state_after(live, done, own.state), END) if own.last else ("", 0)
            row = {"_conv": conv, "part": part, "k": 0, "cost": 0, "illegal": illegal_in(rows) + own.joint, "sha": None, "text": None}
            audit, texts, held, digest = [], [], 0, hashlib.sha256()
            fresh = own.first  # the line feed before the first row of all is left out
            for r, (edits_, text) in zip(rows, repaired(rows, done, own.state)):
                row["cost"] += DELETE * edits_.count("D") + INSERT * edits_.count("I") + REROLE * edits_.count("R")
                row["cost"] += TRUNCATED * (r.truncated and not r.gone and ("K" in edits_ or "R" in edits_))
                audit.append(edits_)
                if piece is None:
                    digest.update((text[1:] if fresh and text else text).encode())
                else:
                    texts.append(text)
                    held += len(text)
                    if held > CHUNK:
                        yield row | {"audit": "".join(audit), "text": "".join(texts)}
                        audit, texts, held = [], [], 0
                        row |= {"k": row["k"] + 1, "cost": 0, "illegal": 0}
                fresh = fresh and not text
            state = state_after(live, done, own.state)
            tail = []
            for _ in inserts:
                state = ASKED[state]
                tail.append(f"\n{NAMES[state]}:")
            row["cost"] += INSERT * len(inserts)
            if piece is None:
                text = "".join(tail)
                digest.update((text[1:] if fresh else text).encode())
                yield row | {"audit": "".join([*audit, inserts]), "sha": digest.hexdigest()}
            else:
                yield row | {"audit": "".join([*audit, inserts]), "text": "".join([*texts, *tail])}

    return mapped(ordered, "part int, k int, audit string, cost long, illegal long, sha string, text string", run)


def put_together(chunks: DataFrame) -> DataFrame:
    """Conversations from their chunks, one chunk in memory at a time: SHA-256 needs a text from its beginning to its end."""

    def run(_: int, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, row = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if row is None or r["_conv"] != conv:
                    if row:
                        yield row | {"audit": "".join(row["audit"]), "sha": digest.hexdigest()}
                    conv, fresh, digest = r["_conv"], True, hashlib.sha256()
                    row = {"_conv": conv, "audit": [], "cost": 0, "illegal": 0}
                row["audit"].append(r["audit"])
                row["cost"] += r["cost"]
                row["illegal"] += r["illegal"]
                text = r["text"]
                digest.update((text[1:] if fresh and text else text).encode())
                fresh = fresh and not text
        if row:
            yield row | {"audit": "".join(row["audit"]), "sha": digest.hexdigest()}

    ordered = chunks.repartition("_conv").sortWithinPartitions("_conv", "part", "k")
    return mapped(ordered, "audit string, cost long, illegal long, sha string", run)


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = False) -> DataFrame:
    """One row per conversation: ``_conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows of a conversation are taken by turn, null turns first; rows of one turn by role and text, so ties have one
    order, and equal rows stand side by side. Null roles and texts are one space. A null conversation is one of its
    own. ``damage`` damages the rows first, by a hash of conversation and turn; a conversation of which nothing is left has
    zeros, an empty audit and the hash of an empty text. An empty table gives an empty one; further columns are not
    looked at.

    Rows are dealt by ranges of conversation and turn, so a very long conversation lies in many partitions. Equal
    rows are counted, not repeated. A task holds the part of one conversation that is in its partition.
    """
    if damage:
        rows = damaged(conversations, conv, turn, role, text)
    else:
        names, said = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text")))
        rows = conversations.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("_turn"), names, said, F.lit(1).cast("long").alias("n"))
    faults = judged(rows).withColumn("gone", F.col("blank") | F.col("again"))
    order = ["_conv", "_turn", "role", "text"]
    ordered = settle(faults.repartitionByRange(*order).sortWithinPartitions(*order))

    spread = F.max("_turn") - F.min("_turn") + 1 - F.countDistinct("_turn")
    repeats = F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1)
    sums = [F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"), F.sum(repeats).alias("duplicate"), F.sum(F.col("truncated").cast("long")).alias("truncated")]
    counts = ordered.groupBy("_conv").agg(F.coalesce(spread, F.lit(0)).alias("gaps"), *sums)

    done = settle(edited(ordered))
    whole = done.filter("sha IS NOT NULL").select("_conv", "audit", "cost", "illegal", "sha")
    joined = whole.unionByName(put_together(done.filter("sha IS NULL").select("_conv", "part", "k", "audit", "cost", "illegal", "text")))
    out = conversations.select(F.col(f"`{conv}`").alias("_conv")).distinct()
    out = lookup_join(lookup_join(out, counts, ["_conv"]), joined, ["_conv"])
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("_conv", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
