"""Conversation repair against a search over all edits, and conversations that lie in many partitions."""

import hashlib
import heapq
import random
import re
import zlib

from gridloom.llm import repair


def brute(rows, damage):
    """rows: (conv, turn, role, text); a best-first search over (cost, audit)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            role, text = " " if role is None else role, " " if text is None else text
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            own += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        # states by the initials given out so far: "" and "a" may end
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, state, text = heapq.heappop(heap)
            if i == len(own) and state in ("", "a"):
                break
            if (i, state) in done:
                continue
            done.add((i, state))
            asked = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            name = {"u": "user", "a": "assistant"}[asked]
            heapq.heappush(heap, (cost + 3, audit + "I", i, asked, (*text, f"{name}:")))
            if i < len(own):
                _, role, said = own[i]
                heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, text))
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 * (faults[i] == "truncated")
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, asked, (*text, f"{name}:{said}")))
                    if role[:1] and state + role[:1] in ("s", "u", "su", "ua", "au"):
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*text, f"{role}:{said}")))
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def conversations(draw, n, long=12):
    words = ["yes.", "no", "why?", "well then!", " ", "", "\n\t", "Ünï.", "a b c", "ok. \n"]
    rows = []
    for conv in range(n):
        for turn in range(draw.randint(1, long)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            if draw.random() < 0.1:
                continue
            rows.append((conv, draw.choice([turn, turn, turn, None, turn + 3]), role, draw.choice([*words, None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, n int")


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_against_a_search_over_all_edits(spark):
    draw = random.Random(5)
    rows = conversations(draw, 150) + [(None, 1, "user", "hello."), (None, 2, "assistant", "hi."), (7000, None, None, None), (7001, 0, "user", "x.")]
    rows += [(8000, 1, "user", "same.")] * 7
    for damage in (False, True):
        got = results(repair.repair(frame(spark, rows), damage=damage))
        assert got == brute(rows, damage)
    assert repair.repair(frame(spark, rows).limit(0), damage=True).count() == 0


def test_nothing_left_after_damage(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = results(repair.repair(frame(spark, [(conv, 0, "user", "x.")]), damage=True))
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_conversations_in_many_partitions(spark):
    """One conversation with most of the rows is dealt over all partitions and put together again."""
    draw = random.Random(6)
    rows = conversations(draw, 20) + [(5000, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", f"{t}.", f"{t}", "  "])) for t in range(3000)]
    rows += [(5001, t, draw.choice(["user", "assistant"]), f"{t}" + draw.choice([".", ""])) for t in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    chunk = repair.CHUNK
    try:
        repair.CHUNK = 100
        got = results(repair.repair(frame(spark, rows)))
    finally:
        repair.CHUNK = chunk
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows, False)


def test_checkpoints_do_not_change_the_edits():
    draw = random.Random(7)
    for n in (0, 1, 2, 3, 15, 16, 17, 200):
        rows = [(draw.choice([repair.OTHER, repair.SYSTEM, repair.USER, repair.ASSISTANT]), draw.random() < 0.3) for _ in range(n)]
        done = list(repair.tight(rows, repair.START, repair.END))
        state = repair.state_after(rows, done, repair.START)
        tail, state = repair.last_inserts(state, repair.END)
        assert state in repair.ENDS and len(done) == n
        cost = sum({"D": 4, "I": 3, "R": 3, "K": 0}[e] for e in "".join(done) + tail) + sum(3 for (_, t), e in zip(rows, done) if t and e[-1] != "D")
        assert cost == repair.backward(rows, repair.END)[repair.START]
