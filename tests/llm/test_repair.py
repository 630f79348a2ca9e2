"""Conversation repair against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from gradlake.llm import repair
from tests.llm.test_llm import SF_DIR

LEGAL = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def planted(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def place(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text[:32].encode(), hashlib.md5(text.encode()).hexdigest())


def cheapest(rows):
    """Dijkstra over (cost, audit) with the repaired roles spelled out; no states, bounds or tables but the visited ones."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit, out
        if (i, roles) in seen:
            continue
        seen.add((i, roles))
        if len(roles) <= 2 * len(rows) + 2:
            for r in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, audit + "I", i, roles + r[0], (*out, f"{r}:")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, out))
        if fault in ("blank", "duplicate"):
            continue
        more = fault == "truncated"
        for c, edit, r in ((0, "K", role), (2, "R", "user"), (2, "R", "assistant")):
            # the initials must still be the beginning of a legal text
            if LEGAL.fullmatch(roles + r[:1]) or LEGAL.fullmatch(roles + r[:1] + "a") or LEGAL.fullmatch(roles + r[:1] + "ua"):
                heapq.heappush(heap, (cost + c + more, audit + edit, i + 1, roles + r[:1] if r else roles + "?", (*out, f"{r}:{text}")))


def brute(rows, damage=True):
    result = []
    after = planted(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=place)
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in own} - {None}
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = cheapest([(r[2], r[3], f) for r, f in zip(own, faults)])
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(result, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", *repair.NAMES).collect()), key=str)


def conversations(seed, n, most, roles=("system", "user", "assistant", "tool", "", "unknown", None)):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"][t % 2 :] + ["user", "assistant"] * 2 + list(roles)) if rng.random() < 0.6 else ("user", "assistant")[t % 2]
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t", None, f"Text {rng.randrange(9)}.", f"é {t} open\n", "End? \x0b"])
            rows.append((c, rng.choice([t, t, t, t + 3, None]), role, text))
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("damage", [True, False])
def test_repairs_equal_the_exhaustive_search(spark, damage):
    rows = conversations(5, 150, 7)
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "cut"), (900, None, None, None)] + [(901, 2, "user", "Same.")] * 6
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA + ", own int, piece string, TEXT string")
    assert found(repair.repair(df, damage=damage)) == brute(rows, damage)
    assert repair.repair(df.limit(0)).count() == 0


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE_ROWS", 3)
    rows = conversations(6, 40, 8) + [(None, t, "user", f"{t}.") for t in range(5)]
    rows += [(777, t // 2, ("user", "assistant", "user", "tool")[t % 4], ("Again.", "open", f"{t}.")[t % 3]) for t in range(18)]
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(repair.repair(df, damage=True)) == want


def test_one_conversation_of_many_rows(spark):
    texts = ["Yes.", "", "open"]
    rows = [(1, t, ("user", "assistant", "user")[t % 3], texts[t % 7] if t % 7 < 3 else f"Turn {t}.") for t in range(4000)]
    (row,) = found(repair.repair(spark.createDataFrame(rows, SCHEMA), damage=True))
    faults, seen, own = [], set(), sorted(planted(rows), key=place)
    for _, _, role, text in own:
        faults.append((role[0], 1, not text.strip() or (role, text) in seen, bool(text.strip()) and (role, text) not in seen and text.strip()[-1] not in ".!?"))
        seen.add((role, text))
    goals = (repair.EMPTY, repair.PAIRED)
    cost, audit, _ = repair.search(faults, repair.EMPTY, goals, repair.suffix_bounds(faults, goals))
    assert row[6:8] == (cost, audit) and len(audit) >= len(own)
    whole = repair.apply(audit, [(r[2], r[3], 1) for r in own], repair.EMPTY)
    assert row[8] == hashlib.sha256(whole[:-1].encode()).hexdigest()


def test_bounds_never_exceed_what_is_left():
    rng = random.Random(9)
    for _ in range(200):
        rows = [(rng.choice("suax"), rng.randint(1, 2), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 6))]
        goals = (repair.EMPTY, repair.PAIRED)
        bounds = repair.suffix_bounds(rows, goals)
        for i in range(len(rows) + 1):
            for state in range(4):
                best = repair.search(rows[i:], state, goals, [[0, 0, 0, 0]] * (len(rows) - i) + [bounds[-1]])
                assert best is not None and bounds[i][state] <= best[0]


def test_query_equals_the_exhaustive_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(repair.op13_repair(spark, SF_DIR)) == brute(rows)
