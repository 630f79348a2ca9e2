"""Repair of conversations by depth-first branch and bound.

The rows of a conversation are edited so that their roles read ``(s?(ua)+)?`` by initials: an optional system row, then user and
assistant in turn. The cheapest edits are sought, and of equally cheap ones those whose initials come first as text.

A search node is a row and a state (nothing yet, after s, after u, after a). Prefixes of repairs are extended from an explicit stack, the
most promising edit first. A prefix goes when its cost and a lower bound for the rest of the rows exceed the incumbent, or reach it with a later audit,
or when the dominance table of its node holds one that is cheaper, or as cheap and before it as text; both orders stay the same under
any common continuation, since no audit of a node begins with another one as cheap. The incumbent left when the stack is empty is proved best.

A conversation can be of any length. Rows are put in order by range, so a long one spreads over many tasks, and cut into pieces of a bounded
number of rows. A piece is solved from every state to every state; the solutions of a conversation's pieces are then joined in order, and
the repaired text is hashed piece by piece. Most conversations are one piece and are finished where they lie.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import CRC32_SQL, crc32_sql, pick, table
from gradlake.session import materialise

#: White space, and the signs that end a sentence. Fixed values.
SPACE = b" \t\n\x0b\x0c\r"
ENDS = b".!?"
#: The four kinds of damage among so many remainders of a row's hash.
REMAINDERS = 20
DROPPED, EMPTIED, UNENDED, REPEATED, AS_USER = range(5)
#: Costs of the edits, and of leaving a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of a repaired prefix; it may end in EMPTY or PAIRED.
EMPTY, SYSTEM, ASKED, PAIRED = range(4)
#: Where an initial leads from each state.
STEPS = {"s": (SYSTEM, None, None, None), "u": (ASKED, ASKED, None, ASKED), "a": (None, None, PAIRED, None)}
#: The role that may follow each state.
FOLLOWS = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
#: Rows and bytes of text of a piece; a longer single text stands alone.
PIECE_ROWS, PIECE_BYTES = 256, 1 << 20


def suffix_bounds(rows: list[tuple[str, int, bool, bool]], goals: tuple[int, ...]) -> list[list[float]]:
    """For every row and state, a cost that the edits of the rest cannot stay below if the states are to end in ``goals``."""

    def with_inserts(costs: list[float]) -> list[float]:
        for _ in range(2):
            costs = [min(c, INSERT + costs[STEPS[FOLLOWS[state]][state]]) for state, c in enumerate(costs)]
        return costs

    after = with_inserts([0 if state in goals else math.inf for state in range(4)])
    found = [after]
    for initial, times, gone, truncated in reversed(rows):
        costs = []
        for state in range(4):
            least = DELETE + after[state]
            if not gone:
                kept = STEPS[initial][state] if initial in STEPS else None
                least = min(least, TRUNCATED * truncated + min(REROLE + after[STEPS[FOLLOWS[state]][state]], math.inf if kept is None else after[kept]))
            costs.append(least + DELETE * (times - 1))
        after = with_inserts(costs)
        found.append(after)
    found.reverse()
    return found


def search(rows: list[tuple[str, int, bool, bool]], start: int, goals: tuple[int, ...], bounds: list[list[float]]) -> tuple[int, str, int] | None:
    """The cheapest repair from state ``start`` to one of ``goals``, of equally cheap ones the first as text: cost, audit and end state.

    A row is (initial, times, gone, truncated): it occurs ``times`` times, of which all but the first must be deleted, and with ``gone`` the first too.
    """
    n = len(rows)
    best: tuple[int, str, int] | None = None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bounds[i][state]
        if least == math.inf or best is not None and (least > best[0] or least == best[0] and audit > best[1][: len(audit)]):
            continue
        known = seen.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        seen[i, state] = cost, audit
        if i == n and state in goals and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, state
        after = STEPS[FOLLOWS[state]][state]
        following = [(i, after, cost + INSERT, "I")]
        if i < n:
            initial, times, gone, truncated = rows[i]
            base, tail = cost + DELETE * (times - 1), "D" * (times - 1)
            following.append((i + 1, state, base + DELETE, "D" + tail))
            if not gone:
                base += TRUNCATED * truncated
                following.append((i + 1, after, base + REROLE, "R" + tail))
                kept = STEPS[initial][state] if initial in STEPS else None
                if kept is not None:
                    following.append((i + 1, kept, base, "K" + tail))
        # the last one on the stack is tried first: the lowest bound, then the first as text
        following.sort(key=lambda f: (f[2] + bounds[f[0]][f[1]], f[3]), reverse=True)
        stack.extend((j, to, c, audit + edits) for j, to, c, edits in following)
    return best


def apply(audit: str, rows: list[tuple[str, str, int]], state: int) -> str:
    """The repaired rows ``role:text``, each ended by a newline; ``rows`` are (role, text, times)."""
    out, at, skip = [], 0, 0
    for edit in audit:
        if edit == "I":
            role = FOLLOWS[state]
            out.append(f"{ROLES[role]}:\n")
            state = STEPS[role][state]
            continue
        if skip:
            skip -= 1
            continue
        role, text, times = rows[at]
        at, skip = at + 1, times - 1
        if edit == "D":
            continue
        initial = FOLLOWS[state] if edit == "R" else role[:1]
        out.append(f"{ROLES[initial] if edit == 'R' else role}:{text}\n")
        state = STEPS[initial][state]
    return "".join(out)


def blank_and_truncated(text: str) -> tuple[bool, bool]:
    stripped = text.encode().strip(SPACE)
    return not stripped, bool(stripped) and stripped[-1] not in ENDS


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv``, ``turn``, ``role``, ``text``) with planted faults, each by the crc32 of ``conv:turn``: ``times`` is 0 for a dropped row and doubled for a repeated one."""
    key = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % REMAINDERS
    text = F.when(kind.isin(DROPPED, EMPTIED), "").when(kind == UNENDED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(kind == DROPPED, 0).when(kind == REPEATED, 2).otherwise(1) * F.col("times")
    return rows.select("conv", "turn", F.when(kind == AS_USER, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("times"))


def ordered_pieces(rows: DataFrame) -> DataFrame:
    """Pieces of conversations: ``conv``, ``piece`` (ascending along a conversation) and the arrays ``turn``, ``role``, ``text``, ``times`` in order.

    Rows go by turn (null first), ties by role, the first 32 characters of the text, and its digest; a conversation lies in neighbouring tasks and is cut after ``PIECE_ROWS`` rows or ``PIECE_BYTES``.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # whole texts would make the sampled bounds large, so ties of the first letters go by a digest
    order = [F.col("conv"), F.col("turn"), F.col("role"), F.substring("text", 1, 32), F.md5(F.col("text").cast("binary"))]
    placed = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "times")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        size, own, done = 0, None, []

        def flush():
            nonlocal held, size, number
            if held:
                conv = held[0][0]
                done.append((conv, base + number, *(list(c) for c in list(zip(*held, strict=True))[1:])))
                number += 1
            held, size = [], 0

        def out():
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv", "piece", "turn", "role", "text", "times"])

        types = None
        for batch in batches:
            kind = {n: batch.schema.field(n).type for n in ("conv", "turn", "times")}
            types = [kind["conv"], pa.int64(), pa.list_(kind["turn"]), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(kind["times"])]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != own or len(held) >= PIECE_ROWS or size > PIECE_BYTES:
                    flush()
                    if sum(map(len, done)) > 4096:
                        yield out()
                own = row[0]
                held.append(row)
                size += len(row[3])
            if done:
                yield out()
        flush()
        if done:
            yield out()

    schema = f"conv {kinds['conv']}, piece bigint, turn array<{kinds['turn']}>, role array<string>, text array<string>, times array<{kinds['times']}>"
    return placed.mapInArrow(run, schema)


def key_of(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def key_column(role: Column, text: Column) -> Column:
    """The digest of :func:`key_of`."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def earlier_rows(pieces: DataFrame) -> DataFrame:
    """``piece`` and ``earlier``: digests of those of its rows (role and text) that an earlier piece of the conversation holds.

    Only conversations of several pieces take part, with one row for a text and piece, however often it occurs.
    """
    several = pieces.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("own"))
    some = pieces.join(several, F.col("conv").eqNullSafe(F.col("own")), "semi")
    cells = some.select("conv", "piece", F.explode(F.arrays_zip("role", "text", "times")).alias("r")).filter("r.times > 0")
    keys = cells.select("conv", "piece", key_column(F.col("r.role"), F.col("r.text")).alias("key")).distinct()
    first = keys.groupBy("conv", "key").agg(F.min("piece").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("own"), F.col("key").alias("own_key"), "first")
    again = keys.join(first, F.col("conv").eqNullSafe(F.col("own")) & (F.col("key") == F.col("own_key"))).filter("piece > first")
    return again.groupBy("piece").agg(F.collect_list("key").alias("earlier"))


def solve_piece(turns, roles, texts, times, earlier, whole: bool) -> tuple:
    """What one piece says: its least and greatest turn and number of turns with its first and last turn, fault counts, illegal pairs, initials at its edges, best repairs."""
    rows, seen = [], set(earlier or ())
    blank = duplicate = truncated = illegal = 0
    before, initials = None, []
    present = []
    for turn, role, text, n in zip(turns, roles, texts, times, strict=True):
        if not n:
            continue
        present.append(turn)
        initial = role[:1]
        if before is not None:
            illegal += before + initial not in ("su", "ua", "au")
        illegal += (n - 1) * (initial + initial not in ("su", "ua", "au"))
        before = initial
        initials.append(initial)
        empty, cut = blank_and_truncated(text)
        key = key_of(role, text)
        again = key in seen
        seen.add(key)
        if empty:
            blank += n
        else:
            duplicate += n - 1 + again
            truncated += cut and not again
        rows.append((initial, n, empty or again, cut and not empty and not again))
    known = [t for t in present if t is not None]
    # first and last tell whether a turn goes on in the next piece
    turn = [min(known), max(known), len(set(known))] if known else []
    edges = [initials[0], initials[-1]] if initials else []
    costs: list = [None] * 16
    audits: list = [None] * 16
    for goals in ((EMPTY, PAIRED),) if whole else ((state,) for state in range(4)):
        bounds = suffix_bounds(rows, goals)
        for start in (EMPTY,) if whole else range(4):
            found = search(rows, start, goals, bounds)
            if found:
                costs[4 * start + found[2]], audits[4 * start + found[2]] = found[:2]
    return turn, blank, duplicate, truncated, illegal, edges, costs, audits


def kept_rows(roles, texts, times) -> list[tuple[str, str, int]]:
    return [r for r in zip(roles, texts, times, strict=True) if r[2]]


def gaps_of(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = False) -> DataFrame:
    """One row per conversation: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows go by turn, null first; ties by role and text (see :func:`ordered_pieces`). A row's first fault counts: blank (only white space), duplicate (role and text seen
    earlier), truncated (the last sign that is no white space is none of ``.!?``). ``illegal`` counts neighbours whose initials are not su, ua or au,
    ``gaps`` the numbers missing between the turns. Edits: Keep (0), Rerole to user or assistant (2), Delete (3; required for blank and duplicate
    rows), Insert an empty user or assistant row (2); a truncated row that stays adds 1. ``audit`` holds the initials of the cheapest edits
    after which the roles' initials read ``(s?(ua)+)?``, of equally cheap ones the first as text. ``repaired_sha256`` is that of the rows
    ``role:text`` left, joined by newlines. A null role or text is one space; rows of a null conversation are one conversation. ``damage``
    plants faults first (see :func:`damaged`); a conversation that loses all rows has zeros. Other columns are left out, whatever their names.
    """
    rows = pick(df, conv=conv, turn=turn, role=role, text=text)
    kind = rows.schema["conv"].dataType.simpleString()
    rows = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    # equal rows are counted, first per task
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("times"))
    pieces = materialise(ordered_pieces(damaged(rows) if damage else rows), "pieces")
    several = pieces.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("own"))
    marked = pieces.join(several, F.col("conv").eqNullSafe(F.col("own")), "left").withColumn("several", F.col("own").isNotNull() | F.col("conv").isNull()).drop("own")
    marked = marked.join(earlier_rows(pieces), "piece", "left")

    def solve(batches):
        names = ["turns", "blank", "duplicate", "truncated", "illegal", "edges", "costs", "audits"]
        types = [pa.list_(pa.int64()), *[pa.int64()] * 4, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string())]
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found, hashes = [], []
                for turns, roles, texts, times, more, earlier in zip(*(part.column(n).to_pylist() for n in ("turn", "role", "text", "times", "several", "earlier")), strict=True):
                    solved = solve_piece(turns, roles, texts, times, earlier, not more)
                    found.append(solved)
                    digest = None
                    if not more:
                        repaired = apply(next(a for a in solved[-1] if a is not None), kept_rows(roles, texts, times), EMPTY)
                        digest = hashlib.sha256(repaired[:-1].encode()).hexdigest()
                    hashes.append(digest)
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("conv"), part.column("piece"), part.column("several"), *columns, pa.array(hashes, pa.string())], ["conv", "piece", "several", *names, "digest"])

    solved = marked.select("conv", "piece", "turn", "role", "text", "times", "several", "earlier").mapInArrow(
        solve, f"conv {kind}, piece bigint, several boolean, turns array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, edges array<string>, costs array<bigint>, audits array<string>, digest string"
    )
    solved = materialise(solved, "solved")
    return finished(solved.filter("not several")).unionByName(joined(pieces, solved.filter("several"), kind)).withColumnRenamed("conv", conv)


def finished(solved: DataFrame) -> DataFrame:
    """The rows of conversations of one piece."""
    best = F.struct(*(F.coalesce(F.get(f"{c}s", F.lit(EMPTY)), F.get(f"{c}s", F.lit(PAIRED))).alias(c) for c in ("cost", "audit")))
    gaps = F.when(F.size("turns") == 0, F.lit(0).cast("bigint")).otherwise(F.get("turns", F.lit(1)) - F.get("turns", F.lit(0)) + 1 - F.get("turns", F.lit(2)))
    rows = solved.withColumn("best", best)
    return rows.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit", F.col("digest").alias("repaired_sha256"))


def joined(pieces: DataFrame, solved: DataFrame, kind: str) -> DataFrame:
    """The rows of conversations of several pieces: their solutions joined in order, then the repaired text hashed piece by piece.

    Tasks take one piece at a time; of a conversation they hold its four best repairs so far.
    """
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    route_schema = f"conv {kind}, piece bigint, state int, part string, {RESULT.rpartition(',')[0]}"

    def route(batches):
        own, state = None, None

        def close():
            """One row per piece with its start state and edits; the first also carries the figures of the conversation."""
            goal = min((g for g in (EMPTY, PAIRED) if state["best"][g] is not None), key=lambda g: state["best"][g][:2])
            cost, audit, path = state["best"][goal]
            audit = "".join([*state["settled"], audit])
            low, high, distinct = state["turns"]
            figures = [gaps_of(low, high, distinct), *state["counts"], cost, audit]
            steps = []
            while path is not None:
                steps.append(path[:3])
                path = path[3]
            rows = [(own, piece, start, part, *(figures if i == 0 else [None] * 7)) for i, (piece, start, part) in enumerate(reversed(steps))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], columns)

        columns = ["conv", "piece", "state", "part", *NAMES[:-1]]
        types = None
        for batch in batches:
            types = [batch.schema.field("conv").type, pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]
            for i in range(batch.num_rows):
                conv, piece, turns, blank, duplicate, truncated, illegal, edges, costs, audits = (batch.column(n)[i].as_py() for n in ("conv", "piece", "turns", "blank", "duplicate", "truncated", "illegal", "edges", "costs", "audits"))
                if state is None or conv != own:
                    if state is not None:
                        yield close()
                    own = conv
                    state = {"best": [(0, "", None), None, None, None], "turns": (None, None, 0), "counts": [0] * 4, "last": None, "settled": []}
                low, high, distinct = state["turns"]
                if turns:
                    state["turns"] = (turns[0], turns[1], turns[2]) if low is None else (low, turns[1], distinct + turns[2] - (turns[0] == high))
                over = bool(edges) and state["last"] is not None and state["last"] + edges[0] not in ("su", "ua", "au")
                state["last"] = edges[1] if edges else state["last"]
                state["counts"] = [a + b for a, b in zip(state["counts"], (blank, duplicate, truncated, illegal + over), strict=True)]
                best: list = [None] * 4
                came: list = [None] * 4
                for start, reached in enumerate(state["best"]):
                    for goal in range(4) if reached is not None else ():
                        if costs[4 * start + goal] is not None:
                            part = audits[4 * start + goal]
                            found = (reached[0] + costs[4 * start + goal], reached[1] + part, (piece, start, part, reached[2]))
                            if best[goal] is None or found[:2] < best[goal][:2]:
                                best[goal], came[goal] = found, start
                # what all repairs have in common is put aside, so that only the rest is compared and copied
                common = {c for c in came if c is not None}
                if len(common) == 1:
                    (only,) = common
                    before = state["best"][only][1]
                    state["settled"].append(before)
                    best = [b and (b[0], b[1][len(before) :], b[2]) for b in best]
                state["best"] = best
        if state is not None:
            yield close()

    placed = solved.repartition(tasks, "conv").sortWithinPartitions("conv", "piece")
    routes = materialise(placed.mapInArrow(route, route_schema), "routes")
    texts = pieces.join(routes.select(F.col("piece").alias("own"), "state", "part"), F.col("piece") == F.col("own"))

    def rewrite(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                roles, words, times, state, part = (batch.column(n)[i].as_py() for n in ("role", "text", "times", "state", "part"))
                whole = apply(part, kept_rows(roles, words, times), state).encode()
                yield pa.RecordBatch.from_arrays([batch.column("conv").slice(i, 1), batch.column("piece").slice(i, 1), pa.array([whole], pa.binary())], ["conv", "piece", "repaired"])

    def digest(batches):
        own, sha, held, kinds = None, None, b"", None
        for batch in batches:
            kinds = batch.schema.field("conv").type
            for i in range(batch.num_rows):
                conv, repaired = batch.column("conv")[i].as_py(), batch.column("repaired")[i].as_py()
                if sha is None or conv != own:
                    if sha is not None:
                        sha.update(held[:-1])
                        yield pa.RecordBatch.from_arrays([pa.array([own], kinds), pa.array([sha.hexdigest()])], ["conv", "repaired_sha256"])
                    own, sha, held = conv, hashlib.sha256(), b""
                if repaired:
                    # the last newline of all is left out
                    sha.update(held)
                    held = repaired
        if sha is not None:
            sha.update(held[:-1])
            yield pa.RecordBatch.from_arrays([pa.array([own], kinds), pa.array([sha.hexdigest()])], ["conv", "repaired_sha256"])

    rewritten = texts.select("conv", "piece", "role", "text", "times", "state", "part").mapInArrow(rewrite, f"conv {kind}, piece bigint, repaired binary")
    digests = rewritten.repartition(tasks, "conv").sortWithinPartitions("conv", "piece").mapInArrow(digest, f"conv {kind}, repaired_sha256 string")
    figures = routes.filter("cost is not null").select("conv", *NAMES[:-1])
    digests = digests.select(F.col("conv").alias("own"), "repaired_sha256")
    return figures.join(digests, F.col("conv").eqNullSafe(F.col("own"))).drop("own")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, some rows damaged, with their faults and the cheapest repair."""
    return repair(table(spark, sf_dir, "conversations"), damage=True)


def _cheapest(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _after(state: str, cost: str, edits: str, text: str = "''") -> str:
    """For DuckDB: a repair ``{c, a, t}`` (cost, audit, text) that goes on from another one."""
    return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || {edits}, t := {state}.t || {text})"


_KEEP, _USER, _ASSISTANT = "r.role || ':' || r.text || chr(10)", "'user:' || r.text || chr(10)", "'assistant:' || r.text || chr(10)"
_FAR = 1_000_000_000

OP13_SQL = rf"""
WITH RECURSIVE {CRC32_SQL},
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hashed AS ({crc32_sql("given", "key")}),
damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN h % 20 = 4 THEN 'user' ELSE role END AS role,
    CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 32), md5(text), copy) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged),
judged AS (
  SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faults AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
    before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM judged),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n FROM faults GROUP BY conv_id),
convs AS (SELECT DISTINCT conv_id FROM conversations),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, struct_pack(c := 0::BIGINT, a := '', t := '') AS e0, struct_pack(c := {_FAR}::BIGINT, a := '', t := '') AS e1,
    struct_pack(c := 2::BIGINT, a := 'I', t := 'user:' || chr(10)) AS e2, struct_pack(c := 4::BIGINT, a := 'II', t := 'user:' || chr(10) || 'assistant:' || chr(10)) AS e3 FROM convs
  UNION ALL
  SELECT conv_id, i, n0, n1, m2, {_cheapest("n3", _after("m2", "2", "'I'", "'assistant:' || chr(10)"))} FROM (
    SELECT *, {_cheapest("n2", *(_after(n, "2", "'I'", "'user:' || chr(10)") for n in ("n0", "n1", "n3")))} AS m2 FROM (
      SELECT s.conv_id, r.i, {_after("s.e0", "3", "'D'")} AS n0,
        {_cheapest(_after("s.e1", "3", "'D'"), _after("s.e0", "r.keep_s", "'K'", _KEEP))} AS n1,
        {_cheapest(_after("s.e2", "3", "'D'"), *(_after(f"s.e{k}", "r.keep_u", "'K'", _KEEP) for k in (0, 1, 3)), *(_after(f"s.e{k}", "r.rerole", "'R'", _USER) for k in (0, 1, 3)))} AS n2,
        {_cheapest(_after("s.e3", "3", "'D'"), _after("s.e2", "r.keep_a", "'K'", _KEEP), _after("s.e2", "r.rerole", "'R'", _ASSISTANT))} AS n3
      FROM steps s JOIN (
        SELECT *, CASE WHEN blank OR duplicate THEN {_FAR} ELSE 2 + truncated::INT END AS rerole,
          CASE WHEN blank OR duplicate OR left(role, 1) <> 's' THEN {_FAR} ELSE truncated::INT END AS keep_s,
          CASE WHEN blank OR duplicate OR left(role, 1) <> 'u' THEN {_FAR} ELSE truncated::INT END AS keep_u,
          CASE WHEN blank OR duplicate OR left(role, 1) <> 'a' THEN {_FAR} ELSE truncated::INT END AS keep_a FROM faults) r
      ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1)))
SELECT c.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate, coalesce(k.truncated, 0) AS truncated, coalesce(k.illegal, 0) AS illegal,
  {_cheapest("s.e0", "s.e3")}.c AS cost, {_cheapest("s.e0", "s.e3")}.a AS audit, sha256(left({_cheapest("s.e0", "s.e3")}.t, greatest(length({_cheapest("s.e0", "s.e3")}.t) - 1, 0))) AS repaired_sha256
FROM convs c LEFT JOIN counts k ON c.conv_id IS NOT DISTINCT FROM k.conv_id JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = coalesce(k.n, 0)
"""
