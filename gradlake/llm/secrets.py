"""Secret scans: plain patterns, and multipart credentials linked by joining intervals inside scopes.

Base patterns report on their own. Weak parts (an identifier, a secret-like value, an endpoint) mean little alone; one is reported
only where a part of another role lies in the same scope. A scope is a paragraph: the lines between two blank lines. A caller may ask
for parts at most ``reach`` characters apart. The join is a merge of the sorted intervals of one text, so it takes no more than sorting them.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import map_batches, pick, table

#: Base patterns in the order of their kinds. Fixed values.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "identifier", "value", "endpoint")

#: Weak parts: names of an account or key, long mixed strings, and places to log in.
IDENTIFIER = re.compile(r"(?i:\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@+/_.-]{3,})", re.ASCII)
VALUE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9._~:@\[\]-]+(?:/[^\s\"'<>]*)?|(?i:\b(?:host|endpoint|server))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._-]{3,}", re.ASCII)
BLANK = re.compile(r"\n[\x20\x09-\x0D]*\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, leftmost and without overlap within a kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def looks_random(value: str) -> bool:
    """Letters of both cases and digits, as in a generated key."""
    return any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)


def weak_parts(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of candidates that need a complement. What looks like a value inside an endpoint is a part of that endpoint."""
    found, starts, ends = [], [], []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), 3) for m in IDENTIFIER.finditer(text)]
        for m in ENDPOINT.finditer(text):
            found.append((m.start(), m.end(), 5))
            starts.append(m.start())
            ends.append(m.end())
    for m in VALUE.finditer(text):
        # endpoints do not overlap, so the last one that starts before the value ends is the only one that can reach into it
        k = bisect_left(starts, m.end()) - 1
        if looks_random(m[0]) and not (k >= 0 and ends[k] > m.start()):
            found.append((m.start(), m.end(), 4))
    return sorted(found)


#: The role of each kind: what names an account, what opens it, and where.
ROLE = {0: "secret", 1: "identifier", 2: "secret", 3: "identifier", 4: "secret", 5: "endpoint"}


def linked(base: list[tuple[int, int, int]], weak: list[tuple[int, int, int]], breaks: list[int], reach: float = math.inf) -> list[tuple[int, int, int]]:
    """The weak parts with a part of another role in their scope and within reach.

    ``breaks`` are the ends of scopes, ascending. Overlapping parts are one thing and no complement of each other; a weak part that
    overlaps a base span is already reported. Parts of a role are swept once by start and once by end, so the nearest one on each
    side is known without looking at pairs.
    """
    parts = sorted(base + weak)
    scope = [bisect_left(breaks, s) for s, _, _ in parts]
    near = [False] * len(parts)

    def sweep(order: list[int], forward: bool) -> None:
        edge: dict[str, tuple[int, int]] = {}
        waiting: list[int] = []
        for i in order:
            start, end, kind = parts[i]
            # what ends before this start (or starts after this end) may complement it
            while waiting and (parts[waiting[0]][1] <= start if forward else parts[waiting[0]][0] >= end):
                j = waiting.pop(0)
                edge[ROLE[parts[j][2]]] = (scope[j], parts[j][1] if forward else parts[j][0])
            for role, (s, place) in edge.items():
                if role != ROLE[kind] and s == scope[i] and abs((start if forward else end) - place) <= reach:
                    near[i] = True
            waiting.append(i)
            waiting.sort(key=lambda j: parts[j][1] if forward else -parts[j][0])

    sweep(list(range(len(parts))), True)
    sweep(sorted(range(len(parts)), key=lambda i: -parts[i][1]), False)
    covered = sorted((s, e) for s, e, _ in base)
    ends = []
    for _, e in covered:
        ends.append(max(e, ends[-1] if ends else 0))

    def overlaps_base(start: int, end: int) -> bool:
        k = bisect_left(covered, (end, 0))
        return k > 0 and ends[k - 1] > start

    return [p for p, ok in zip(parts, near, strict=True) if ok and p[2] >= 3 and not overlaps_base(p[0], p[1])]


def scan(text: str, reach: float = math.inf) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and the weak parts that complete one another or a base span."""
    base, weak = base_spans(text), weak_parts(text)
    if not weak or len(base) + len(weak) < 2:
        return base, []
    return base, linked(base, weak, [m.start() for m in BLANK.finditer(text)], reach)


def find_secrets(df: DataFrame, id_column: str = "doc_id", text: str = "text", reach: float = math.inf) -> DataFrame:
    """One row per text: the id, ``base`` and ``added`` as arrays of (start, end, kind), sorted by start and kind.

    Parts are joined over their whole scope unless ``reach`` says how many characters apart they may lie.

    Positions are code points, ends exclusive. A null text counts as empty; every input row gives one row, whatever its id; other
    columns are left out. A text is scanned whole.
    """
    rows = pick(df, **{"row": id_column, "text": text}).withColumn("text", F.coalesce("text", F.lit("")))
    kind = rows.schema["row"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def as_rows(spans):
        return [{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in spans]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, added = [], []
        for value in batch.column(1):
            found, more = scan(value.as_py(), reach)
            base.append(as_rows(found))
            added.append(as_rows(more))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(added, span)], [id_column, "base", "added"])

    spans = "array<struct<start: bigint, end: bigint, kind: string>>"
    return map_batches(rows, run, f"`{id_column}` {kind}, base {spans}, added {spans}")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans of every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def joined(spans):
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"), s["end"], s["kind"])))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
