"""Packing of tokenized documents into sequences by a plan over the histogram of lengths.

Sequences have room for a fixed number of tokens, so there are no more lengths than that. How many pieces have each length is all that
best-fit-decreasing needs: it runs over counts, not over pieces. Sequences with equally much room left are ranges of numbers, a whole range is
filled in one step, and the plan is a list of such steps whose number depends on the room alone. A piece finds its place by its rank among
the pieces of its length. Ranks come from the counts of each task and length, so no length is ever gathered in one place.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradlake.llm.bpe import PIECES, byte_alphabet, default_tokenizer
from gradlake.llm.common import parts, pick, table
from gradlake.session import materialise

#: The contract: tokens of a sequence, and the token that ends a document.
ROOM, END = 2048, 0
#: Distinct pieces of text whose tokens a Python worker keeps (some 150 bytes each); a full cache starts anew.
CACHE_ENTRIES = 1 << 19
#: The letters and numbers up to U+00FF, the cuts of ``PIECES`` in terms of them, and what a text must not hold for that. Fixed values.
LETTERS, NUMBERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
NOT_LATIN = r"[^\x20-\x7e\n\t\r\xa1-\xff]"


class Ids(dict):
    """Token ids of a text by the ``tokenizers`` library, as packed little-endian unsigned 32-bit integers.

    With a plain byte-level vocabulary a text is cut as the library cuts it, and the ids of each distinct cut are asked for once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.plain = model["type"] == "BPE" and not spec.get("normalizer") and not model.get("dropout") and before.get("type") == "ByteLevel"
        self.plain = self.plain and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters = {b: c for c, b in byte_alphabet().items()}
        self.find, self.find_latin, self.odd = regex.compile(PIECES).findall, re.compile(LATIN_PIECES).findall, re.compile(NOT_LATIN).search
        self.model = self.library.model

    def __missing__(self, cut: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = self.model.tokenize(cut.encode().decode("latin-1").translate(self.letters))
        value = self[cut] = b"".join(t.id.to_bytes(4, "little") for t in found)
        return value

    def of(self, text: str) -> bytes:
        if self.plain and not any(t in text for t in self.added):
            # the same cuts, found three times as fast
            find = self.find if self.odd(text) else self.find_latin
            return b"".join(map(self.__getitem__, find(text)))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def ids_of(path: str | None) -> Ids:
    """The tokenizer of a worker process, loaded once."""
    return Ids(path or default_tokenizer())


def cuts(total: int, room: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: all of ``room`` tokens but the first, which may be shorter."""
    first = (total - 1) % room + 1
    return [(0, first), *((start, room) for start in range(first, total, room))]


def token_pieces(df: DataFrame, id_column: str = "doc_id", text: str = "text", room: int = ROOM, end: int = END, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its id, ``piece``, ``start``, ``length``, ``ids_crc32``, and ``part`` and ``slot``, which number the pieces of a length in a task.

    A document is its token ids and ``end``. ``with_ids`` adds ``token_ids`` (packed). Null texts are empty; rows with any id count.
    """
    rows = pick(df, row=id_column, text=text).select("row", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    stop = int(end).to_bytes(4, "little")
    names = ["row", "piece", "start", "length", "ids_crc32", "part", "slot"]

    def run(batches):
        own, part = ids_of(tokenizer), TaskContext.get().partitionId()
        slots = np.zeros(room + 1, np.int64)
        for batch in parts(batches, 1):
            place, found, packed = [], [], []
            for i, whole in enumerate(batch.column(1).to_pylist()):
                ids = memoryview(own.of(whole.decode()) + stop)
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, room)):
                    piece_ids = ids[4 * start : 4 * (start + length)]
                    place.append(i)
                    found.append((piece, start, length, zlib.crc32(piece_ids), part, slots[length]))
                    slots[length] += 1
                    if with_ids:
                        packed.append(bytes(piece_ids))
            columns = [batch.column(0).take(pa.array(place, pa.int64())), *(pa.array(c, pa.int64()) for c in zip(*found, strict=True))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(packed, pa.binary())] * with_ids, names + ["token_ids"] * with_ids)

    return rows.mapInArrow(run, f"row {kind}, " + ", ".join(f"{n} bigint" for n in names[1:]) + ", token_ids binary" * with_ids)


def best_fit(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int]]:
    """Best-fit-decreasing over counts of lengths: steps (length, first rank, first sequence, pieces in each sequence, offset of the first).

    The step of a piece is the last one of its length whose first rank is not above its rank; ``rank - first`` then counts through the sequences
    of the step, ``each`` pieces one after another in every one.

    A length adds at most three ranges of sequences and a range takes part in a step once for a length, at most until it is full. A sequence
    holds pieces of at most about ``sqrt(2 * room)`` different lengths, so there are at most ``3 * room * sqrt(2 * room)`` steps (400,000 for 2048).
    """
    steps = []
    # ranges (first, number) of sequences by the room they have left
    left: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    opened = 0

    def put(size: int, first: int, number: int) -> None:
        if number and size:
            if size not in left:
                insort(sizes, size)
            left.setdefault(size, []).append((first, number))

    for length in sorted(counts, reverse=True):
        if not 1 <= length <= room:
            raise ValueError(f"a piece of {length} tokens does not fit")
        rank, count = 0, counts[length]
        while rank < count:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                size = sizes[at]
                first, number = left[size].pop()
                if not left[size]:
                    del left[size], sizes[at]
            else:
                size, first = room, opened
                number = -(-(count - rank) // (room // length))
                opened += number
            each = size // length
            full = min(number, (count - rank) // each)
            if full:
                steps.append((length, rank, first, each, room - size))
                rank += full * each
                put(size - each * length, first, full)
            rest = count - rank if full < number else 0
            if rest:
                # fewer than would fill one sequence
                steps.append((length, rank, first + full, rest, room - size))
                rank += rest
                put(size - rest * length, first + full, 1)
            put(size, first + full + (rest > 0), number - full - (rest > 0))
    return steps


def pack(df: DataFrame, id_column: str = "doc_id", text: str = "text", room: int = ROOM, end: int = END, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: the id column, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Documents of at most ``room`` tokens, with the one that ends them, stay whole; of longer ones all pieces but the first are full. The pieces of
    a sequence follow one another without a gap. ``with_ids`` adds ``token_ids`` (packed little-endian unsigned 32-bit integers). A null or empty text is a
    document of one token; null and repeated ids are passed on, every row is a document of its own. Other columns are left out, whatever
    their names. An empty table gives no rows.
    """
    spark = df.sparkSession
    cut = materialise(token_pieces(df, id_column, text, room, end, tokenizer, with_ids), "token-pieces")
    of_task = materialise(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in of_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = np.array(best_fit(counts, room), np.int64).reshape(-1, 5)
    # ranks count through the tasks; there is one row for each task and length
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = of_task.select("length", "part", F.coalesce(before, F.lit(0).cast("bigint")).alias("before"))
    # as many rows as tasks and lengths, so they are not broadcast
    ranked = cut.join(firsts.hint("shuffle_hash"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("slot"))
    shared = spark.sparkContext.broadcast(steps)

    names = ["row", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["token_ids"] * with_ids
    kind = cut.schema["row"].dataType.simpleString()

    def place(batches):
        steps = shared.value
        # the steps of a length are found by one number made of length and rank
        edges = [int(np.searchsorted(-steps[:, 0], -n, side)) for n in range(room + 1) for side in ("left", "right")]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            chosen = np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                here = length == n
                low, high = edges[2 * n], edges[2 * n + 1]
                chosen[here] = low + np.searchsorted(steps[low:high, 1], rank[here], "right") - 1
            _, first, sequence, each, offset = steps[chosen].T
            turn = rank - first
            places = [pa.array(sequence + turn // each), pa.array(offset + turn % each * length)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names[:5]] + places + [batch.column(n) for n in names[7:]], names)

    schema = f"row {kind}, " + ", ".join(f"{n} bigint" for n in names[1:7]) + ", token_ids binary" * with_ids
    return ranked.mapInArrow(place, schema).withColumnRenamed("row", id_column)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
