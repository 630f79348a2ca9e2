"""Benchmark decontamination by q-gram lemma filtering in diagonal bands.

An item of m letters that occurs in a text with at most k edits shares at least m + 1 - q (k + 1) q-grams with it, all of them on
k + 1 neighbouring diagonals (place in the text minus place in the item). Diagonals are cut into bands of 2 (k + 1) that overlap by
half, so one band holds them all. Shared q-grams are counted per band; bands that reach the bound are verified by an alignment inside
the band.

Texts are compared by their letters and digits in lower case, so case, white space and punctuation play no part.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import pick, slices, table

#: q-gram length, and edits allowed per letter of an item.
Q = 10
ERROR_RATE = 0.07
#: Items are taken in blocks of so many characters; a block and its index are shared with every task.
BLOCK_CHARS = 4 << 20
#: Characters of texts whose q-grams are looked up at once.
SLICE_CHARS = 1 << 20
#: Shared q-grams that are listed at once, and letters of candidates that are aligned at once; more are taken in turn.
MOST_LISTED, MOST_ALIGNED = 1 << 22, 1 << 20
TABLE_BITS = 22


@cache
def letters() -> np.ndarray:
    """Per code point: itself if it is a letter, a mark or a digit, else 0."""
    codes = np.arange(0x110000, dtype=np.uint32)
    kept = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)])
    return np.where(kept, codes, 0).astype(np.uint32)


def normal(text: str) -> np.ndarray:
    """The lower-case letters and digits of a text as code points."""
    codes = letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes[codes > 0]


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q code points from every place on."""
    base = np.uint64(0x9E3779B97F4A7C15)
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # doubled step by step: a gram of length 2s is two grams of length s
    out, done, power, step, own = np.zeros(n, np.uint64), 0, base, 1, codes.astype(np.uint64)
    while True:
        if q & step:
            out = out * power + own[done : done + n]
            done += step
        step *= 2
        if step > q:
            return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        half = step // 2
        own = own[: len(own) - half] * power + own[half:]
        with np.errstate(over="ignore"):
            power = power * power


def added(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of counts by key."""
    keys, where = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, where, np.concatenate([n for _, n in counted]))
    return keys, total


class Items:
    """A block of benchmark items: their letters, edit budgets, bounds, and an index of their q-grams."""

    def __init__(self, ids: list[int], texts: list[str], q: int, error_rate: float):
        self.q, self.ids = q, ids
        self.codes = [normal(t) for t in texts]
        self.size = np.array([len(c) for c in self.codes], np.int64)
        # at least one shared q-gram is needed; a shorter item than q has none and can't be found
        self.edits = np.minimum((error_rate * self.size).astype(np.int64), np.maximum(0, self.size // q - 1))
        self.bound = self.size + 1 - q * (self.edits + 1)
        all_grams = [grams(c, q) for c in self.codes]
        hashes = np.concatenate([np.zeros(0, np.uint64), *all_grams])
        item = np.repeat(np.arange(len(ids)), [len(g) for g in all_grams])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in all_grams)])
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first diagonal of a band) of the bands that reach the bound of their item."""
        hashes = grams(codes, self.q)
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if not len(self.keys) or not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[found] == hashes[at]
        at, found = at[same], found[same]
        # a gram that an item repeats meets all its places, so occurrences are listed some at a time and kept as counts of bands
        counted: list[tuple[np.ndarray, np.ndarray]] = []
        for first, end in slices(self.count[found].tolist(), MOST_LISTED):
            counted.append(self.bands(at[first:end], found[first:end]))
            if len(counted) > 8:
                counted = [added(counted)]
        keys, counts = added(counted) if counted else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        item, band = keys >> 40, (keys & ((1 << 40) - 1)) - 1
        reached = counts >= self.bound[item]
        item, band = item[reached], band[reached]
        return item, band * (self.edits[item] + 1) - int(self.size.max())

    def bands(self, at: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers made of item and band, and how many of the shared grams lie in each."""
        times = self.count[found]
        entry = np.repeat(self.first[found] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        item, diagonal = self.item[entry], np.repeat(at, times) - self.place[entry] + int(self.size.max())
        band = diagonal // (self.edits[item] + 1)
        # a diagonal lies in the band that starts at its own multiple of the width, and in the one before
        return np.unique(np.concatenate([(item << 40) | (band + 1), (item << 40) | band]), return_counts=True)

    def verify(self, codes: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each candidate the fewest edits of an occurrence in its band (the budget and one more if none), and where it ends."""
        edits, ends = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
        order = np.argsort(self.size[item], kind="stable")
        wall = int(self.edits.max(initial=0)) + 2
        for start, end in slices((self.size[item[order]] + 6 * self.edits[item[order]]).tolist(), MOST_ALIGNED):
            part = order[start:end]
            sizes, k = self.size[item[part]], self.edits[item[part]]
            longest, reach = int(sizes.max()), int(k.max())
            width = 2 * (reach + 1) + 2 * reach
            pattern = np.zeros((len(part), longest), np.uint32)
            for row, i in enumerate(item[part]):
                pattern[row, : self.size[i]] = self.codes[i]
            left = diagonal[part] - reach
            span = left[:, None] + np.arange(longest + width)
            inside = (span >= 0) & (span < len(codes))
            window = np.where(inside, codes[np.clip(span, 0, len(codes) - 1)], 0)
            # the zero between two texts, and what lies before the first and after the last, cost more than any budget
            closed = window == 0
            skipped = np.zeros((len(part), window.shape[1] + 1), np.int32)
            np.cumsum(np.where(closed, wall, 1), axis=1, out=skipped[:, 1:])
            cost = np.zeros((len(part), width), np.int32)
            best, stop = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for j in range(longest):
                step = cost + np.where(closed[:, j : j + width], wall, window[:, j : j + width] != pattern[:, j : j + 1])
                # leave out a letter of the item: the same place in the text, one diagonal to the left
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                # leave out letters of the text: diagonals to the right
                across = skipped[:, j + 1 : j + 1 + width]
                cost = np.minimum.accumulate(step - across, axis=1) + across
                last = np.flatnonzero(sizes == j + 1)
                if len(last):
                    where = cost[last].argmin(1)
                    best[last] = cost[last, where]
                    stop[last] = left[last] + j + where
            edits[part], ends[part] = best, stop
        return edits, ends


def mark_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id", item_text: str = "text", q: int = Q, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All columns of ``docs``, then ``items`` (sorted distinct ids of the items in the text) and ``n_edits`` (of the best one, null without any).

    An item counts as found if all of it occurs with at most ``error_rate`` edits per letter (less for items under some 30 letters,
    where q-grams allow fewer). Items with a null id, and items of fewer than ``q`` letters, are found nowhere; repeated items count once
    per id. A null text holds nothing. Every input row gives one row. Other columns may have any names.

    The texts stay where they are. Items come in blocks of bounded size, each a pass over the texts, so any number of items will do.
    """
    names = docs.columns
    place, width = names.index(text), len(names)
    rows = docs.toDF(*(f"c{i}" for i in range(width)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    items = pick(benchmark, item=item_column, text=item_text).filter("item is not null and text is not null").select(F.col("item").cast("bigint").alias("item"), "text").distinct()
    context = docs.sparkSession.sparkContext

    def one_pass(input_rows: DataFrame, block: list) -> DataFrame:
        shared = context.broadcast(([r[0] for r in block], [r[1] for r in block]))
        held: list[Items] = []

        def run(batches):
            if not held:
                held.append(Items(*shared.value, q, error_rate))
            own = held[0]
            for batch in batches:
                texts = [t or "" for t in batch.column(place).to_pylist()]
                found: list[set[int]] = [set(x or ()) for x in batch.column(width).to_pylist()]
                fewest: list[int | None] = batch.column(width + 1).to_pylist()
                for first, end in slices([len(t) for t in texts], SLICE_CHARS):
                    parts = [normal(t) for t in texts[first:end]]
                    # texts follow one another, each closed by a zero that matches nothing
                    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
                    codes = np.zeros(int(starts[-1]), np.uint32)
                    for s, p in zip(starts, parts, strict=False):
                        codes[s : s + len(p)] = p
                    item, diagonal = own.candidates(codes)
                    if not len(item):
                        continue
                    edits, ends = own.verify(codes, item, diagonal)
                    good = edits <= own.edits[item]
                    where = np.searchsorted(starts, np.maximum(ends[good], 0), "right") - 1
                    for i, d, e in zip(item[good].tolist(), where.tolist(), edits[good].tolist(), strict=True):
                        found[first + d].add(own.ids[i])
                        before = fewest[first + d]
                        fewest[first + d] = e if before is None else min(before, e)
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array([sorted(f) for f in found], pa.list_(pa.int64())), pa.array(fewest, pa.int64())], batch.schema.names)

        return input_rows.mapInArrow(run, f"{fields}, found array<bigint>, edits bigint")

    rows = rows.withColumns({"found": F.array().cast("array<bigint>"), "edits": F.lit(None).cast("bigint")})
    block, chars = [], 0
    for r in items.toLocalIterator():
        if block and chars + len(r["text"]) > block_chars:
            rows, block, chars = one_pass(rows, block), [], 0
        block.append((r["item"], r["text"]))
        chars += len(r["text"])
    if block:
        rows = one_pass(rows, block)
    return rows.toDF(*names, "items", "n_edits")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The id, ``items`` and ``n_edits`` of :func:`mark_leaks`."""
    return mark_leaks(pick(docs, id_column, text), benchmark, text, **options).select(id_column, "items", "n_edits")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any item, with all their columns."""
    marked = mark_leaks(docs, benchmark, text, **options)
    plain = marked.toDF(*(f"c{i}" for i in range(len(marked.columns))))
    return plain.filter(F.size(f"c{len(docs.columns)}") == 0).drop(*plain.columns[-2:]).toDF(*docs.columns)


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items in every document."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", "n_edits")
