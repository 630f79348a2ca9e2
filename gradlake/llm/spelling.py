"""Spelling variants by a variable-length gram index.

A gram of a word is as long as it takes to be rare: from every position it starts with two letters and grows while the dictionary
of frequent grams holds it. The dictionary is counted level by level, a longer gram only where the shorter one is frequent, and pruned
to the grams of more than a bounded share of all words, so it stays small whatever the number of words.

A gram is settled by its own letters alone, so one edit changes only the grams that cover it. How many that are at most is counted
for every word (``affected``); two words one edit apart share all others. So of the gram lists of a word, taken from the rarest on, only
``affected + 1`` have to be merged: some partner list is among them. Candidates that meet there are verified.

Words are compared in classes: those of equal length, and those of length c with those of length c + 1. In a class no gram is longer
than its shorter words less one, so every word keeps a gram that an edit leaves alone. A list holds at most the words under which a gram still
counts as rare or, for a gram of full length, as many words as two more letters of the alphabet can make: lists do not grow with hot grams.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import CRC32_SQL, crc32_sql, parts, pick, table
from gradlake.session import discard, materialise

#: Runs of the letters A-Z, a-z and U+00C0 to U+00FF in UTF-8 whose A-Z are lower-cased already. Fixed value.
RUNS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+").findall
#: The contract: words of so many letters and occurrences; one run in so many is damaged; a form is so many times as frequent.
MIN_CHARS, MIN_COUNT, DAMAGED, TIMES = 6, 5, 199, 5
#: Distinct runs that a task holds before it hands their counts on.
HELD_RUNS = 1 << 18
#: The shortest gram.
LEAST_GRAM = 2
#: A gram in more words than this is frequent; a level of the dictionary has no more entries than ``DICTIONARY``.
RARE_WORDS, DICTIONARY = 128, 1 << 16
#: Cells in which gram lists are counted; only the order in which lists are merged depends on it.
CELLS = 1 << 18
#: Letters of a slice of words, and counted grams that a task holds.
SLICE_CELLS, HELD_GRAMS = 1 << 20, 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
SAME, SHORT, LONG = 0, 1, 2


def shortened(run: bytes, h: int) -> bytes:
    """The run without its code point ``h % length``."""
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def count_words(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damaged: int | None = None
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts: runs of letters, A-Z lower-cased, of ``min_chars`` code points that occur ``min_count`` times.

    With ``damaged``, a run for which that number divides the crc32 of ``<id>:<run>`` loses one code point first, which plants misspellings; a
    null id counts as empty there. Null and empty texts hold no words. Other columns are left out, whatever their names.
    """
    rows = pick(df, row=id_column, text=text).filter("text is not null and text != ''")
    rows = rows.select(F.coalesce(F.col("row").cast("string"), F.lit("")).alias("row"), F.col("text").cast("binary").alias("text"))

    def flush(total: Counter) -> Iterator[pa.RecordBatch]:
        kept = [(w, n) for w, n in total.items() if n and len(w) - w.count(b"\xc3") >= min_chars]
        total.clear()
        if kept:
            words, counts = zip(*kept, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    def run(batches):
        total: Counter = Counter()
        for batch in parts(batches, 1):
            for row, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = RUNS(whole.lower())
                total.update(found)
                if damaged and found:
                    hashes = np.fromiter(map(zlib.crc32, found, repeat(zlib.crc32(f"{row}:".encode()))), np.int64, len(found))
                    for i in np.flatnonzero(hashes % damaged == 0).tolist():
                        total[found[i]] -= 1
                        total[shortened(found[i], int(hashes[i]))] += 1
                if len(total) > HELD_RUNS:
                    yield from flush(total)
        yield from flush(total)

    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def mixed(value: np.ndarray) -> np.ndarray:
    """The numbers with their bits mixed."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def next_size(size: int) -> int:
    """The length that follows ``size`` for grams: each from 2 to 8, then by a quarter."""
    return size + max(1, size // 8 * 2)


class Grams:
    """The grams of equally long words: one row per word, one column per position, and a mark after the last letter."""

    def __init__(self, words: list[str]):
        self.m, self.n = len(words), len(words[0])
        letters = np.zeros((self.m, self.n + 1), np.uint64)
        letters[:, :-1] = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(self.m, self.n)
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(self.n + 1, BASE)), dtype=np.uint64)
        self.prefix = np.zeros((self.m, self.n + 2), np.uint64)
        for i in range(self.n + 1):
            self.prefix[:, i + 1] = self.prefix[:, i] * BASE + letters[:, i] + np.uint64(1)
        self.room = self.n + 1 - np.arange(self.n)

    def of_size(self, size: int) -> np.ndarray:
        """The grams of one length at all positions with room for it."""
        ends = min(self.n, self.n + 2 - size)
        return mixed(self.prefix[:, size : size + ends] - self.prefix[:, :ends] * self.powers[size] + np.uint64(size))

    def growing(self, frequent: dict[int, np.ndarray], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Every length below ``most``, its grams, and which of them are reached: all shorter ones from there are frequent."""
        reached, size = np.ones((self.m, self.n), bool), LEAST_GRAM
        while size < most and size <= self.n:
            grams = self.of_size(size)
            reached = reached[:, : grams.shape[1]]
            yield size, grams, reached
            known = frequent.get(size)
            if known is None or not len(known):
                return
            reached = reached & (known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
            size = next_size(size)

    def chosen(self, frequent: dict[int, np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
        """The gram of every position, and its length: grown while frequent, to ``most`` letters or the end of the word."""
        sizes = np.minimum(LEAST_GRAM, self.room)[None].repeat(self.m, 0)
        for size, _, reached in self.growing(frequent, most + 1):
            width = reached.shape[1]
            sizes[:, :width] = np.where(reached, size, sizes[:, :width])
        # a gram that is frequent at the last length it was held against takes what is left up to the next
        grown = self.limit(frequent, sizes, most)
        at = np.arange(self.n)[None] + grown
        whole = np.take_along_axis(self.prefix, at, 1) - self.prefix[:, : self.n] * self.powers[grown]
        return mixed(whole + grown.astype(np.uint64)), grown

    def limit(self, frequent: dict[int, np.ndarray], sizes: np.ndarray, most: int) -> np.ndarray:
        out = np.minimum(sizes, most)
        for size in np.unique(sizes).tolist():
            following = min(next_size(size), most)
            known = frequent.get(size)
            if following <= size or known is None or not len(known) or size > self.n + 1:
                continue
            grams = self.of_size(size)
            width = grams.shape[1]
            here = (sizes[:, :width] == size) & (known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
            out[:, :width] = np.where(here, np.minimum(following, self.room[None, :width]), out[:, :width])
        return out

    def affected(self, sizes: np.ndarray, inserted: bool) -> np.ndarray:
        """For each word, the most grams that cover one letter, or with ``inserted`` the gap between two."""
        ends = np.zeros((self.m, self.n + 2), np.int64)
        rows = np.repeat(np.arange(self.m), self.n)
        np.add.at(ends, (rows, (np.arange(self.n)[None] + sizes).ravel()), 1)
        over = np.cumsum(ends, 1)
        if inserted:
            return (np.arange(1, self.n + 1)[None] - over[:, 1 : self.n + 1]).max(1)
        return (np.arange(1, self.n + 1)[None] - over[:, : self.n]).max(1)

    def lists(self, frequent: dict[int, np.ndarray], side: int) -> tuple[np.ndarray, np.ndarray]:
        """The gram lists of every word in one class, and how many of them an edit affects at most."""
        shorter = self.n - (side == LONG)
        grams, sizes = self.chosen(frequent, shorter - 1)
        label = np.array([2 * shorter + (side != SAME)], np.uint64) * BASE
        # words of equal length hold a common gram at the same position
        place = np.arange(1, self.n + 1).astype(np.uint64)[None] * np.uint64(0xC2B2AE3D27D4EB4F) if side == SAME else np.uint64(0)
        return mixed(grams + label + place), self.affected(sizes, side == SHORT)


def by_length(batches, most: int = SLICE_CELLS) -> Iterator[tuple[list[str], np.ndarray]]:
    """Equally long words and their counts, slice by slice."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        counts = batch.column(1).to_numpy()
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        edges = [0, *(np.flatnonzero(np.diff(sizes[order])) + 1).tolist(), len(order)]
        for start, end in zip(edges, edges[1:], strict=False):
            step = max(1, most // (int(sizes[order[start]]) + 2)) if end > start else 1
            for at in range(start, end, step):
                own = order[at : min(end, at + step)]
                yield [words[i] for i in own.tolist()], counts[own]


def counted(held: list[np.ndarray], name: str) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], [name, "n"])


def gram_dictionary(words: DataFrame, rare_words: int = RARE_WORDS, most: int = DICTIONARY) -> dict[int, np.ndarray]:
    """The frequent grams of every length, ascending: those in more than ``rare_words`` words, or in more than one in ``most`` of all letters.

    Longer grams are counted only where the next shorter one is frequent. A level has at most ``most`` entries, since all its grams
    together are no more than the letters of all words.
    """
    total, longest = words.agg(F.sum(F.char_length("word")), F.max(F.char_length("word"))).first()
    limit = max(rare_words, -(-(total or 0) // most))
    found: dict[int, np.ndarray] = {}
    size = LEAST_GRAM
    while size < (longest or 0) - 1:
        shared = words.sparkSession.sparkContext.broadcast(dict(found))

        def run(batches, level=size, shared=shared):
            held, entries = [], 0
            for own, _ in by_length(batches):
                if len(own[0]) <= level + 1:
                    continue
                for at, grams, reached in Grams(own).growing(shared.value, level + 1):
                    if at < level:
                        continue
                    # a word counts once for a gram: its others are put aside as zero
                    listed = np.sort(np.where(reached, grams, np.uint64(0)), 1)
                    first = np.ones(listed.shape, bool)
                    first[:, 1:] = listed[:, 1:] != listed[:, :-1]
                    held.append(listed[first & (listed != 0)])
                    entries += len(held[-1])
                if entries > HELD_GRAMS:
                    yield counted(held, "gram")
                    held, entries = [], 0
            if entries:
                yield counted(held, "gram")

        often = words.select("word", "n").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > limit)
        grams = np.sort(often.select("gram").toArrow().column("gram").to_numpy().astype(np.int64).view(np.uint64))
        shared.destroy()
        if not len(grams):
            break
        found[size] = grams
        size = next_size(size)
    return found


def sides_of(n: int, min_chars: int) -> list[int]:
    """The classes of a word of n letters: with equal ones, as the shorter and as the longer one."""
    return [SAME, SHORT] + [LONG] * (n > min_chars)


def gram_index(words: DataFrame, frequent: dict[int, np.ndarray], min_chars: int = MIN_CHARS) -> DataFrame:
    """``side``, ``list``, ``word`` and ``n``: the rarest gram lists of every word in each of its classes, one more than an edit affects.

    Lists are put in order by counts over all words, in cells, and by their numbers; all words keep to the same order.
    """
    spark = words.sparkSession
    words = words.select("word", "n")
    shared = spark.sparkContext.broadcast(frequent)

    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for own, _ in by_length(batches):
            grams = Grams(own)
            for side in sides_of(grams.n, min_chars):
                lists, _ = grams.lists(shared.value, side)
                total += np.bincount((lists.ravel() % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], ["cell", "n"])

    found = words.mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    often = spark.sparkContext.broadcast(counts)

    def post(batches):
        for own, n in by_length(batches, SLICE_CELLS // 4):
            grams, listed = Grams(own), pa.array(own)
            for side in sides_of(grams.n, min_chars):
                lists, affected = grams.lists(shared.value, side)
                order = np.lexsort((lists, often.value[(lists % np.uint64(CELLS)).astype(np.int64)]), axis=-1)
                lists = np.take_along_axis(lists, order, 1)
                first = np.ones(lists.shape, bool)
                first[:, 1:] = lists[:, 1:] != lists[:, :-1]
                rows, places = np.nonzero(first & (np.cumsum(first, 1) <= affected[:, None] + 1))
                columns = [pa.array(np.full(len(rows), side, np.int8)), pa.array(lists[rows, places].view(np.int64)), listed.take(pa.array(rows)), pa.array(n[rows])]
                yield pa.RecordBatch.from_arrays(columns, ["side", "list", "word", "n"])

    return words.mapInArrow(post, "side tinyint, list bigint, word string, n bigint")


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS, rare_words: int = RARE_WORDS) -> DataFrame:
    """``a``, ``na``, ``b``, ``nb``: every two words of ``words`` (``word``, ``n``) that are one inserted, deleted or replaced code point apart, once."""
    index = materialise(gram_index(words, gram_dictionary(words, rare_words), min_chars), "grams")

    def side(which: int, word: str, n: str) -> DataFrame:
        return index.filter(F.col("side") == which).select("list", F.col("word").alias(word), F.col("n").alias(n))

    equal = side(SAME, "a", "na").join(side(SAME, "b", "nb"), "list").filter("a < b")
    unequal = side(SHORT, "a", "na").join(side(LONG, "b", "nb"), "list")
    met = equal.unionByName(unequal).filter(F.levenshtein("a", "b", 1) == 1)
    return met.select("a", "na", "b", "nb").distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of its forms, for every row of ``word``, ``form``; each round doubles the steps taken."""
    current = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = current.select(F.col("word").alias("via"), F.col("root").alias("further"))
        moved = materialise(current.join(after, F.col("root") == F.col("via"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(current)
        current = moved
        if not moved.filter("moved").limit(1).count():
            return current.select("word", "root")


def spelling_variants(words: DataFrame, min_chars: int = MIN_CHARS, times: int = TIMES, rare_words: int = RARE_WORDS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` for every row of ``words`` (distinct ``word`` of ``min_chars`` letters U+0001 to
    U+00FF and more, and its count ``n``).

    ``n_near`` counts the words one inserted, deleted or replaced code point away. The most frequent of these (the smallest of equally frequent
    ones, by code points) is the word's form if it is ``times`` times as frequent; ``root`` is the last of a word's form, its form and so on, or
    the word itself. An empty table gives no rows.
    """
    if min_chars < 2:
        raise ValueError("words must have two letters at least")
    words = materialise(words.select("word", "n"), "words")
    pairs = materialise(near_pairs(words, min_chars, rare_words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).union(pairs.select("b", "a", "na"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("first"))
    joined = words.join(near, "word", "left")
    often = -F.col("first.less") >= times * F.col("n")
    known = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(often, F.col("first.other")).alias("form"), F.when(often, -F.col("first.less")).alias("form_n")
    )
    known = materialise(known, "forms")
    roots = roots_of(known.filter("form is not null"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some runs damaged, with their forms and roots."""
    words = count_words(table(spark, sf_dir, "documents"), damaged=DAMAGED)
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


OP11_SQL = rf"""
WITH RECURSIVE {CRC32_SQL},
runs AS (
  SELECT key, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS key, run FROM (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents))
  GROUP BY key, run),
hashed AS ({crc32_sql("runs", "key")}),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS MATERIALIZED (SELECT word, n, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM places),
near AS MATERIALIZED (
  SELECT DISTINCT word, other, m FROM (
    SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.l || '*' || a.r = b.l || '*' || b.r AND a.word <> b.word
    UNION ALL SELECT a.word, w.word, w.n FROM holes a JOIN words w ON a.l || a.r = w.word
    UNION ALL SELECT w.word, a.word, a.n FROM holes a JOIN words w ON a.l || a.r = w.word)),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -m, other := other)) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * w.n THEN b.other END AS form, CASE WHEN -b.less >= 5 * w.n THEN -b.less END AS form_n
  FROM words w LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS root, form AS following FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON s.following = f.word)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON f.word = s.word AND s.following IS NULL
"""
