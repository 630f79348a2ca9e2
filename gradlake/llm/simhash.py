"""SimHash near-dedup with pigeonring filtering.

A fingerprint is cut into m segments in a ring. If two fingerprints differ in at most t bits, there is a segment from which every
chain of l consecutive segments differs in at most l t / m bits. With m > t the first segment is then equal, and the first two
differ in at most one bit, so one half of the second segment is equal too. That is the key under which candidates meet; the longer
chains prune them before the whole fingerprints are compared. Keys cover about half of the bits, so chance meetings stay rare.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import pick, table
from gradlake.llm.components import link
from gradlake.session import materialise

BITS = 64
SEED = 42
#: The longest part of a fingerprint in a key: a segment of 32 bits and half of the next.
KEY_BITS = 48
#: The contract: shingles of three words, links at two bits.
WORDS, MOST_BITS = 3, 2


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """All runs of n words joined by a space; a shorter sequence is one run, an empty one none."""
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return words if n == 1 else list(map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False)))


def fingerprint(features: list[bytes], seed: int = SEED) -> int:
    """Bit by bit what over half of the hashes have; 0 without features."""
    total, n = np.zeros(BITS, np.int64), len(features)
    for start in range(0, n, 1 << 16):
        hashes = np.fromiter((xxhash.xxh64_intdigest(f, seed) for f in features[start : start + (1 << 16)]), ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Ring:
    """The segments of a fingerprint, as Spark expressions."""

    def __init__(self, most_bits: int):
        self.most = most_bits
        self.parts = most_bits + 1
        edges = [BITS * i // self.parts for i in range(self.parts + 1)]
        self.segments = [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]
        if not 0 <= most_bits <= 8:
            raise ValueError("most_bits must lie between 0 and 8")

    @staticmethod
    def mask(low: int, n: int) -> int:
        return ((1 << n) - 1) << low

    def keys(self, value: Column) -> list[Column]:
        """Where a fingerprint looks for partners: from each segment on, that segment and one half of the next, as one number of ``KEY_BITS`` bits."""

        def piece(low: int, n: int) -> Column:
            return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << n) - 1).cast("bigint"))

        if self.parts == 1:
            # the whole is compared afterwards, so a part of it will do
            return [piece(0, KEY_BITS)]
        found = []
        for i, (low, n) in enumerate(self.segments):
            after, size = self.segments[(i + 1) % self.parts]
            half = size // 2
            for at, width in ((after, half), (after + half, size - half)):
                found.append(F.shiftleft(piece(low, n), width).bitwiseOR(piece(at, width)))
        return found

    def similar(self, start: Column, x: Column, y: Column) -> Column:
        """Each chain from the segment of the key on keeps to its share of the bits, and so does the whole."""
        differ = x.bitwiseXOR(y)
        ok = F.bit_count(differ) <= self.most
        for length in range(self.parts - 1, 1, -1):
            masks = []
            for i in range(self.parts):
                mask = 0
                for j in range(length):
                    mask |= self.mask(*self.segments[(i + j) % self.parts])
                masks.append(F.lit(signed(mask)).cast("bigint"))
            share = length * self.most // self.parts
            ok = (F.bit_count(differ.bitwiseAND(F.element_at(F.array(*masks), F.floor(start / 2).cast("int") + 1))) <= share) & ok
        return ok


def near_components(nodes: DataFrame, most_bits: int, columns: list[str]) -> DataFrame:
    """Components of ``node``, linked where any of the fingerprint ``columns`` differ in at most ``most_bits`` bits."""
    ring = Ring(most_bits)
    rows, starts = [], 1
    for i, c in enumerate(columns):
        own = ring.keys(F.col(c))
        starts = len(own)
        for start, bits in enumerate(own):
            # one number holds the column, the start and the bits
            tag = F.lit((i * starts + start) << KEY_BITS).cast("bigint")
            rows.append(F.struct(tag.bitwiseOR(bits).alias("key"), F.col(c).alias("value")))
    keyed = nodes.select("node", F.explode(F.array(*rows)).alias("k")).select("k.key", "node", "k.value")
    return link(keyed, lambda key, x, y: ring.similar(F.pmod(F.shiftrightunsigned(key, KEY_BITS), F.lit(starts)), x, y))


def class_of(text: Column) -> Column:
    """A digest of the whole text, equal for exact copies; null texts count as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def fingerprints(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, digest: bool = False) -> DataFrame:
    """``row`` (the id) and ``node`` (the fingerprint as a signed 64-bit integer) of every text, null ones as empty.

    ``digest`` adds ``class`` (see :func:`class_of`).
    """
    rows = pick(df, row=id_column, text=text)
    kind = rows.schema["row"].dataType.simpleString()
    more = [class_of(F.col("text")).alias("class")] if digest else []
    rows = rows.select("row", F.coalesce("text", F.lit("")).cast("binary").alias("text"), *more)

    def run(batches):
        for batch in batches:
            found = [signed(fingerprint(shingles(t.as_py().lower().split(), words))) for t in batch.column(1)]
            kept = {"row": batch.column(0), "node": pa.array(found, pa.int64())} | ({"class": batch.column(2)} if digest else {})
            yield pa.RecordBatch.from_arrays(list(kept.values()), list(kept))

    return rows.mapInArrow(run, f"row {kind}, node bigint" + ", class binary" * digest)


def rooted_nodes(marked: DataFrame, most_bits: int) -> DataFrame:
    """``node``, ``low`` (its smallest id) and ``root`` (the smallest node of its component) of every distinct fingerprint."""
    nodes = materialise(marked.groupBy("node").agg(F.min("row").alias("low")), "nodes")
    roots = near_components(nodes.withColumn("value", F.col("node")), most_bits, ["value"])
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """Every row's id, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (the smallest id reachable over links).

    Copies share a fingerprint, so links are sought between distinct fingerprints only. Null and empty texts have fingerprint zero.
    Rows with a null id take part, but null is never the smallest id unless the whole component has no other. Other columns are left out.
    """
    marked = materialise(fingerprints(df, id_column, text, words), "fingerprints")
    rooted = rooted_nodes(marked, most_bits)
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("node", "component_id")
    return marked.join(named, "node").select(F.col("row").alias(id_column), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of every component of :func:`near_duplicates`: the one with the smallest id, with all its columns.

    Of several rows with that id the one with the smallest digest of its text stays, and of equal ones any. A component without any
    id keeps one of its rows in the same way. Null and empty texts form one component. Other columns may have any names.
    """
    marked = materialise(fingerprints(df, id_column, text, words, digest=True), "fingerprints")
    rooted = rooted_nodes(marked, most_bits).select("node", "root")
    # copies are counted per task first, so a large group of them crosses the shuffles as few rows
    rows = marked.groupBy("node", "row", "class").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("row").isNull().alias("none"), "row", "class", "n")).alias("first")
    kept = rows.groupBy("node").agg(first).join(rooted, "node").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    kept = materialise(kept.select(F.col("row").alias("own_row"), F.col("class").alias("own_class"), "n"), "kept")
    names = df.columns
    own, place = names.index(id_column), names.index(text)
    plain = df.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("class", class_of(F.col(f"c{place}")))
    same = (F.col("class") == F.col("own_class")) & F.col(f"c{own}").eqNullSafe(F.col("own_row"))
    # only rows that occur again have to meet once more
    single = plain.join(kept.filter("n = 1"), same, "semi")
    again = plain.join(kept.filter("n > 1"), same, "semi").dropDuplicates(["class", f"c{own}"])
    return single.union(again).drop("class").toDF(*names)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


