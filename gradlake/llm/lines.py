"""Line dedup with two Bloom filters.

A first pass over the texts yields a 64-bit hash per line key and document, cut into buckets by its leading bits. Each bucket fills
two filters: one of hashes seen once, one of hashes seen again. A key of two documents is always in the second filter; other keys
are there only by chance. A second pass tests every line against the second filters, and only the suspected repeats are shuffled, as
whole keys: grouping them by key confirms repeats exactly and finds the smallest document of each.

The filters take two bytes per line. Up to ``BROADCAST_BYTES`` every task holds them all; beyond that the hashes travel to the
filters instead, 16 bytes per line, with the rows of one bucket spread over ``SALTS`` tasks.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import map_batches, parts, pick, table
from gradlake.session import materialise

#: ASCII white space, stripped from both ends of a key. Fixed value.
SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
#: Bits of one filter, and the hashes meant for it: 16 bits each, so about one in 400 single lines is suspected.
FILTER_BITS = 1 << 21
BUCKET_HASHES = 1 << 17
PROBES = 4
BROADCAST_BYTES = 64 << 20
SALTS = 8
#: A key with more than one in so many of the suspected rows is not shuffled.
HOT_SHARE = 1000


def keys_of(text: bytes, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The key of every line; None where it is too short to count."""
    found = []
    for line in text.lower().split(b"\n"):
        key = line.strip(SPACE)
        n = len(key)
        if n < 4 * min_chars and (n < min_chars or len(key.decode("utf-8", "replace")) < min_chars):
            key = None
        found.append(key)
    return found


def places(hashes: np.ndarray) -> np.ndarray:
    """The filter bits of each hash, one row per probe."""
    first = hashes * np.uint64(0x9E3779B97F4A7C15)
    step = (first >> np.uint64(17)) | np.uint64(1)
    return np.stack([((first + np.uint64(i) * step) >> np.uint64(20)) % np.uint64(FILTER_BITS) for i in range(PROBES)]).astype(np.int64)


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """Per Arrow batch: the sorted distinct hashes of all documents, and those of two or more documents of the batch."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes: list[int] = []
        # rows of one document count as one document
        texts: dict[int, set[int]] = {}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts.setdefault(doc, set()).update(xxhash.xxh64_intdigest(k) for k in keys_of(text, min_chars) if k is not None)
        for own in texts.values():
            hashes.extend(own)
        values, counts = np.unique(np.array(hashes, np.uint64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([values.tobytes()]), pa.array([values[counts > 1].tobytes()])], ["seen", "again"])

    return map_batches(docs, run, "seen binary, again binary")


def filters_of(hashes: DataFrame, bits: int) -> DataFrame:
    """The filter of repeated hashes of every bucket, compressed."""

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for seen, again in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen, again = np.frombuffer(seen, np.uint64), np.frombuffer(again, np.uint64)
            for b in np.unique(bucket_of(seen, bits)).tolist():
                low, high = (b << (64 - bits), ((b + 1) << (64 - bits)) - 1) if bits else (0, 2**64 - 1)
                part = [a[np.searchsorted(a, np.uint64(low)) : np.searchsorted(a, np.uint64(high), "right")].tobytes() for a in (seen, again)]
                rows.append((b, *part))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["bucket", "seen", "again"])

    def fill(batches):
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for b, seen, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                once, twice = kept.setdefault(b, (np.zeros(FILTER_BITS, bool), np.zeros(FILTER_BITS, bool)))
                where = places(np.frombuffer(seen, np.uint64))
                twice[where[:, once[where].all(0)]] = True
                once[where] = True
                twice[places(np.frombuffer(again, np.uint64))] = True
        for b, (_, twice) in kept.items():
            packed = zlib.compress(np.packbits(twice).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([packed], pa.binary())], ["bucket", "twice"])

    spark = hashes.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 8)
    return map_batches(hashes, split, "bucket bigint, seen binary, again binary").repartition(tasks, "bucket").mapInArrow(fill, "bucket bigint, twice binary")


def in_filter(packed: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have all their bits set in the filter of their row."""
    where = places(hashes)
    return ((packed[rows, where >> 3] >> (7 - (where & 7))) & 1).all(0)


def suspects_by_broadcast(docs: DataFrame, filters: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """(doc, key) of suspected lines; every task holds all filters, whose size has been checked."""
    packed = np.zeros((1 << bits, FILTER_BITS // 8), np.uint8)
    for row in filters.toLocalIterator():
        packed[row["bucket"]] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(zlib.compress(packed.tobytes(), 1))
    held: list[np.ndarray] = []

    def run(batches):
        if not held:
            held.append(np.frombuffer(zlib.decompress(shared.value), np.uint8).reshape(1 << bits, FILTER_BITS // 8))
        for batch in parts(batches, 1):
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {k for k in keys_of(text, min_chars) if k is not None}
                ids.extend([doc] * len(own))
                keys.extend(own)
            hashes = np.array(list(map(xxhash.xxh64_intdigest, keys)), np.uint64)
            hit = in_filter(held[0], bucket_of(hashes, bits), hashes)
            chosen = np.flatnonzero(hit).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in chosen], pa.int64()), pa.array([keys[i] for i in chosen], pa.binary())], ["doc", "key"])

    return docs.mapInArrow(run, "doc bigint, key binary")


def suspects_by_routing(docs: DataFrame, filters: DataFrame, bits: int, min_chars: int) -> DataFrame:
    """The same rows, with the hashes sent to the filters: nothing is broadcast, and a task holds one filter at a time."""

    def explode(batches):
        for batch in batches:
            ids, hashes = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {k for k in keys_of(text, min_chars) if k is not None}
                ids.extend([doc] * len(own))
                hashes.extend(map(xxhash.xxh64_intdigest, own))
            h = np.array(hashes, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(h, bits)), pa.array(np.array(ids, np.int64)), pa.array(h.view(np.int64))], ["bucket", "doc", "hash"])

    def test(batches):
        own, packed = None, None
        for batch in batches:
            bucket, doc, hashes, twice = (batch.column(n) for n in ("bucket", "doc", "hash", "twice"))
            buckets = bucket.to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            filters_at = {i for i in range(batch.num_rows) if twice[i].is_valid} if twice.null_count < batch.num_rows else set()
            for start, end in zip(edges, edges[1:], strict=False):
                while start < end and start in filters_at:
                    own, packed = buckets[start], np.frombuffer(zlib.decompress(twice[start].as_py()), np.uint8)[None]
                    start += 1
                if start == end or own != buckets[start]:
                    continue
                part = hashes.slice(start, end - start).to_numpy().view(np.uint64)
                hit = in_filter(packed, np.zeros(len(part), np.int64), part)
                yield pa.RecordBatch.from_arrays([doc.slice(start, end - start).filter(pa.array(hit)), hashes.slice(start, end - start).filter(pa.array(hit))], ["doc", "hash"])

    lines = docs.mapInArrow(explode, "bucket bigint, doc bigint, hash bigint")
    lines = lines.select("bucket", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt"), F.lit(None).cast("binary").alias("twice"), "doc", "hash")
    copies = filters.select("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"), "twice", F.lit(None).cast("bigint").alias("doc"), F.lit(None).cast("bigint").alias("hash"))
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << bits) // 8)
    both = lines.unionByName(copies).repartition(tasks, "bucket", "salt").sortWithinPartitions("bucket", F.col("twice").isNull())
    marks = both.select("bucket", "doc", "hash", "twice").mapInArrow(test, "doc bigint, hash bigint").groupBy("doc").agg(F.collect_set("hash").alias("marks"))

    def keys(batches):
        for batch in batches:
            ids, found = [], []
            for doc, text, marked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marked = {m & (2**64 - 1) for m in marked}
                own = [k for k in {k for k in keys_of(text, min_chars) if k is not None} if xxhash.xxh64_intdigest(k) in marked]
                ids.extend([doc] * len(own))
                found.extend(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["doc", "key"])

    return docs.join(marks, "doc").select("doc", "text", "marks").mapInArrow(keys, "doc bigint, key binary")


def repeated_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document with lines to drop: ``doc`` and ``drops``, 128-bit hashes of their keys (they only tell the lines of one document apart)."""
    docs = pick(df, doc=id_column, text=text).filter("doc is not null and text is not null and text != ''").select(F.col("doc").cast("bigint"), F.col("text").cast("binary"))
    hashes = materialise(line_hashes(docs, min_chars), "hashes")
    total = hashes.agg(F.sum(F.octet_length("seen") + F.octet_length("again"))).first()[0] or 0
    bits = max(0, (total // 8 // BUCKET_HASHES).bit_length())
    filters = materialise(filters_of(hashes, bits), "filters")
    small = (FILTER_BITS // 8 << bits) <= broadcast_bytes
    suspects = materialise((suspects_by_broadcast if small else suspects_by_routing)(docs, filters, bits, min_chars), "suspects")
    first = suspects.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))
    first = materialise(first.filter("first < last").drop("last"), "first")
    # fewer than HOT_SHARE keys can each hold one in HOT_SHARE of the rows: those are matched where their rows lie
    hot = first.filter(F.col("n") * HOT_SHARE > suspects.count()).select("key", "first")
    matched = suspects.join(F.broadcast(hot), "key", "left")
    rare = matched.filter("first is null").select("key", "doc").join(first.join(F.broadcast(hot), "key", "anti").select("key", "first"), "key")
    matched = matched.filter("first is not null").select("key", "doc", "first").union(rare.select("key", "doc", "first"))

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([hashlib.md5(k).digest() for k in batch.column(1).to_pylist()], pa.binary())], ["doc", "drop"])

    drops = matched.filter("doc != first").select("doc", "key")
    return map_batches(drops, digest, "doc bigint, drop binary").groupBy("doc").agg(F.collect_set("drop").alias("drops"))


def without_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All columns of ``df`` as they are but for the text, without its repeated lines; then ``n_lines`` before and ``n_dropped``.

    A key (the line stripped of ASCII white space, A-Z lower-cased) of ``min_chars`` code points in two or more documents keeps its
    lines in the smallest document only; shorter ones, empty lines among them, stay everywhere. Rows with the same id are one
    document. A row without an id keeps all its lines and counts as no document. A null or empty text is one empty line and comes back
    empty. Ids are integers. Other columns may have any names.
    """
    names = df.columns
    row, place = names.index(id_column), names.index(text)
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    plain = plain.withColumn(f"c{place}", F.coalesce(f"c{place}", F.lit("")).cast("binary"))
    drops = repeated_lines(df, id_column, text, min_chars, broadcast_bytes)
    joined = plain.join(drops, F.col(f"c{row}").cast("bigint") == F.col("doc"), "left").select(*plain.columns, "drops")

    labels = plain.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, dropped = [], [], []
        for whole, gone in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            lines = whole.split(b"\n")
            kept = lines
            if gone:
                gone = set(gone)
                kept = [line for line, key in zip(lines, keys_of(whole, min_chars), strict=True) if key is None or hashlib.md5(key).digest() not in gone]
            texts.append(b"\n".join(kept))
            counts.append(len(lines))
            dropped.append(len(lines) - len(kept))
        columns = [pa.array(texts, pa.binary()) if i == place else c for i, c in enumerate(batch.columns[:-1])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], [*labels, "n_lines", "n_dropped"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    done = map_batches(joined, run, f"{fields}, n_lines bigint, n_dropped bigint")
    return done.withColumn(f"c{place}", F.col(f"c{place}").cast("string")).toDF(*names, "n_lines", "n_dropped")


def dedup_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """:func:`without_repeats` with the id and the text as the only columns of ``df``."""
    return without_repeats(pick(df, id_column, text), id_column, text, **options)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the digest of what is left of every document."""
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT r, doc_id, string_split(text, chr(10)) AS a FROM rows),
lines AS (
  SELECT r, doc_id, i, a[i] AS line,
    translate(trim(a[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, a, unnest(generate_series(1, len(a))) AS i FROM cut)),
repeated AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT l.*, p.key IS NOT NULL AND l.doc_id IS NOT NULL AND l.doc_id <> p.first AS gone FROM lines l LEFT JOIN repeated p USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
