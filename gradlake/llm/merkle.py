"""WARC archives and their Merkle fixity audit.

Records are hashed, and the hashes of a range of offsets into a leaf node; ranges of ranges form the levels above, up to one root per
archive. Two replicas are compared from the roots down: only below nodes that differ are the children joined, so sound archives cost
one comparison, and damage is found in as many steps as there are levels.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import pick, table
from gradlake.session import materialise

#: Bytes of offsets under one leaf node, children of an inner node, and bytes at which an archive is closed.
SPAN, FANOUT, ARCHIVE_BYTES = 1 << 16, 16, 1 << 28
END = b"\r\n\r\n"
LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)


def warc_record(name: str, url: str, payload: bytes) -> bytes:
    """One response record; the same input gives the same bytes."""
    urn = uuid.uuid5(uuid.NAMESPACE_URL, name)
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{urn}>\r\nWARC-Target-URI: {url}\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}"
    return head.encode() + END + payload + END


def archive_records(df: DataFrame, id_column: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Records laid out in archives: ``archive``, ``offset``, ``name`` (the id as text), ``url`` and ``record``.

    Every task fills archives of its own, so nothing is shuffled; read the result once, or write it, as another layout of the input
    gives other archives. Null ids and URLs count as empty, a null payload too. Other columns are left out.
    """
    rows = pick(df, name=id_column, url=url, payload=payload).select(F.coalesce(F.col("name").cast("string"), F.lit("")).alias("name"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("payload", F.lit("")).cast("binary").alias("payload"))

    def run(batches):
        task, number, offset = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            archives, offsets, records = [], [], []
            for name, link, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = warc_record(name, link, body)
                if offset and offset + len(record) > ARCHIVE_BYTES:
                    number, offset = number + 1, 0
                archives.append(f"{task:06d}-{number:05d}")
                offsets.append(offset)
                records.append(record)
                offset += len(record)
            yield pa.RecordBatch.from_arrays([pa.array(archives, pa.string()), pa.array(offsets, pa.int64()), batch.column(0), batch.column(1), pa.array(records, pa.binary())], ["archive", "offset", "name", "url", "record"])

    return rows.mapInArrow(run, "archive string, offset bigint, name string, url string, record binary")


def write_warc(records: DataFrame, path: str) -> None:
    """Write the records of every archive, in order, as one WARC file under ``path``/archive=..."""
    body = F.expr("substring(record, 1, length(record) - 4)").cast("string").alias("value")
    ordered = records.repartition("archive").sortWithinPartitions("archive", "offset")
    ordered.select("archive", body).write.partitionBy("archive").option("lineSep", END.decode()).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of uncompressed WARC files: ``archive`` (the folder or file name), ``offset``, ``url`` and ``record``.

    A task reads one file at a time, whole, so files should stay below a few hundred MB, as :func:`write_warc` makes them. A record that
    is cut short, or does not start as one, is returned with what is left of the file; nothing is skipped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, at, rows = content.as_buffer().to_pybytes(), 0, ([], [], [], [])
                name = (re.search(r"/archive=([^/]+)/", name) or re.search(r"([^/]+)$", name))[1]
                while at < len(data):
                    head_end = data.find(END, at)
                    head = data[at : head_end if head_end >= 0 else len(data)]
                    size = LENGTH.search(head)
                    sound = head.startswith(b"WARC/") and head_end >= 0 and size
                    end = min(len(data), head_end + 4 + int(size[1]) + 4) if sound else len(data)
                    link = re.search(rb"^WARC-Target-URI:[ \t]*(.*?)\r?$", head, re.I | re.M)
                    for column, value in zip(rows, (name, at, link[1].decode("utf-8", "replace") if link else "", data[at:end]), strict=True):
                        column.append(value)
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.binary())], ["archive", "offset", "url", "record"])

    return files.mapInArrow(run, "archive string, offset bigint, url string, record binary")


def level_of(leaves: DataFrame, level: int, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """``archive``, ``node`` and ``hash`` of the nodes of a level; level 0 hashes the records of a range of offsets in order."""
    nodes = leaves.groupBy("archive", F.floor(F.col("offset") / span).alias("node")).agg(F.array_sort(F.collect_list(F.struct("offset", "digest"))).alias("of"))
    nodes = nodes.select("archive", "node", F.sha2(F.array_join(F.transform("of", lambda r: F.concat_ws(":", r["offset"], r["digest"])), ","), 256).alias("hash"))
    for _ in range(level):
        nodes = nodes.groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("of"))
        nodes = nodes.select("archive", F.col("up").alias("node"), F.sha2(F.array_join(F.transform("of", lambda r: F.concat_ws(":", r["node"], r["hash"])), ","), 256).alias("hash"))
    return nodes


def audit(a: DataFrame, b: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """Where two replicas differ: ``archive``, ``offset``, ``kind`` (changed, missing from b, or extra in b) and both digests.

    Each replica has one row per record: ``archive``, ``offset`` (as both were laid out) and ``digest``. Rows with a null among them are
    refused. An archive that only one side has is reported record by record; two empty replicas agree.
    """
    sides = []
    for side in (a, b):
        refuse = F.raise_error(F.lit("archive, offset and digest must not be null"))
        clean = side.select("archive", "offset", F.when(F.col("archive").isNull() | F.col("offset").isNull() | F.col("digest").isNull(), refuse).otherwise(F.col("digest")).alias("digest"))
        sides.append(clean)
    last = max(side.agg(F.max("offset")).first()[0] or 0 for side in sides)
    top, reach = 0, span
    while reach <= last:
        top, reach = top + 1, reach * fanout
    levels = []
    for side in sides:
        levels.append([materialise(level_of(side, 0, span, fanout), "nodes")])
        for _ in range(top):
            below = levels[-1][-1]
            up = below.groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("of"))
            levels[-1].append(materialise(up.select("archive", F.col("up").alias("node"), F.sha2(F.array_join(F.transform("of", lambda r: F.concat_ws(":", r["node"], r["hash"])), ","), 256).alias("hash")), "nodes"))
    differ = None
    for level in range(top, -1, -1):
        pair = [side[level] for side in levels]
        if differ is not None:
            parents = differ.withColumnRenamed("node", "parent")
            pair = [nodes.withColumn("parent", F.floor(F.col("node") / fanout)).join(parents, ["archive", "parent"], "semi").drop("parent") for nodes in pair]
        joined = pair[0].join(pair[1].withColumnRenamed("hash", "other"), ["archive", "node"], "full")
        differ = materialise(joined.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("archive", "node"), "differ")
    found = []
    for side, name in zip(sides, ("digest_a", "digest_b"), strict=True):
        rows = side.withColumn("node", F.floor(F.col("offset") / span)).join(differ, ["archive", "node"], "semi")
        found.append(rows.select("archive", "offset", F.col("digest").alias(name)))
    records = found[0].join(found[1], ["archive", "offset"], "full").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
    kind = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return records.select("archive", "offset", kind.alias("kind"), "digest_a", "digest_b")


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit an archive of all pages against a replica that lost, changed or cut short some records, as a digest of their ids decides."""
    records = archive_records(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    fate = F.when(F.col("name") != "", F.substring(F.md5("name"), 1, 2))
    size = F.length("record")
    damaged = F.when(fate == "00", F.concat(F.expr("substring(record, 1, length(record) - 1)"), F.unhex(F.lit("00")))).when(fate == "01", F.expr("substring(record, 1, length(record) - 8)")).otherwise(F.col("record"))
    leaves = records.select("archive", "offset", "name", "url", size.alias("length"), fate.alias("fate"), F.sha2("record", 256).alias("own"), F.sha2(damaged, 256).alias("copy"))
    leaves = materialise(leaves, "leaves")
    a = leaves.filter(~F.col("fate").eqNullSafe("03")).select("archive", "offset", F.col("own").alias("digest"))
    b = leaves.filter(~F.col("fate").eqNullSafe("02")).select("archive", "offset", F.col("copy").alias("digest"))
    return audit(a, b).join(leaves, ["archive", "offset"]).select(F.col("name").cast("bigint").alias("page_id"), "url", "kind")


OP3_SQL = """
SELECT page_id, coalesce(url, '') AS url, CASE substr(md5(page_id::VARCHAR), 1, 2) WHEN '02' THEN 'missing' WHEN '03' THEN 'extra' ELSE 'changed' END AS kind
FROM pages WHERE substr(md5(page_id::VARCHAR), 1, 2) IN ('00', '01', '02', '03')
"""
