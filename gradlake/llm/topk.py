"""Exact top-k search by term-at-a-time accumulation.

Vectors are turned into whole numbers. Candidates lie in blocks with postings: per term the rows that hold it and their weights.
A block of query rows walks through the terms; each adds weight times posting to a dense array of scores, one row per query. The
best k of a block are found by partition selection, and those of all blocks are merged by a second one.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradlake.llm.common import pick, table
from gradlake.session import materialise

SCALE = 1024
#: Rows of a candidate block and of a query block; a task holds one block of each and a score for every pair.
BLOCK_ROWS, QUERY_ROWS = 4096, 256
#: Rows of a block of vectors with large components.
LARGE_ROWS = 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def whole(vectors: list[list[float]]) -> list[list[int]]:
    """floor(1024 x) of every component, exact for any finite double."""
    return [[math.floor(Fraction(x) * SCALE) if abs(x) > 2.0**900 else math.floor(x * SCALE) for x in v] for v in vectors]


def dense(vectors: list[list[int]]) -> np.ndarray:
    """Rows of equal width, zeros behind shorter vectors."""
    out = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def is_large(vector: list[int]) -> bool:
    """Whether a product with a vector that is not large could leave 64 bits."""
    return max(map(abs, vector), default=0) ** 2 * len(vector) >= 1 << 62


def blocks(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Rows packed into blocks: ``name`` (a number unique per block), ``ids`` and ``weights`` as packed 64-bit integers.

    Vectors with large components lie in blocks of their own, a few each, whose whole numbers are ``texts`` instead.
    """

    def pack(ids: list[int], vectors: list[list[int]], large: bool) -> pa.RecordBatch:
        weights = None if large else dense(vectors).astype("<i8").tobytes()
        texts = [" ".join(map(str, v)) for v in vectors] if large else None
        columns = [pa.array([np.array(ids, "<i8").tobytes()]), pa.array([weights], pa.binary()), pa.array([texts], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["ids", "weights", "texts"])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids, vectors = part.column(0).to_pylist(), whole(part.column(1).to_pylist())
                odd = {i for i, v in enumerate(vectors) if is_large(v)}
                plain = [i for i in range(len(ids)) if i not in odd]
                if plain:
                    yield pack([ids[i] for i in plain], [vectors[i] for i in plain], False)
                few = sorted(odd)
                for at in range(0, len(few), LARGE_ROWS):
                    yield pack([ids[i] for i in few[at : at + LARGE_ROWS]], [vectors[i] for i in few[at : at + LARGE_ROWS]], True)

    packed = materialise(df.mapInArrow(run, "ids binary, weights binary, texts array<string>"), name)
    return materialise(packed.select(F.monotonically_increasing_id().alias(name), "ids", "weights", "texts"), name)


def unpacked(weights: pa.Scalar, texts: pa.Scalar, rows: int) -> np.ndarray:
    """The matrix of a block; one of large components holds Python integers."""
    if weights.is_valid:
        return np.frombuffer(weights.as_buffer(), "<i8").reshape(rows, -1)
    vectors = [[int(x) for x in t.split()] for t in texts.as_py()]
    out = np.zeros((rows, max(map(len, vectors), default=0)), object)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def accumulate(queries: np.ndarray, postings: list[tuple[np.ndarray | slice, np.ndarray]], rows: int) -> np.ndarray:
    """Scores of all pairs, one term at a time; exact in 64 bits, or in Python integers where a side has large components."""
    wide = queries.dtype == object or any(w.dtype == object for _, w in postings)
    scores = np.zeros((len(queries), rows), object if wide else np.int64)
    queries, postings = (queries.astype(object), [(r, w.astype(object)) for r, w in postings]) if wide else (queries, postings)
    for term in range(min(queries.shape[1], len(postings))):
        where, weights = postings[term]
        having = np.flatnonzero(queries[:, term])
        for q in having.tolist():
            scores[q, where] += queries[q, term] * weights
    return scores


def postings_of(matrix: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Per term the rows with a weight other than zero; a term of every row is a plain run."""
    found = []
    for column in matrix.T:
        rows = np.flatnonzero(column)
        found.append((slice(0, len(column)), np.ascontiguousarray(column)) if len(rows) == len(column) else (rows, column[rows]))
    return found


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best scores among rows with another id, ties to the smaller id."""
    rows = np.flatnonzero(ids != own)
    if scores.dtype == object:
        return np.array(sorted(rows.tolist(), key=lambda r: (-scores[r], ids[r]))[:k], np.int64)
    if len(rows) > k:
        bound = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
        above, equal = rows[scores[rows] > bound], rows[scores[rows] == bound]
        equal = equal[np.argsort(ids[equal], kind="stable")][: k - len(above)]
        rows = np.concatenate([above, equal])
    return rows[np.lexsort((ids[rows], -scores[rows]))]


def top_k(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = 10, query_every: int = 100, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k rows with the highest integer inner product per query row.

    Queries are the rows whose id is divisible by ``query_every``. Candidates are all rows with another id. Rows without an id or vector,
    or with a component that is null or not finite, take no part. A shorter vector counts as zero where it has no component. Repeated
    rows count one by one, as candidates and as queries. Ids are integers. Other columns are left out. Components are turned into whole numbers
    exactly, whatever their size; only a score among the ``k`` highest that does not fit 64 bits is an error.
    """
    rows = pick(df, id=id_column, vector=vector).select(F.col("id").cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.filter("id is not null and vector is not null")
    rows = rows.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    candidates = blocks(rows, block_rows, "part")
    queries = blocks(rows.filter(F.pmod("id", F.lit(query_every)) == 0), query_rows, "asked")
    # every block of queries meets every block of candidates; each pair of blocks is a key of its own
    parts, asked = candidates.select("part"), queries.select("asked")
    pairs = asked.join(parts, how="cross")
    met = pairs.join(queries.withColumnsRenamed({"ids": "q_ids", "weights": "q_weights", "texts": "q_texts"}), "asked").join(candidates, "part")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, ids = (np.frombuffer(batch.column(n)[row].as_buffer(), "<i8") for n in ("q_ids", "ids"))
                asked_block = batch.column("asked")[row].as_py()
                wanted, matrix = (unpacked(batch.column(w)[row], batch.column(t)[row], len(i)) for w, t, i in (("q_weights", "q_texts", q_ids), ("weights", "texts", ids)))
                scores = accumulate(wanted, postings_of(matrix), len(ids))
                out = [[], [], [], [], [], []]
                for q, own in enumerate(q_ids.tolist()):
                    found = best(scores[q], ids, own, k)
                    exact = scores[q, found].tolist()
                    held = [max(LOWEST, min(HIGHEST, s)) for s in exact]
                    over = [a != b for a, b in zip(held, exact, strict=True)]
                    for column, values in zip(out, ([asked_block] * len(found), [q] * len(found), [own] * len(found), ids[found].tolist(), held, over), strict=True):
                        column.extend(values)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:-1]), pa.array(out[-1], pa.bool_())], ["asked", "place", "query_id", "vec_id", "score", "over"])

    columns = ["asked", "part", "q_ids", "q_weights", "q_texts", "ids", "weights", "texts"]
    found = met.select(*columns).mapInArrow(run, "asked bigint, place bigint, query_id bigint, vec_id bigint, score bigint, over boolean")
    order = Window.partitionBy("asked", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    score = F.when(F.col("over"), F.raise_error(F.lit("a score among the highest does not fit 64 bits")).cast("bigint")).otherwise(F.col("score"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth embedding."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
WHERE rank <= 10
"""
