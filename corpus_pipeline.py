"""From raw documents to tokens: quality, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm import bpe, decontaminate, lines, quality, simhash
from gradlake.llm.common import table
from gradlake.session import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from the labels of ``docs``, does not reject."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line of ten characters or more in the first of its documents only; ``n_chars`` is that of the text left.

    The columns are those of ``docs``, found by place and exact spelling: others may have any names.
    """
    names = docs.columns
    plain = lines.without_repeats(docs).toDF(*(f"c{i}" for i in range(len(names) + 2)))
    length = F.char_length(f"c{names.index('text')}").cast("bigint")
    left = [length if n == "n_chars" else F.col(f"c{i}") for i, n in enumerate(names)]
    return plain.select(*(c.alias(f"d{i}") for i, c in enumerate(left))).toDF(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the fingerprints of three-word shingles link at two bits."""
    return simhash.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document, with digests of them and of the text they decode to."""
    return bpe.encode(docs, decoded=True).select(
        "doc_id", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding", encode),
]

#: SQL can express neither the classifier nor the fingerprints; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
