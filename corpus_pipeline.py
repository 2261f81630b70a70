"""From raw documents to token ids: quality, lines, near-duplicates, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``. The sizes and limits are those of the registered
queries.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import lines, mixing, pieces, quality, simhash
from hearth.llm.queries import MAX_BITS, MODEL, SHINGLE, piece_digests
from hearth.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose base or posterior fails go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of like lines one occurrence stays; ``n_chars`` is counted anew."""
    return lines.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one with the smallest id stays."""
    return simhash.keep_one(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and digests of ids and decoded text."""
    model = public_tokenizers.path(MODEL)
    rows = pieces.decode(pieces.encode(docs, model), model)
    return rows.select(*docs.columns, "ids", *piece_digests())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

# SQL can't express the votes' EM, SimHash links or BPE merges: tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs
