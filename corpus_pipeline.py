"""From raw documents to token ids: each stage works on all that its predecessor kept.

Every stage takes NULL ids, NULL, empty and very long texts and further columns. Rows
without a judgeable word go in the first stage; of rows that repeat an id and a text one
stays in the second; rows of one id and different texts are told apart by the text. An
empty table leaves an empty table.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import bpe, copies, language, leaks, private
from silverlode.llm.common import importable, without
from silverlode.llm.queries import tokenizer_spec
from silverlode.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the labelled texts speak; those that cannot be judged go."""
    seen = language.judged(language.document_rows(docs), language.learned_from(docs))
    return without(docs, seen.where("not accepted"), "doc_id", "text")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, also where ids repeat or are missing."""
    return copies.one_of_each(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return without(docs, leaks.hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "doc_id", "text")


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by the kind; n_chars follows the text."""
    return private.masked(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of encoding and decoding every document that is left."""
    return bpe.encode_round_trip(docs, tokenizer_spec())


def _ready(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language", _ready(known_language)),
    ("near_duplicates", _ready(one_of_each)),
    ("decontamination", _ready(unleaked)),
    ("private_data", _ready(masked)),
    ("tokens", _ready(tokens)),
]

#: The stages learn models, decode sequences and encode texts, which SQL cannot say; the
#: tests compare each of them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order, each result written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
