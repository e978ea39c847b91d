"""From raw documents to token ids in five stages.

1. quality: importance resampling against the labelled good documents; what it rejects goes.
2. exact_dedup: of equal texts the row with the largest id stays.
3. near_dedup: of each group of similar texts one document stays.
4. mix: sources are brought to their target weights, whole documents repeated up to three times.
5. pieces: the ids of the SentencePiece vocabulary, checked against the library.

Each stage takes what its predecessor kept, as written tables. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableops.llm import exact_dedup, minhash, mixing, pieces, quality
from tableops.llm.common import Stage, documents
from tableops.llm.queries import PIECE_MODEL
from tableops.session import read_table


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.Resampler(docs, read_table(spark, sf_dir, "labels")).selected()


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids in place of the text."""
    return pieces.encode(docs, PIECE_MODEL, check=True).drop("text")


STAGES = [
    ("quality", select_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pieces", to_pieces),
]

#: SQL has no counterpart of the models and samples in the stages; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    stage = Stage(spark, "corpus-pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, function) in enumerate(STAGES):
        docs = stage.write(function(spark, docs, sf_dir), name)
        if k:
            stage.drop(STAGES[k - 1][0])
    return docs
