"""A corpus made ready for training: good documents, one of each group of near copies,
without benchmark items, cut into pieces.

Each stage works on what the stage before it kept; ``run`` writes every stage's rows to
the shared folder and reads them back, so no stage is worked out twice and a lost
executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linksift.llm.common import table, tokenizer_file, written
from linksift.llm.decontaminate import clean_documents
from linksift.llm.jaccard_join import one_of_each_group
from linksift.llm.pieces import encode_pieces
from linksift.llm.quality import good_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    return good_documents(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.75 the document with the smallest id."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document: doc_id, n_pieces, ids_crc32, lossless, piece_ids."""
    return encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"), seed=17)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pieces", piece_ids),
]

#: Boosted tables and tokenizer models are beyond SQL; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
