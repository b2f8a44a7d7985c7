"""From raw documents to sampled pieces of a mixed, cleaned corpus.

Each stage works on all its predecessor kept and is stored as Parquet in the shared folder; the next one
reads it back, so a lost executor costs a part of one stage. All stages but the last return the columns
of ``documents``. Nulls, empty texts, ties and empty tables are handled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm.common import documents
from tallyfold.llm.line_dedup import line_dedup
from tallyfold.llm.mixing import mix
from tallyfold.llm.pieces import encode, read_model
from tallyfold.llm.quality_rules import quality_rules
from tallyfold.llm.shingle_join import keep_one
from tallyfold.scratch import materialise
from tallyfold.session import configure


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and the documents that lose too much by that or fail the word rules."""
    return quality_rules(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go."""
    return line_dedup(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    configure(spark)
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, pieces, lossless``, one row per taken copy."""
    configure(spark)
    return encode(docs, read_model())


STAGES = [
    ("quality_rules", clean),
    ("line_dedup", dedup_lines),
    ("shingle_join", dedup_documents),
    ("mix_sources", mix_sources),
    ("piece_sampling", sample_pieces),
]

#: Newton steps, components and hashed draws have no SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return materialise(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
