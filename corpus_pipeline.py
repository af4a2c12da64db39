"""The corpus pipeline: documents in, shards of a clean and mixed corpus out.

``STAGES`` are applied in order, each to all rows its predecessor kept. Every
stage's result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trajlake.llm import decontaminate, hyper_shuffle, lang_backoff, pivotal_mix, simhash_bits
from trajlake.llm.queries import SHARDS
from trajlake.llm.shared import table, write_stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known; the model learns from the stage's labelled rows.

    Rows with a null, empty or letterless text are rejected, and those whose best language has less than half of the
    probability; a null lang teaches nothing, and neither does a table
    without labels, from which no row is kept. Very long texts are scored whole; equal texts get one language; an
    empty table stays empty; other columns pass through.
    """
    return lang_backoff.drop_unidentified(docs, lang_backoff.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component (3-word shingles, 2 bits): the one with the smallest doc_id.

    Null ids come last, and repeated ids count by their place in the table; texts without words are one component; an
    empty table stays empty; other columns pass through, whatever their names.
    """
    return simhash_bits.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a near copy of a benchmark item.

    Null and empty texts hold none and stay, and so do all documents if the benchmark is empty; null items and items
    of fewer than 12 normalised characters match nothing; every row is judged alone, repeated ones alike.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources come near their target words (0 to 2 copies of each).

    A null source is a source of its own; a text without words has size 0 and is repeated at its source's whole rate;
    repeated rows are rounded apart; an empty table stays empty.
    """
    return pivotal_mix.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the shard and slot of a uniform shuffle into shards of equal row counts.

    Copies are dealt like other rows; null texts and ids have places of their own; columns of the input called like
    the new ones are replaced; with fewer rows than shards some stay empty; an empty table stays empty.
    """
    return hyper_shuffle.attach_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return docs


#: SQL cannot express the hashing and the random draws; tests hold every stage against brute force.
ORACLE_SQL: str | None = None
