"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all documents its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from encore.llm import decontamination, language, mixing, near_duplicates, substrings
from encore.sources.tables import materialize, read_table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID learnt from the documents' own labels; documents whose language is rejected go."""
    return language.keep_identified(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_duplicates.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text that repeats earlier text is cut out; n_chars is set anew."""
    return substrings.without_repeats(docs, length_col="n_chars")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontamination.drop_contaminated(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards even sources, in global random order."""
    return mixing.mix(docs, mixing.source_rates(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: Compression, links found by hashing and their components: SQL can't express the first two stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
