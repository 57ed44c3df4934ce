"""A corpus pipeline over ``documents``: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; between stages the rows are a Parquet
table in the shared folder. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridweave.llm import mixing, packing, pii, quality, simhash
from gridweave.llm.queries import FERTILITY_VOCABULARIES, PACKING_VOCABULARY
from gridweave.sources.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the word counts and lie in the fertility band of their language; the others go, null and empty texts among them.

    Repeated rows go or stay together, null ids and other columns stay as they are, no rows give no rows.
    """
    return quality.keep_good(docs, FERTILITY_VOCABULARIES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: that with the smallest id, once if it is repeated.

    Rows without an id all stay; rows that share an id are told apart by their texts; null and empty texts, which earlier stages drop,
    would be near copies of each other; no rows give no rows.
    """
    return simhash.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with spans of personal data replaced by their kind and ``n_chars`` set anew; null texts stay null, repeated rows alike."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, fractions of copies drawn by a seeded hash, so that sources meet their targets.

    A null source is one source, rows without words are not taken, repeated rows are taken alike, no rows give no rows.
    """
    return mixing.take_mix(docs, drawn=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all rows' pieces in sequences of 2048 tokens; a null or empty text is a piece of one token, repeated rows have pieces of their own."""
    return packing.packed(docs, PACKING_VOCABULARY)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_dedup), ("personal data", personal_data), ("mixing", mix_sources), ("packing", pack)]

#: SQL has no tokenisers, so no statement can give the rows of ``run``; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``. An empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
