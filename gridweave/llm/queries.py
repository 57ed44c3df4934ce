"""The registered queries, one for each operator, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm import chat, html, lattice, mixing, packing, pii, quality, simhash, urls, warc

#: Paths of the public vocabularies; operators take them as parameters.
PACKING_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
FERTILITY_VOCABULARIES = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens.

    The rank file is the same vocabulary as the JSON file, and strings of special tokens in a text are ordinary text, as the vocabularies'
    own notes recommend; the JSON file's library alone would give ``<|endoftext|>`` the id 50256.
    """
    return packing.packed(table(spark, sf_dir, "documents"), PACKING_VOCABULARY)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations, and one more whose texts hold the template's own control strings, and read them back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role")) for n, role in enumerate(("user", "assistant"))])).alias("t"))
    return chat.digests(chat.formatted(turns.unionByName(more.select("conv_id", "t.turn", "t.role", F.lit(hard).alias("text")))))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings with equal labels."""
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all sources to 150 % of all words with weights 3, 1, 2."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html.main_text(table(spark, sf_dir, "pages"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return urls.judged(table(spark, sf_dir, "pages"), urls.train(spark))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and fertility of all documents."""
    return quality.quality_figures(table(spark, sf_dir, "documents"), FERTILITY_VOCABULARIES)


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back and assembled."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_chat_formatting,
        op3_embedding_near_dedup,
        op4_mix_sources,
        op5_html_extraction,
        op6_url_filters,
        op7_quality_rules,
        op8_warc_transactions,
        op9_personal_data,
        op10_simhash_near_dedup,
    )
}
