"""The corpus pipeline, stage by stage, against brute force on a small table."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridweave.llm import crf, pii, quality
from gridweave.sources.scratch import written

from .test_packing import check
from .test_simhash import brute_components

SF = "/root/testdata/sf0.001"
VOCABULARY = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "stage"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "mixing", "packing"]
    assert all(df.dtypes == stages[0].dtypes for df in stages[:-1])


def test_quality(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) == {i for i, r in before.items() if quality.judge(r["text"], r["lang"], VOCABULARY, quality.BANDS)[6]} and len(after) > 0.7 * len(before)


def test_near_duplicates(stages):
    before, after = rows(stages[1]), rows(stages[2])
    groups = brute_components([(i, r["text"]) for i, r in sorted(before.items())])
    assert set(after) == {c for _, c in groups.values()} and all(after[i] == before[i] for i in after)


def test_personal_data(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after)
    found = pii.find([before[i]["text"] for i in after], crf.train())
    assert sum(bool(b or m) for b, m in found) > 0
    for (i, r), (base, more) in zip(after.items(), found):
        assert r["text"] == pii.redacted(before[i]["text"], base + more) and r["n_chars"] == len(r["text"]) and not pii.base_spans(r["text"])


def test_mixing(stages):
    before = rows(stages[3])
    counts = {r["doc_id"]: r["n"] for r in stages[4].groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(counts) <= set(before) and set(counts.values()) <= {1, 2}
    words = lambda i: len(before[i]["text"].split())
    total, taken = sum(map(words, before)), sum(n * words(i) for i, n in counts.items())
    assert abs(taken - 1.5 * total) < 0.1 * total


def test_sources_meet_their_targets(spark):
    texts = [(i, f"w{i} " * 1000, "en", "abc"[i % 3], 1) for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["source"]: r["n"] for r in corpus_pipeline.mix_sources(spark, docs, SF).groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(got["a"] - 600) <= 20 and abs(got["b"] - 250) <= 20 and abs(got["c"] - 500) <= 20, got


def test_packing(stages):
    docs = [(r["doc_id"], r["text"]) for r in stages[4].collect()]
    unique = dict(docs)
    placed = stages[5].collect()
    assert len({(r["sequence_id"], r["offset"]) for r in placed}) == len(placed)
    bins, bound = check(corpus_pipeline.pack(stages[0].sparkSession, stages[4].dropDuplicates(["doc_id"]), SF).collect(), list(unique.items()), 2048)
    assert bins <= bound * 1.02 + 1
    assert sum(r["piece"] == 0 for r in placed) == len(docs)


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[5].count()


def test_stages_on_odd_tables(spark):
    """Nulls in any column, no text, a very long text, repeated rows, clashing names; and no rows at all."""
    good = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 2000 AND lang = 'en'").orderBy("doc_id").first()["text"]
    rows = [(1, good, "en", "a", 5, "x", 1), (1, good, "en", "a", 5, "x", 1), (2, None, None, None, None, None, None), (3, "", "en", "a", 0, "", 0), (None, good + " again", None, None, None, "y", 2), (4, good * 30, "xx", "b", 9, "z", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, gone string, judged int"
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF).collect()
            assert bool(out) == bool(table.count())
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect())[:2] == ["1", "1"]
    once = [str(r["doc_id"]) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()]
    assert once.count("1") == 1 and once.count("2") == 1 and "3" not in once and "None" in once
    assert corpus_pipeline.personal_data(spark, docs, SF).where("text IS NULL").count() == 1
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.where("text IS NULL OR text = ''").count() == 0
    assert corpus_pipeline.pack(spark, docs, SF).where("piece = 0").count() == len(rows)
