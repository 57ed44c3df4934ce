import random
from pathlib import Path

import public_tokenizers

from gridweave.llm import quality

VOCABULARY = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))
#: Natural English, for want of any other text of some length: the opening of the vocabularies' licences.
PROSE = Path(public_tokenizers.path("LICENSES.txt")).read_text(encoding="utf-8")[10500:13000]
SCHEMA = "doc_id long, text string, lang string, n_words string, kept string"


def brute(text):
    import re

    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, seen, twice = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(marked)


def test_word_figures():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a ", "bé\u00a0 ", "c\u2003 ", "#* ", "\n", "\r\n", "a b c\n", "\x1c", "漢 ", "\x0b"]) for _ in range(rng.randint(0, 60)))
        assert quality.word_figures(text) == brute(text), repr(text)
    assert quality.word_figures(None) == (0, 0, 0, 0, 0)


def test_junk_is_told_from_prose():
    rng = random.Random(2)
    prose = PROSE
    assert quality.judge(prose, "en", VOCABULARY, quality.BANDS)[6]
    junk = ["$$$ %%% ### " * 40 + prose[:300], "".join(rng.choice("qzxjkvw0123456789") for _ in range(700)) + prose[:400], "WHY! " * 400]
    assert not any(quality.judge(t, "en", VOCABULARY, quality.BANDS)[6] for t in junk)
    long_words = " ".join("".join(chr(0x4E00 + rng.randrange(900)) for _ in range(3)) for i in range(200))
    assert quality.script(long_words) == "other" and quality.script(prose) == "latin" and quality.judge(long_words, None, VOCABULARY, quality.BANDS)[6]


def test_rows(spark):
    rows = [(1, "x " * 80, "en", "c", "c"), (1, "x " * 80, "en", "c", "c"), (2, None, None, "c", "c"), (None, "", "xx", "c", "c"), (3, "word " * 40_000, "de", "c", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality.quality_figures(df, VOCABULARY).collect())
    assert got == [("1", 80, 80, True, False)] * 2 + [("2", 0, 0, True, False), ("3", 40_000, 40_000, True, False), ("None", 0, 0, True, False)]
    assert quality.quality_figures(df.limit(0), VOCABULARY).count() == 0
    mixed = spark.createDataFrame([*rows, (9, PROSE, "en", "c", "c")], SCHEMA)
    kept = quality.keep_good(mixed, VOCABULARY)
    assert kept.columns == mixed.columns and [r["doc_id"] for r in kept.collect()] == [9]


def test_script_reads_whole_texts():
    mixed = ("a" + "я" * 7) * 4000
    assert quality.script(mixed) == "other" and quality.script(mixed.replace("я", "é")) == "latin" and quality.script("12 !?") == "latin" and quality.script("\ud800") == "latin"
    # letters at every fourth place only, as a strided sample would see them
    assert quality.script("aяяя" * 20_000) == "other"


def test_byte_fallback_is_measured():
    rare = " ".join("".join(chr(0x13000 + i * 7 % 900) for i in range(k, k + 3)) for k in range(80))
    figures = [quality.fertility(rare, path) for path in VOCABULARY]
    assert figures[1][1] > 0.7 and not quality.judge(rare, None, VOCABULARY, quality.BANDS)[6]
    text = PROSE * 200
    assert quality.fertility(text, VOCABULARY[1])[3] > 100_000


def test_bands_are_fitted_on_half_and_hold_on_the_other():
    import duckdb

    rows = duckdb.sql("SELECT DISTINCT ON (doc_id) d.doc_id, text, lang, quality FROM '/root/testdata/sf0.01/documents.parquet' d JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id) WHERE text IS NOT NULL").fetchall()
    kept = {q: [quality.judge(t, g, VOCABULARY, quality.BANDS)[5:7] for i, t, g, own in rows if own == q and i % 2] for q in (0, 1)}
    passing = {q: [good for failed, good in found if not failed] for q, found in kept.items()}
    assert sum(passing[1]) >= 0.97 * len(passing[1]) and sum(passing[0]) <= 0.25 * len(passing[0])
    made = [(g, [quality.fertility(t, path) for path in VOCABULARY]) for i, t, g, own in rows if own and not quality.judge(t, g, VOCABULARY, quality.BANDS)[5]]
    bands, floors = quality.fit(made, most=len(made))
    assert all(bands[g].least_chars[0] <= f[0][0] for g, f in made) and len(floors) == 2 and all(list(low) == sorted(low) for _, low in floors)
