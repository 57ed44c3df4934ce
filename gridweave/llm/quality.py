"""Document quality by word counts and by the fertility of public tokenisers, with rejection bands per language or script."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.tokens import encode, raw_bytes
from gridweave.sources.workers import map_arrow

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Band:
    """Limits within which a text is kept, for each of the vocabularies.

    ``least_chars`` and ``most_chars`` bound the characters per token, ``most_raw`` the share of tokens that are byte fallbacks, and ``slack``
    is taken from the entropy that a text of its length must reach.
    """

    least_chars: tuple[float, ...]
    most_raw: tuple[float, ...]
    most_chars: float = 7.0
    slack: float = 0.0


#: Bands by language, from ``fit`` on half of the labelled texts; those by script hold for any other language and are wide.
BANDS: dict[str, Band] = {
    "de": Band((2.423, 2.276), (0.05, 0.05)),
    "en": Band((2.27, 2.116), (0.05, 0.05)),
    "es": Band((2.206, 2.044), (0.05, 0.05)),
    "fr": Band((2.036, 1.92), (0.05, 0.05)),
    "latin": Band((1.80, 1.80), (0.15, 0.15)),
    "other": Band((0.45, 0.40), (0.60, 0.95), slack=1.5),
}
#: For each vocabulary, the least token entropy in bits at a binary logarithm of the number of tokens (first row), linear between; from ``fit``.
ENTROPY_FLOORS = (
    ((6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0, 13.0, 14.0), (5.64, 5.64, 5.64, 5.89, 6.14, 6.24, 6.46, 6.54, 6.57)),
    ((7.0, 8.0, 9.0, 10.0, 11.0, 12.0, 13.0, 14.0), (5.34, 5.53, 5.85, 6.05, 6.18, 6.36, 6.42, 6.45)),
)

FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, chars_per_token double, raw_share double, entropy double, chars_per_token_2 double, raw_share_2 double, entropy_2 double"


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words which the text has twice or more, the first one included."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(index) + ids[1:]
    if len(index) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, which, counts = np.unique(pairs[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    marked = np.zeros(len(words), bool)
    for shift in range(3):
        marked[shift : len(words) - 2 + shift] |= twice
    return int(marked.sum())


def word_figures(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, repeated words."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, SPACES))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def fertility(text: str | None, vocabulary: str) -> tuple[float, float, float, int]:
    """Characters per token, share of single-byte fallbacks, token entropy in bits, number of tokens; zeros without tokens."""
    ids = encode(text or "", vocabulary)
    if not len(ids):
        return 0.0, 0.0, 0.0, 0
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    return len(text) / len(ids), float(raw_bytes(vocabulary)[ids].mean()), float(-(share * np.log2(share)).sum()), len(ids)


def script(text: str) -> str:
    """``latin`` if at least half of all letters of the whole text are below U+0250, else ``other``; ``latin`` without letters."""
    codes, counts = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)
    letters = np.array([chr(c).isalpha() for c in codes.tolist()], bool)
    return "latin" if 2 * counts[letters & (codes < 0x250)].sum() >= counts[letters].sum() else "other"


def within(figures: list[tuple[float, float, float, int]], band: Band) -> bool:
    """Whether a text's figures by all vocabularies lie in a band."""
    return all(
        least <= chars <= band.most_chars and raw <= most and entropy >= np.interp(np.log2(max(tokens, 1)), *floor) - band.slack
        for (chars, raw, entropy, tokens), least, most, floor in zip(figures, band.least_chars, band.most_raw, ENTROPY_FLOORS)
    )


def fit(rows: Iterable[tuple[str, list[tuple[float, float, float, int]]]], most: int = 10_000, spare: float = 0.04) -> tuple[dict[str, Band], tuple]:
    """Bands and entropy floors from the language and figures of texts labelled good, ``most`` of them at most.

    A language's least characters per token are the lowest of its texts, its most fallbacks twice the highest share (or a twentieth), and the
    floor at each whole logarithm is the lowest entropy of the texts about it, all with ``spare`` to spare; floors never fall with length.
    """
    known = list(islice(rows, most))
    bands, floors = {}, []
    for lang in sorted({lang for lang, _ in known}):
        own = [figures for g, figures in known if g == lang]
        bands[lang] = Band(*(tuple(round(float(x), 3) for x in xs) for xs in zip(*[(min(f[v][0] for f in own) * (1 - spare), max(0.05, 2 * max(f[v][1] for f in own))) for v in range(len(own[0]))])))
    for v in range(len(known[0][1])):
        at, low = [], []
        for bits in range(4, 17):
            near = [f[v][2] for _, f in known if abs(np.log2(max(f[v][3], 1)) - bits) <= 0.75]
            if near:
                at.append(float(bits))
                low.append(round(max([*low, min(near) * (1 - spare)]), 2))
        floors.append((tuple(at), tuple(low)))
    return bands, tuple(floors)


def judge(text: str | None, lang: str | None, vocabularies: tuple[str, ...], bands: Mapping[str, Band]) -> tuple:
    """The fields of ``FIELDS`` for one text."""
    words, chars, symbols, lines, repeats = word_figures(text)
    failed = words < 50 or 100 * repeats > 50 * words
    first = fertility(text, vocabularies[0])
    band = bands.get(lang or "") or bands[script(text or "")]
    # a text that is rejected already needs no second opinion
    second = None if failed or not within([first], band) else fertility(text, vocabularies[1])
    return words, chars, symbols, lines, repeats, failed, second is not None and within([first, second], band), *first[:3], *(second[:3] if second else (None,) * 3)


def quality_figures(docs: DataFrame, vocabularies: tuple[str, str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """One row per row of ``docs``: the id and ``FIELDS``.

    ``kept`` is false where the counts fail (under 50 words, or more than half of them in repeated windows of three),
    else whether characters per token, byte-fallback share and token entropy lie in the band of the row's language
    or, without one, of the text's script. Null and empty texts have zero everywhere and fail; a null language has the
    band of its script. Rows are judged one by one: repeated rows get equal results, null ids stay, no rows
    give no rows, and other columns are ignored. ``vocabularies`` are paths that all workers have, of a byte-level rank file and of a
    piece model with byte fallback; a text has to lie in the band by both, and the second is only measured (else null) where the first and
    the counts leave the text in.
    """
    kept = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    bands = dict(bands)
    names = [field.split()[0] for field in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t.as_py(), g.as_py(), vocabularies, bands) for t, g in zip(batch.column(1), batch.column(2))]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 6
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows) if rows else [()] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *names])

    return map_arrow(kept, run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, {FIELDS}")


def keep_good(docs: DataFrame, vocabularies: tuple[str, str], text_col: str = "text", lang_col: str = "lang", bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """The rows of ``docs`` that ``quality_figures`` keeps, with all their columns unchanged, whatever these are called.

    Null and empty texts go; a null language has the band of its script; repeated rows are kept or go together; null ids stay; no rows
    give no rows; very long texts are judged whole.
    """
    bands = dict(bands)
    at, by = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [judge(t.as_py(), g.as_py(), vocabularies, bands)[6] for t, g in zip(batch.column(at), batch.column(by))]
            yield batch.filter(pa.array(good, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
