"""Personal data: patterns for four kinds, and a skip-chain random field that adds what they miss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm import crf
from gridweave.llm.common import slices
from gridweave.sources.workers import map_arrow

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIM = ".,;:!?\"'()[]{}<>#*$%&|=`"

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, ``@``, and a domain of two or more labels; linear in the text."""
    done, at = 0, text.find("@")
    while at != -1:
        found = _DOMAIN.match(text, at)
        start = at
        if found:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if found and start < at:
            yield "email", start, found.end()
            done = found.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) in code points of the four pattern kinds, by kind and then start."""
    out = list(emails(text))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m.group().split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and crf.luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def joined(spans: list[Span]) -> str:
    order = {kind: i for i, kind in enumerate(KINDS)}
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1])))


def method_spans(text: str, tokens: list[crf.Token], labels: list[int], base: list[Span]) -> list[Span]:
    """Runs of neighbouring tokens with one label, less outer punctuation, that overlap no pattern span."""
    runs: list[list] = []
    for token, label in zip(tokens, labels):
        if not label:
            continue
        kind = crf.LABELS[label]
        if runs and token.touches and runs[-1][0] == kind and kind in ("card", "phone") and runs[-1][3] == token.start - 1:
            runs[-1][2] = runs[-1][3] = token.end
        else:
            runs.append([kind, token.start, token.end, token.end])
    taken = sorted((a, b) for _, a, b in base)
    out, i = [], 0
    for kind, start, end, _ in runs:
        while start < end and text[start] in _TRIM and not (kind == "phone" and text[start] == "("):
            start += 1
        while start < end and text[end - 1] in _TRIM:
            end -= 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start < end and not (i < len(taken) and taken[i][0] < end):
            out.append((kind, start, end))
    return out


def find(texts: list[str | None], model: crf.Model) -> list[tuple[list[Span], list[Span]]]:
    """For each text its pattern spans and the spans that the random field adds."""
    texts = [t or "" for t in texts]
    tokens = [crf.candidates(t) for t in texts]
    base = [base_spans(t) if k else [] for t, k in zip(texts, tokens)]  # every kind has a digit or an at sign, and so a candidate
    return [(b, method_spans(t, k, y, b)) for t, k, y, b in zip(texts, tokens, crf.decode(model, tokens), base)]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: crf.Model | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_email n_ip n_card n_phone`` (pattern spans), ``n_secret`` and ``n_added`` (spans of the
    random field), ``base_sha256`` of the pattern spans and ``spans``, all spans as ``kind:start:end``.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Rows are judged one by one, so repeated rows get
    equal results; null ids stay; no rows give no rows; other columns are ignored. Whole texts are searched in linear time.
    """
    kept = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    model = model or crf.train()
    names = [id_col, "n_email", "n_ip", "n_card", "n_phone", "n_secret", "n_added", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = find(batch.column(1).to_pylist(), model)
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS[:4]]
            secrets = pa.array([sum(s[0] == "secret" for s in more) for _, more in found], pa.int64())
            added = pa.array([len(more) for _, more in found], pa.int64())
            digest = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            spans = pa.array([joined(base + more) for base, more in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, secrets, added, digest, spans], names=names)

    return map_arrow(kept, run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, n_secret bigint, n_added bigint, base_sha256 string, spans string")


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in square brackets; of overlapping spans the union is replaced once, by the first kind."""
    if not spans:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", model: crf.Model | None = None) -> DataFrame:
    """``docs`` with all spans replaced and, where there is such a column, the length set anew.

    Null texts stay null and have no length; empty texts stay; rows are judged one by one, so repeated rows get equal texts; null ids
    stay; very long texts are searched whole; no rows give no rows; other columns are unchanged, whatever these are called.
    """
    model = model or crf.train()
    schema = docs.schema
    at = docs.columns.index(text_col)
    size = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            texts = [redacted(t, base + more) for t, (base, more) in zip(texts, find(texts, model))]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if size is not None:
                columns[size] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, run, schema)
