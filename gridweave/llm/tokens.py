"""Public vocabularies: rank files of byte-level ones, and models of pieces with byte fallback; one encoder per worker process and file."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import sentencepiece
import tiktoken

#: Split pattern of the byte-level vocabularies (fixed value, published with them).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text that are encoded at a time; cuts are made where they change no token.
SPAN = 200_000


@lru_cache(maxsize=8)
def ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file (base64 of the bytes, a space, the id, on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(number) for token, number in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=8)
def encoder(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(name=path, pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=8)
def piece_model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=8)
def raw_bytes(path: str) -> np.ndarray:
    """For each id, whether it is a single byte of a longer character: what a text falls back to when the vocabulary has no token."""
    if path.endswith(".model"):
        model = piece_model(path)
        return np.array([model.is_byte(i) and int(model.id_to_piece(i)[1:-1], 16) >= 0x80 for i in range(model.get_piece_size())], bool)
    table = ranks(path)
    out = np.zeros(max(table.values(), default=0) + 1, bool)
    for token, number in table.items():
        out[number] = len(token) == 1 and token[0] >= 0x80
    return out


def spans(text: str, size: int = SPAN) -> list[str]:
    """The text in pieces of about ``size`` characters, cut only before a lone space between two letters, where no token can cross."""
    out, at = [], 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut != -1 and not (text[cut - 1].isalpha() and text[cut + 1 : cut + 2].isalpha()):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def encode(text: str, path: str) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit integers; strings of special tokens are ordinary text."""
    if not text:
        return np.zeros(0, np.uint32)
    if path.endswith(".model"):
        return np.concatenate([np.array(piece_model(path).encode(part.encode("utf-8", "replace")), np.uint32) for part in spans(text)])
    parts = [encoder(path).encode_to_numpy(part, allowed_special=set(), disallowed_special=()) for part in spans(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)
