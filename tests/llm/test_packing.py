import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from gridweave.llm import packing, tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, length string, sequence_id string, _rank int"


def texts():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghé漢 ") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 40, 300, 900]))) for _ in range(60)] + [None, "", "x" * 5000, " " * 3000, "<|endoftext|> a", "\r\n\t\v"]


def test_ids_are_those_of_the_tokenizers_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in texts():
        assert tokens.encode(text or "", VOCABULARY).tolist() == other.encode(text or "", add_special_tokens=False).ids


def test_cuts_change_no_token():
    text = " ".join(t for t in texts() if t)
    whole = tokens.encoder(VOCABULARY).encode_ordinary(text)
    parts = tokens.spans(text, 500)
    assert len(parts) > 20 and "".join(parts) == text
    assert [i for part in parts for i in tokens.encoder(VOCABULARY).encode_ordinary(part)] == whole


def check(rows, docs, capacity):
    ids = {i: [*tokens.encode(t or "", VOCABULARY).tolist(), 0] for i, t in docs}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        at = 0
        for n, r in enumerate(own):
            part = np.array(ids[i][at : at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part.tobytes()))
            assert r["length"] == capacity or n == 0
            at += r["length"]
        assert at == len(ids[i]) and (len(own) == 1) == (at <= capacity)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(map(len, ids.values())) // capacity)


def test_every_piece_has_its_place(spark):
    docs = list(enumerate(texts()))
    table = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in docs], SCHEMA)
    bins, bound = check(packing.packed(table, VOCABULARY, 512).collect(), docs, 512)
    assert bins <= bound * 1.03 + 1
    assert packing.packed(table.limit(0), VOCABULARY).count() == 0
    twice = packing.packed(table.limit(3).union(table.limit(3)), VOCABULARY)
    assert twice.count() == 6 and twice.select("sequence_id", "offset").distinct().count() == 6


@pytest.mark.parametrize("seed", range(4))
def test_plans_cover_the_histogram(seed):
    rng = np.random.default_rng(seed)
    sizes = np.clip(rng.lognormal(5.2, 1.0, 4000).astype(int) + 1, 1, 2048)
    histogram = {int(s): int(n) for s, n in zip(*np.unique(sizes, return_counts=True))}
    plan = packing.plan(histogram)
    size = np.repeat(list(histogram), list(histogram.values()))
    rank = np.concatenate([np.arange(n) for n in histogram.values()])
    sequence, offset = plan.place(size, rank)
    fill = np.bincount(sequence, size, plan.bins)
    assert fill.max() <= 2048 and fill.sum() == sizes.sum() and fill.min() > 0
    order = np.lexsort((offset, sequence))
    expected = np.where(np.diff(sequence[order], prepend=-1) != 0, 0, np.roll(offset[order] + size[order], 1))
    assert (offset[order] == expected).all()
    assert plan.bins <= 1.01 * sizes.sum() / 2048 + 2


@pytest.mark.parametrize("histogram,bins", [({}, 0), ({5: 1}, 1), ({2048: 7}, 7), ({1025: 6, 1023: 6}, 6), ({700: 9}, 5), ({1: 4096}, 2)])
def test_small_plans(histogram, bins):
    assert packing.plan(histogram).bins == bins


def test_knapsack_is_the_best_of_all():
    sizes, prices = np.array([3, 4, 5, 9]), np.array([3.1, 4.5, 5.0, 10.0])
    best = packing.best_pattern(sizes, prices, 12)
    assert sum(prices[j] * n for j, n in best.items()) == pytest.approx(13.5) and sum(sizes[j] * n for j, n in best.items()) <= 12
