import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gridweave.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component_id string"


def brute_print(text, width=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x85", "\x85")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=4):
    ids = [i for i, _ in rows]
    prints = [brute_print(t) for _, t in rows]
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(ids[a]), find(ids[b])))
                top[y] = x
    return {i: (f"{p:016x}", find(i)) for i, p in zip(ids, prints)}


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        rows.append(text)
        for _ in range(rng.randint(0, 4)):
            near = list(text)
            if near:
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append(near)
    texts = [rng.choice([" ", "\n", " \t"]).join(w.upper() if rng.random() < 0.1 else w for w in t) for t in rows]
    return list(enumerate([*texts, None, "", " \n", "One two", "one TWO", "é x É x"], start=5))


def test_components_are_those_of_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(docs).collect()}
    assert got == brute_components(rows)


def test_spark_hashes_alike(spark):
    text = "the same bytes, é"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64(text.encode(), seed=42).intdigest()


@pytest.mark.parametrize("distance,blocks", [(4, 6), (4, 5), (2, 4)])
def test_masks_leave_no_pair_out(distance, blocks):
    rng = random.Random(2)
    masks = simhash.block_masks(distance, blocks)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), distance))
        assert any(not flips & m for m in masks)


def test_large_buckets_are_cut_without_losing_links(spark):
    rng = random.Random(3)
    prints = sorted({sum(1 << b for b in rng.sample(range(12), rng.randint(0, 4))) for _ in range(300)})
    nodes = spark.createDataFrame(list(enumerate(prints)), "id long, fp long")
    edges = {(r["a"], r["b"]) for r in simhash.close_pairs(nodes, block_rows=16).collect()}
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in edges)
    from gridweave.operators.graph import connected_components

    found = {r["node"]: r["component"] for r in connected_components(simhash.close_pairs(nodes, block_rows=16)).collect()}
    assert set(found.values()) == {0} and len(found) == len(prints)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_components(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0
    rows = [(7, "a b c d e", None, None), (7, "a b c d e", None, None), (None, "a b c d e", None, None), (3, None, None, None), (None, "zz", None, None)]
    got = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("3", "3"), ("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]


def test_one_of_each_group_stays(spark):
    rows = corpus(9, 25)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows] + [(5, rows[0][1], "x", "y")], SCHEMA).withColumn("_gone", F.lit(1))
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    groups = brute_components(rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in groups.items() if c == i)


def test_very_long_text():
    text = " ".join(str(i % 977) for i in range(200_000))
    assert simhash.fingerprint(text) == simhash.fingerprint(text + " ") != 0


def test_rows_that_share_an_id_go_by_their_own_text(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    near = a.replace("a59", "z")
    rows = [(1, a, "x", "y"), (5, a, "x", "y"), (5, b, "x", "y"), (5, b, "x", "z"), (7, b, None, None), (8, None, "", ""), (8, "", "", ""), (9, " ", "", ""), (None, a, "", ""), (None, a, "", "")]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    joined = simhash.drop_near_copies(spark.createDataFrame(rows, SCHEMA), most_held=0).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in joined) == sorted((str(r["doc_id"]), str(r["text"])) for r in kept)
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:1]) for r in kept) == [("1", "a"), ("5", "b"), ("8", ""), ("None", "a"), ("None", "a")]
    assert simhash.fingerprint(near) != simhash.fingerprint(a)


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_any_number_of_blocks_finds_the_same(spark, blocks):
    rows = corpus(5, 30)
    docs = spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(docs, blocks=blocks).collect()}
    assert got == brute_components(rows)
    assert [simhash.blocks_for(n) for n in (0, 10**6, 10**8, 10**10)] == [5, 5, 6, 8]
