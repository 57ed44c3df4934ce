import random

import pytest
from pyspark.sql import functions as F

from gridweave.llm import mixing

SCHEMA = "doc_id long, text string, source string, s string, bucket int, _id int"


def rows(n=600, sources=7, seed=1):
    rng = random.Random(seed)
    out = [(i, " ".join(["w x"] * rng.choice([1, 5, 80, 900])) if rng.random() > 0.05 else rng.choice([None, "", " \n"]), None if rng.random() < 0.1 else f"s{min(rng.randrange(sources), rng.randrange(sources))}", "c", 1, 2) for i in range(n)]
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, passes=2):
    """Share out by weight, stop at the cap, share the excess again."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + [None] * (None in sizes)
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    out, left, full = {}, share * sum(sizes.values()), set()
    while True:
        total = sum(weight[k] for k in names if k not in full)
        over = [k for k in names if k not in full and total and left * weight[k] / total > passes * sizes[k]]
        if not over:
            return out | {k: left * weight[k] / total for k in names if k not in full}
        for k in over:
            full.add(k)
            out[k] = passes * sizes[k]
        left = share * sum(sizes.values()) - sum(out.values())


def sizes_of(data):
    out = {}
    for _, text, source, *_ in data:
        out[source] = out.get(source, 0) + len((text or "").replace(" ", "_").split())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    data = rows(seed=seed)
    got = mixing.mixed(spark.createDataFrame(data, SCHEMA)).collect()
    sizes = sizes_of(data)
    want = targets(sizes)
    assert sorted(r["doc_id"] for r in got) == list(range(len(data)))
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for k, t in want.items():
        assert abs(taken[k] - t) <= 3 * 128 + 0.01 * t


def test_reruns_agree_whatever_the_partitions(spark):
    df = spark.createDataFrame(rows(300), SCHEMA)
    one = {r["doc_id"]: r["taken"] for r in mixing.mixed(df.repartition(1)).collect()}
    two = {r["doc_id"]: r["taken"] for r in mixing.mixed(df.repartition(7, "text")).collect()}
    assert one == two


def test_schedule_is_even(spark):
    table = spark.createDataFrame([(0, 100.0, 1000), (1, 300.0, 1000), (2, 0.0, 1000), (3, 600.0, 1000)], "s int, target double, source_size long")
    slots = mixing.schedule(table, 5000, mixing.Mix(block=1000)).orderBy("k").collect()
    share, seen = {0: 0.1, 1: 0.3, 3: 0.6}, {0: 0, 1: 0, 3: 0}
    for k, r in enumerate(slots):
        assert r["r"] == seen[r["s"]]
        seen[r["s"]] += 1
        assert all(abs(n - share[s] * (k + 1)) < 4 for s, n in seen.items())


def test_schedule_of_many_sources(spark):
    """Sources of any number, nearly all of them beside a large one, hold the points of their stretch."""
    sizes = [1] * 1500 + [4000] + [2] * 500
    table = spark.createDataFrame([(i, float(n), n) for i, n in enumerate(sizes)], "s int, target double, source_size long")
    got = {r["k"]: r["s"] for r in mixing.schedule(table, 4000, mixing.Mix(block=1)).collect()}
    ends, total = [], sum(sizes)
    for n in sizes:
        ends.append((ends[-1] if ends else 0) + n)
    points = {k: ((k + 1) % mixing.PRIME * mixing.STEP) % mixing.PRIME / mixing.PRIME for k in range(4000)}
    from bisect import bisect_right

    assert got == {k: bisect_right([e / total for e in ends], p) for k, p in points.items()}


def test_groups_larger_than_a_window(spark, monkeypatch):
    df = spark.createDataFrame(rows(300), SCHEMA)
    before = {r["doc_id"]: r["taken"] for r in mixing.mixed(df).collect()}
    monkeypatch.setattr(mixing, "GROUP", 13)
    assert {r["doc_id"]: r["taken"] for r in mixing.mixed(df).collect()} == before


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed(empty).count() == 0 and mixing.take_mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a", "", 1, 1), (1, None, "a", "", 1, 1), (2, "", None, "", 1, 1)], SCHEMA)
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mixed(blank).collect()] == [(0, 0, 0.0)] * 3
    again = spark.createDataFrame([(1, "a b c", "a", "", 1, 1)] * 3 + [(None, "d e", "b", "", 1, 1)] * 2, SCHEMA)
    got = mixing.mixed(again).collect()
    assert len(got) == 5 and all(r["taken"] <= 2 * r["size"] for r in got)
    one = mixing.mixed(again.limit(1)).first()
    assert one["target"] == pytest.approx(4.5) and one["taken"] in (3, 6)


def test_rows_are_taken_whole_times(spark):
    df = spark.createDataFrame(rows(200), SCHEMA)
    ratio = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mixed(df).collect() if r["size"]}
    out = mixing.take_mix(df)
    assert out.columns == df.columns
    counts = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {k: v for k, v in ratio.items() if v}


def test_drawn_rows_meet_the_targets(spark):
    rng = random.Random(4)
    data = [(i, " ".join([f"w{i}"] * rng.randint(600, 1400)), "ab"[i % 2], "", 1, 1) for i in range(800)]
    df, mix = spark.createDataFrame(data, SCHEMA), mixing.Mix(weights=(3.0, 1.0), share=0.8)
    want, sizes = targets(sizes_of(data), weights=(3, 1), share=0.8), sizes_of(data)
    words = lambda out: {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    near, drawn = words(mixing.take_mix(df, mix)), words(mixing.take_mix(df, mix, drawn=True))
    assert all(abs(drawn[k] - want[k]) < 0.07 * sizes[k] for k in want)
    assert any(abs(near.get(k, 0) - want[k]) > 0.1 * sizes[k] for k in want)
    again = [sorted(r["doc_id"] for r in mixing.take_mix(df.repartition(n), mix, drawn=True).collect()) for n in (1, 5)]
    assert again[0] == again[1]
