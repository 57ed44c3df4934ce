import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, keys string"


def test_e8():
    v = lattice.minimal_vectors()
    assert v.shape == (240, 8) and np.allclose((v**2).sum(1), 2) and len(np.unique(v, axis=0)) == 240
    x = np.random.default_rng(1).normal(0, 2, (3000, 8))
    own = lattice.nearest(x)
    half = 2 * own
    assert (half % 2 == half[:, :1] % 2).all() and (own.sum(1) % 2 == 0).all()
    d = ((x - own) ** 2).sum(1)
    assert (d <= 1 + 1e-9).all() and all((((x - own - m) ** 2).sum(1) >= d - 1e-9).all() for m in v)


def data(seed=1, clusters=25, size=8, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(clusters):
        centre = rng.normal(size=dim)
        for _ in range(rng.integers(1, size)):
            rows.append((centre + rng.normal(size=dim) * rng.choice([0, 0.15, 0.26]), int(rng.integers(0, 2))))
    rows += [(rng.normal(size=dim), int(rng.integers(0, 2))) for _ in range(100)]
    order = rng.permutation(len(rows))
    return [(int(order[i]), [float(np.float32(x)) for x in v], label, 0, "c") for i, (v, label) in enumerate(rows)]


def brute(rows):
    ids = np.array([r[0] for r in rows])
    v = np.array([np.array(r[1], np.float32) for r in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    close = (v @ v.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    component = ids.copy()
    while True:
        low = np.minimum(component, np.where(close, component[None, :], 1 << 40).min(1))
        if (low == component).all():
            break
        component = low
    return {int(i): (int(n), int(c)) for i, n, c in zip(ids, close.sum(1), component)}


@pytest.mark.parametrize("block", [512, 5])
def test_recall_and_no_false_links(spark, block):
    rows = data()
    want = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_vectors(spark.createDataFrame(rows, SCHEMA), block=block).collect()}
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values()) > 100
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.97 * len(want)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    u, w = rng.normal(size=(2, 3000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w -= (w * u).sum(1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    a, b = (lattice.cells(x, lattice.Lattice()) for x in (u, 0.93 * u + np.sqrt(1 - 0.93**2) * w))
    met = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    assert met.mean() >= 0.97


def test_invalid_vectors_copies_and_labels(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [
        (1, a, 1, 0, ""), (2, a, 1, 0, ""), (3, b, 1, 0, ""), (4, a, 2, 0, ""), (5, a, None, 0, ""), (6, None, 1, 0, ""), (7, [0.0, 0.0, 0.0], 1, 0, ""), (8, [1.0, None, 3.0], 1, 0, ""),
        (9, [1.0, float("nan"), 3.0], 1, 0, ""), (10, [1.0, float("inf"), 3.0], 1, 0, ""), (11, [], 1, 0, ""), (12, [1.0, 2.0], 1, 0, ""), (None, a, 1, 0, ""), (13, [1e30, 2e30, 3e30], 1, 0, ""), (14, [1e-40, 2e-40, 3e-40], 1, 0, ""),
    ]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in lattice.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: got[i] for i in (1, 2, 3, 13, 14)} == {1: (4, 1, True), 2: (4, 1, False), 3: (4, 1, False), 13: (4, 1, False), 14: (4, 1, False)}
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, None))
    assert lattice.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_dense_group_counts_every_link_once(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    rows = [(i, [float(x) for x in centre + rng.normal(size=64) * 0.1], 1, 0, "") for i in range(120)]
    got = lattice.near_vectors(spark.createDataFrame(rows, SCHEMA), block=32).agg(F.min("n_links"), F.max("n_links"), F.max("component_id")).first()
    assert tuple(got) == (119, 119, 0)


def test_numbers_of_a_vector_do_not_depend_on_its_batch():
    rng = np.random.default_rng(6)
    unit = lattice.unit_rows(rng.normal(size=(300, 64)))
    group = np.arange(300)
    whole = lattice.buckets(unit, group, lattice.Lattice())
    assert all((lattice.buckets(unit[a:b], group[a:b], lattice.Lattice()) == whole[a:b]).all() for a, b in ((0, 1), (3, 10), (17, 280)))
    assert len(np.unique(whole)) == whole.size
    # a pair at the very threshold is judged alike in any company
    a = unit[0]
    b = lattice.unit_rows((0.93 * a + np.sqrt(1 - 0.93**2) * lattice.unit_rows((unit[1] - (unit[1] @ a) * a)[None])[0])[None])[0]
    judged = {bool(lattice.alike(np.stack([a, *unit[2:k], b]), 0.93)[0, -1]) for k in (2, 5, 40, 299)}
    assert len(judged) == 1


@pytest.mark.parametrize("block", [5, 64])
def test_results_do_not_depend_on_blocks(spark, block):
    df = spark.createDataFrame(data(seed=9, clusters=12), SCHEMA)
    rows = lambda **o: sorted(map(tuple, lattice.near_vectors(df, **o).collect()))
    assert rows(block=block) == rows()
