import math

import numpy as np

from tidegate.llm import negatives
from tidegate.llm.negatives import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, every=10, window=5):
    size = max((len(v) for _, _, v in rows if v), default=1)
    held = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(c))) for c in v) + (0,) * (size - len(v))
        if (i, label, whole) not in held:
            held.append((i, label, whole))
    out = []
    for i, label, v in held:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in held if j != i)
        positives = [(j, -s) for s, j, other in scored if other == label][:window]
        for j, top in positives:
            fit = [(k, -s) for s, k, other in scored if other != label and 80 * top <= -100 * s <= 100 * top]
            out += [(i, j, r, k, top, s) for r, (k, s) in enumerate(fit[:window], 1)]
    return sorted(out)


def result(df, **more):
    return sorted(tuple(r) for r in hard_negatives(df, every=10, **more).collect())


def made(seed, n=500, size=24):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, size))
    rows = []
    for i in range(n):
        v = centres[random.integers(12)] * random.uniform(0.2, 1) + random.choice([0.0, 0.1, 1.0]) * random.normal(size=size)
        if i % 3 == 0:  # copies under many ids
            v = centres[0] / 3
        rows.append((i, int(random.integers(4)), [float(c) for c in (v / 5).astype(np.float32)]))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST", 60)
    rows = made(1)
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got == brute(rows) and len(got) > 200


def test_sparse_vectors_and_small_batches_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST", 100)
    monkeypatch.setattr(negatives, "_PAIRS", 300)
    random = np.random.default_rng(6)
    rows = []
    for i in range(300):
        v = np.zeros(40, dtype=np.float32)
        v[random.integers(0, 40, 5)] = random.exponential(size=5)
        rows.append((i, int(random.integers(3)), [float(c) for c in v]))
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and got


def test_whole_numbers_beyond_doubles(spark):
    random = np.random.default_rng(2)
    rows = [(i, i % 2, [float(c) for c in random.integers(1, 10**6, 8)]) for i in range(60)]
    got = result(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and max(r[4] for r in got) > 1 << 53


def test_odd_rows(spark):
    nan = float("nan")
    rows = [
        (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (0, 2, [0.5, 0.5]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [0.9, 0.0]),
        (4, None, [1.0, 0.0]), (5, 2, None), (6, 2, [None, 1.0]), (7, 2, [nan, 1.0]), (None, 2, [1.0, 0.0]), (8, 2, []),
        (9, 1, [-1.0]), (10, 1, [0.0, 0.0]), (11, 2, [1.0, 0.0, 0.0]), (12, 1, [0.95]), (13, 2, [0.0, 0.0, 1.0]),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", block int, tops string")
    assert result(df) == brute(rows)
    assert result(df.limit(0)) == []
    assert result(df.where("vec_id % 10 != 0")) == []


def test_index_leaves_out_what_suffix_norms_cover():
    vectors = np.zeros((3, 32), dtype=np.int64)
    vectors[0, :8], vectors[1, 8:16], vectors[2] = 100, 3, 1
    index = negatives.build_index(np.arange(3), np.zeros(3, dtype=np.int64), vectors, 10.0)
    anchors = np.ones((1, 32), dtype=np.int64)
    one, two, score = negatives.pairs_above(index, anchors, np.array([500.0]))
    assert (one.tolist(), index.ids[two].tolist(), score.tolist()) == ([0], [0], [800])
    one, two, score = negatives.pairs_above(index, anchors, np.array([-np.inf]))
    assert sorted(zip(index.ids[two].tolist(), score.tolist(), strict=True)) == [(0, 800), (1, 24), (2, 32)]
