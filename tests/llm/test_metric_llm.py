import math

import numpy as np
import pytest

from tidegate.llm import metric

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, cosine=0.9):
    size = max((len(v) for _, v in rows if v), default=1)
    full = np.zeros((len(rows), size))
    for i, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v):
            full[i, : len(v)] = np.array(v, dtype=np.float32)
    norms = np.linalg.norm(full, axis=1)
    near = (full @ full.T) / np.maximum(np.outer(norms, norms), 1e-300) >= cosine
    near &= (norms > 0)[:, None] & (norms > 0)[None, :]
    np.fill_diagonal(near, False)
    seen, out = {}, []
    for i in range(len(rows)):
        if i not in seen:
            reach, todo = {i}, [i]
            while todo:
                for j in np.flatnonzero(near[todo.pop()]):
                    if j not in reach:
                        reach.add(int(j)), todo.append(int(j))
            named = [rows[j][0] for j in reach if rows[j][0] is not None]
            seen |= dict.fromkeys(reach, min(named, default=None))
        out.append((rows[i][0], int(near[i].sum()), seen[i], rows[i][0] == seen[i]))
    return sorted(out, key=repr)


def result(df, **more):
    return sorted((tuple(r) for r in metric.near_vectors(df, **more).collect()), key=repr)


def made(seed, size=12):
    """Groups of copies, of near copies of several widths, chains, and vectors of no group."""
    random = np.random.default_rng(seed)
    parts = [random.normal(size=(300, size))]
    for spread, count in ((0.0, 40), (0.02, 150), (0.1, 120), (0.2, 120), (0.3, 90)):
        centre = random.normal(size=size)
        centre /= np.linalg.norm(centre)
        parts.append((centre + spread * random.normal(size=(count, size)) / math.sqrt(size)) * random.uniform(0.1, 9, (count, 1)))
    angle = np.arange(40) * 0.2
    chain = np.zeros((40, size))
    chain[:, 0], chain[:, 1] = np.cos(angle), np.sin(angle)
    parts.append(chain)
    whole = np.concatenate(parts).astype(np.float32)
    return [(int(i), [float(c) for c in v]) for i, v in zip(random.permutation(len(whole)) * 3, whole, strict=True)]


@pytest.mark.parametrize("cosine", [0.9, 0.6])
def test_equals_brute_force(spark, monkeypatch, cosine):
    monkeypatch.setattr(metric, "LEAST", 64)
    monkeypatch.setattr(metric, "SAMPLE", 200)
    rows = made(3)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), cosine=cosine) == brute(rows, cosine)


def test_one_chunk_and_other_samples_give_the_same(spark, monkeypatch):
    rows = made(4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows)
    assert result(df) == want
    monkeypatch.setattr(metric, "DENSE", 10**9)  # no tight cell
    monkeypatch.setattr(metric, "LEAST", 100)
    assert result(df) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, -0.0]), (6, [nan, 1.0]), (7, [inf, 0.0]),
        (8, [None, 1.0]), (None, [1.0, 0.1]), (None, None), (9, [5.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]),
        (12, [1e-38, 1e-38]), (13, [1e38, 1e38]), (None, [0.0, 0.0, 1.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA + ", digest string, cell int")
    assert result(df) == brute(rows)
    assert result(df.limit(0)) == []
    assert result(spark.createDataFrame([(3, None), (None, [0.0])], SCHEMA)) == [(3, 0, 3, True), (None, 0, None, True)]


def test_doubles(spark):
    rows = [(1, [1e300, 0.0]), (2, [1e300, 1e299]), (3, [1e-300, 0.0]), (4, [0.0, 1.0])]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


def test_far_cells_are_not_visited(spark, monkeypatch):
    """Groups that lie apart are each joined by themselves: no class visits another group's cell."""
    monkeypatch.setattr(metric, "LEAST", 16)
    random = np.random.default_rng(8)
    rows, n = [], 0
    for axis in range(8):
        for _ in range(30):
            v = 0.25 * random.normal(size=8) / math.sqrt(8)
            v[axis] += 1
            rows.append((n, [float(c) for c in v]))
            n += 1
    seen = []
    whole = metric._joined
    monkeypatch.setattr(metric, "_joined", lambda dealt, *a: seen.append(dealt.groupBy("role").count().collect()) or whole(dealt, *a))
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    counts = {r.role: r["count"] for r in seen[0]}
    assert counts[0] == 240 and counts.get(1, 0) < 240 * 3
