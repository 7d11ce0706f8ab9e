import random

import numpy as np

from odd_rows import ODD_ROWS, clashing
from pyspark.sql import functions as F

from tidegate.llm import toxicity
from tidegate.llm.toxicity import THRESHOLD, Lasso, drop_toxic, fit_chain, junk_and_toxic, minimised, scored


def corpus(spark):
    random_, rows, labels = random.Random(6), [], []
    clean = ["river", "stone", "cloud", "maple", "tower", "garden", "winter", "paper", "silver", "market"]
    for doc in range(600):
        toxic, junk = random_.random() < 0.2, random_.random() < 0.3
        text = [random_.choice(clean) for _ in range(random_.randint(5, 80))]
        if toxic:
            text.insert(random_.randrange(len(text)), "grubel" + random_.choice(["s", "nd", "ic", ""]))
        if junk:
            text += ["zzqx"] * 3
        rows.append((doc, " ".join(text)))
        if doc % 2 == 0:
            labels.append((doc, int(not junk), int(toxic)))
    truth = {doc: "grubel" in text for doc, text in rows}
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        truth,
    )


def test_held_out_documents(spark):
    docs, labels, truth = corpus(spark)
    got = {r.doc_id: r for r in scored(docs, docs, labels).collect()}
    assert len(got) == 600
    unseen = [d for d in got if d % 2]
    right = sum(got[d].rejected == truth[d] for d in unseen)
    assert right >= 0.98 * len(unseen)
    assert all((got[d].probability_toxic >= THRESHOLD) == got[d].rejected for d in got)
    junk = {r.doc_id for r in docs.where("text like '%zzqx%'").collect()}
    assert sum((got[d].probability_junk > 0.5) == (d in junk) for d in unseen) >= 0.95 * len(unseen)


def test_odd_rows_and_degenerate_labels(spark, odd, nothing):
    docs, labels, _ = corpus(spark)
    chain = fit_chain(docs, junk_and_toxic(labels), ["junk", "toxic"])
    scored_rows = chain.score(clashing(odd))
    assert scored_rows.count() == len(ODD_ROWS)
    assert {"a.b", "kept", "probability_toxic"} <= set(scored_rows.columns)
    assert scored_rows.where("probability_toxic is null or probability_junk is null").count() == 0
    assert chain.score(nothing).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert scored(odd, odd, none).where("rejected").count() == 0
    one_sided = spark.createDataFrame([(1, 1, 0), (1, None, 0), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert scored(odd, odd, one_sided).where("rejected").count() == 0


def test_own_columns_stay(spark):
    docs, labels, _ = corpus(spark)
    names = ("row", "places", "p0", "p1", "__tf", "rejected", "probability_toxic", "a.b")
    wide = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    kept = drop_toxic(wide, docs, labels)
    assert kept.schema == wide.schema
    want = {r.doc_id for r in scored(docs, docs, labels).where("not rejected").collect()}
    got = kept.collect()
    assert {r.doc_id for r in got} == want and all(tuple(r)[2:] == tuple(range(len(names))) for r in got)


def test_fit_is_the_lasso_minimum(monkeypatch):
    """No step along any weight lowers the penalised loss: the conditions of the minimum hold."""
    state = np.random.default_rng(3)
    n, width, penalty = 400, 30, 0.01
    x = state.random((n, width)) < 0.3
    y = (state.random(n) < 1 / (1 + np.exp(-(2.0 * x[:, 0] - 1.5 * x[:, 1])))).astype(float)
    dense = state.random((n, 1))
    places, starts = np.nonzero(x)[1].astype(np.int32), np.concatenate(([0], np.cumsum(x.sum(axis=1))))
    monkeypatch.setattr(toxicity, "_BLOCK", 500)
    monkeypatch.setattr(toxicity, "_STEPS", 300)
    model = Lasso(penalty, 1e-9).fit(places, starts, dense, y)
    table = np.zeros(width)
    table[model.held] = model.weights
    p = 1 / (1 + np.exp(-(x @ table + dense @ model.dense + model.constant)))
    assert np.allclose(p, model.probability(places, starts, dense))
    slope = x.T @ (p - y) / n
    assert np.all(np.abs(slope[table == 0]) <= penalty + 2e-4)
    assert np.allclose(slope[table != 0], -penalty * np.sign(table[table != 0]), atol=2e-4)
    assert abs((p - y).mean()) < 2e-4 and table[0] > 0 > table[1] and (table == 0).sum() > 10


def test_minimum_of_a_bowl():
    centre = np.array([3.0, 0.4, -2.0])
    found = minimised(lambda x: (float(((x - centre) ** 2).sum() / 2), x - centre), np.zeros(3), np.array([1.0, 1.0, 0.0]), 1e-9)
    assert np.allclose(found, [2.0, 0.0, -2.0], atol=1e-3)
