import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from odd_rows import clashing
from pyspark.sql import functions as F

from tidegate.llm.queries import QUERIES
from tidegate.llm.runs import periodic_runs, run_digests, with_planted_runs

SF = "/root/testdata/sf0.001"


def brute(words, shortest=24, exponent=3):
    """All runs, lag by lag; a lag is the smallest period unless a smaller one of the stretch divides it."""
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, exponent * q):
                stretch = words[i : j + q]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def digests(doc_id, words):
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_random_words_equal_brute_force(spark):
    random.seed(5)
    texts = []
    for i in range(400):
        letters = "ab" if i % 2 else "abc"
        words = [random.choice(letters) for _ in range(random.randrange(90))]
        for _ in range(random.randrange(4)):
            root = [random.choice(letters) for _ in range(random.randrange(1, 40))]
            at = random.randrange(len(words) + 1)
            words[at:at] = (root * 9)[: random.randrange(1, 5 * len(root) + 24)]
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(docs).collect()}
    for i, text in texts:
        words = text.split()
        runs = brute(words)
        assert [tuple(r) for r in got[i].runs] == runs, text
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        assert got[i].collapsed == " ".join(w for k, w in enumerate(words) if k not in gone)
    rows = run_digests(periodic_runs(docs)).collect()
    assert sorted(tuple(r) for r in rows) == sorted(digests(i, t.split()) for i, t in texts)


def test_other_bounds(spark):
    words = "x y a b a b a b a b z".split()
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    assert [tuple(r) for r in periodic_runs(docs, shortest=6).first().runs] == brute(words, 6)
    assert [tuple(r) for r in periodic_runs(docs, shortest=6, exponent=4).first().runs] == brute(words, 6, 4) == [(2, 8, 2)]
    with pytest.raises(ValueError):
        periodic_runs(docs, exponent=2)


def test_odd_rows(spark, odd, nothing):
    rows = sorted((tuple(r) for r in run_digests(periodic_runs(clashing(odd))).collect()), key=repr)
    others = [r for r in rows if r[0] != 8]
    assert others == sorted((digests(i, split(t)) for i, t in odd.collect() if i != 8), key=repr)
    (long,) = [r for r in rows if r[0] == 8]
    assert long[1:6] == (1, 0, 40_000, 1, 40_000_000)
    assert run_digests(periodic_runs(nothing)).count() == 0
    assert with_planted_runs(nothing).count() == 0


def test_planting_keeps_others(spark, odd):
    docs = odd.unionByName(spark.range(300).select(F.col("id").alias("doc_id"), F.lit(" a  b\tc d e f g ").alias("text")))
    got = sorted((tuple(r) for r in with_planted_runs(docs).collect()), key=repr)
    want = []
    for i, text in docs.collect():
        words = split(text)
        other = i is not None and words and zlib.crc32(str(i).encode()) % 10 == 0
        want.append((i, " ".join(planted(i, words)) if other else text))
    assert got == sorted(want, key=repr)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    short = [(i, planted(i, split(t))) for i, t in docs if len(split(t)) < 1200]
    assert len(short) > 150 and any(got[i][1] for i, _ in short)
    for i, words in short:
        assert got[i] == digests(i, words)
