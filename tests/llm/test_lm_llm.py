import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from odd_rows import ODD_ROWS, clashing

from tidegate.llm.lm import Lattice, likelihoods

FILE = public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def test_base_columns_match_brute_force(spark):
    rows = ODD_ROWS + [(100 + i, f"word{i % 7} shared Text number {i}") for i in range(80)]
    counts = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for doc, text in rows:
        own = words(text)
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want.append((doc, held(doc), len(own), sum(counts[w] > 0 for w in own), n, round(score, 6)))
    got = likelihoods(clashing(spark.createDataFrame(rows, "doc_id long, text string")), FILE).collect()
    assert sorted([(*tuple(r)[:5], round(r.base_score, 6)) for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_marginal_sums_all_segmentations():
    weights = {"▁": 0.1, "▁a": 0.2, "a": 0.1, "b": 0.2, "ab": 0.1, "▁ab": 0.05, "ba": 0.05}
    lattice = Lattice({p: math.log(w) for p, w in weights.items()}, [math.log(1e-3)] * 256)

    def total(rest):
        return 1.0 if not rest else sum(w * total(rest[len(p) :]) for p, w in weights.items() if rest.startswith(p))

    for word in ("a", "ab", "abab", "babba"):
        assert lattice.log_probability(word) == pytest.approx(math.log(total("▁" + word)))
    assert lattice.log_probability("é") == pytest.approx(math.log(0.1 * 1e-6))  # two bytes


def test_pieces_are_a_distribution():
    lattice = Lattice.of_vocabulary(FILE)
    assert sum(map(math.exp, lattice.weights.values())) + sum(map(math.exp, lattice.fallback)) == pytest.approx(1)
    assert math.isfinite(lattice.log_probability("q" * 5000))


def test_empty_table(nothing):
    assert likelihoods(nothing, FILE).count() == 0
