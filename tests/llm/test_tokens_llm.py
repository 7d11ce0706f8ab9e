import random

import public_tokenizers
import pytest
import sentencepiece
from odd_rows import ODD_ROWS, clashing

from tidegate.llm.tokens import TokenCounter, load_ranks, merges, token_counts

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def test_counts_equal_the_library(odd, model):
    got = token_counts(clashing(odd), FILE).collect()
    want = [(d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in ODD_ROWS]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_random_texts(model):
    counter, random_ = TokenCounter(load_ranks(FILE)), random.Random(3)
    for _ in range(500):
        text = "".join(random_.choice("ab ▁\nthe éÉΣ日🎉\x00\tinerz<|>s/0x") for _ in range(random_.randint(0, 200)))
        assert counter.count(text) == len(model.encode(text))


def test_merges_pop_lowest_rank_then_leftmost():
    ranks = {c: 0 for c in "abc"} | {"bc": 1, "ab": 2, "aa": 3, "aaa": 4}
    assert merges("abc", ranks) == 1  # b and c go first, then nothing is left for a
    assert merges("aaaa", ranks) == 2 and merges("", ranks) == 0 and merges("a", ranks) == 0


def test_empty_table(nothing):
    assert token_counts(nothing, FILE).count() == 0
