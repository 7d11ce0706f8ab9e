import random
import sys
from itertools import chain

import public_tokenizers
import pyarrow as pa
import pytest
from odd_rows import ODD_ROWS, clashing, sha
from tokenizers import Tokenizer

from tidegate.llm import bpe
from tidegate.llm.bpe import Encoder, TextDecoder, Vocabulary, WordTransducer, decoded_texts, encoded, merged, sufficient_lookahead

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, encoding="utf-8") as file:
        return Vocabulary(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_rows_equal_the_library(odd, library):
    def row(doc, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))

    got = encoded(clashing(odd), FILE).collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted([row(*r) for r in ODD_ROWS], key=repr)


def test_random_texts(vocabulary, library):
    encoder, random_ = Encoder(vocabulary), random.Random(5)
    for _ in range(400):
        text = "".join(random_.choice("ab'sthe éÉΣς日🎉\x00\t\n12inerz<|>.,!") for _ in range(random_.randint(0, 200)))
        text = text.replace("<|>", "<|endoftext|>")
        want = library.encode(text, add_special_tokens=False).ids
        assert [i for runs in encoder.runs(text) for run in runs for i in run.ids] == want


def test_streamed_words_equal_whole_words(vocabulary):
    random_ = random.Random(7)
    for letters in ("aab", "thernigs", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(random_.choice(letters) for _ in range(9000))
        transducer, most = WordTransducer(vocabulary), 0
        tokens = []
        for c in word:
            tokens.extend(transducer.feed(c))
            most = max(most, len(transducer.buffer))
        tokens.extend(transducer.finish())
        whole = merged([*word[:-1], word[-1] + vocabulary.end], vocabulary.ranks)
        assert tokens == whole and most <= 4 * vocabulary.lookahead + 1


def test_lookahead_bounds_how_far_borders_move():
    random_ = random.Random(11)
    for _ in range(60):
        tokens, pairs = ["a", "b", "c"], []
        while len(pairs) < 12:  # rules over earlier tokens only, each made once
            pair = random_.choice(tokens), random_.choice(tokens)
            if len("".join(pair)) <= 6 and "".join(pair) not in tokens:
                pairs.append(pair)
                tokens.append("".join(pair))
        ranks, most = {p: i for i, p in enumerate(pairs)}, sufficient_lookahead(pairs)
        for _ in range(60):
            stem = "".join(random_.choice("abc") for _ in range(40))
            borders = []
            for _ in range(2):
                at, ends = 0, set()
                for token in merged(list(stem + "".join(random_.choice("abc") for _ in range(20))), ranks):
                    at += len(token)
                    ends.add(at)
                borders.append({e for e in ends if e <= len(stem) - most})
            assert borders[0] == borders[1]


def test_decoding_gives_the_text_back(spark, vocabulary):
    docs = spark.createDataFrame([(1, "Straße 日本 🎉 don't <|endoftext|> x"), (2, None)], "doc_id long, text string")
    frame = decoded_texts(encoded(docs, FILE, with_ids=True), FILE).collect()
    assert {r.doc_id: r.decoded for r in frame} == {1: "straße 日本 🎉 don 't <|endoftext|> x", 2: ""}
    decoder = TextDecoder(vocabulary)
    broken = [vocabulary.ids[s] for s in ("Ã", "a", "ð", "Ł")]
    assert "".join([*decoder.feed(broken), *decoder.finish()]) == "�a�"


def test_empty_table(nothing):
    assert encoded(nothing, FILE).count() == 0


def test_joined_decoder_in_any_pieces():
    from tidegate.llm.bpe import JoinedDecoder

    table = {3: b"ab", 5: b"c</w>", 9: "é".encode()}
    ids = [3, 5, 9, 9, 3]
    for cuts in ([], [1], [0, 0, 2, 5], [1, 2, 3, 4]):
        decoder, at = JoinedDecoder(table), [0, *cuts, len(ids)]
        assert b"".join(decoder.feed(ids[a:b]) for a, b in zip(at, at[1:], strict=False)) == "ab c</w> é é ab".encode()


def test_a_kept_word_is_small(vocabulary):
    """A word costs its identifiers, four bytes each, in one object."""
    encoder = Encoder(vocabulary)
    for run in chain.from_iterable(encoder.runs("unbelievably " + "zxqvkjw" * 6)):
        parts = [part for part in run if not isinstance(part, int)]
        assert sum(map(sys.getsizeof, [run, *parts])) < 64 + 4 * len(run.ids)


def test_identifiers_leave_in_bounded_batches(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_IDS", 50)
    texts = [None, "", *("word and some others " * (i % 9) for i in range(200)), "", "a " * 500, None]
    batches = list(bpe._encoded_rows(Encoder(vocabulary), pa.array(range(len(texts))), pa.array(texts), "doc_id", True))
    rows = [row for batch in batches for row in batch.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert [r["ids"] for r in rows] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert all(sum(len(r["ids"]) for r in batch.to_pylist()[:-1]) < 50 for batch in batches)
