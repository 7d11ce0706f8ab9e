"""Byte-level BPE encoding as a streaming transducer, and decoding as a state machine.

How far a change at the end of a text can move token borders to the left is bounded by the
merge list alone. Rules apply in order of rank. If two texts share a prefix, the leftmost
border in which they differ moves left only when a rule merges the token before that
border with the one after it in one text and not in the other. It moves by the length of the
rule's left part, and the next such rule has a higher rank and a right part that begins with
this left part. The longest chain of such rules gives the sufficient lookahead. Tokens that
end further from the end of the buffer than the lookahead are stable and are emitted, so the
buffer stays below a constant size however long a word is.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted

KEPT_WORDS = 1 << 18
KEPT_LENGTH = 48
SLICE_CHARS = 1 << 16
# Identifiers after which the rows so far are given on as a batch of their own.
BATCH_IDS = 1 << 18
# White space as Unicode defines it.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary (a fixed format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(0x100)]


def _category(kind: str, end: int) -> str:
    """The characters below `end` of a Unicode category as the ranges of a regular expression's set."""
    inside = [unicodedata.category(chr(i)).startswith(kind) for i in range(end)]
    edges = [i for i in range(end + 1) if (i < end and inside[i]) != (i > 0 and inside[i - 1])]
    return "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in zip(edges[::2], edges[1::2], strict=True))


# The word pattern of this kind of file (a fixed value), and an equivalent with the commonest case first.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SAME = "[{letter}]+|'(?:s|t|re|ve|m|ll|d)|[{number}]|[^{space}{letter}{number}]+"


@cache
def _words(end: int) -> re.Pattern[str]:
    """The pattern for texts whose characters are all below `end`.

    Letters and numbers are those of the interpreter's Unicode tables; characters that a later
    Unicode version has added count as neither.
    """
    return re.compile(_SAME.format(letter=_category("L", end), number=_category("N", end), space=_SPACES))


class Vocabulary:
    """What a tokenizer file of the byte-level BPE kind with word ends says."""

    def __init__(self, content: str):
        held = json.loads(content)
        model = held["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback") or held.get("decoder"):
            raise ValueError("only byte-level BPE without unknown token, byte fallback and decoder is known")
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs = pairs
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in held["added_tokens"]):
            raise ValueError("added tokens must be plain strings")
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        kinds = [n["type"] for n in held["normalizer"]["normalizers"]]
        splits = held["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
            raise ValueError("unknown normalizer or pre-tokenizer")
        if splits[0]["pattern"]["Regex"] != WORD:
            raise ValueError("unknown word pattern")
        self.lookahead = sufficient_lookahead(pairs)


def sufficient_lookahead(pairs: list[tuple[str, str]]) -> int:
    """Symbols after a token border that can still move it, by the longest chain of rules."""
    made = {left + right: left for left, right in pairs}
    reach: dict[str, tuple[list[int], list[int]]] = {}  # left part -> ranks, best reach so far
    longest = 0
    for rank, (left, right) in enumerate(pairs):
        best, head = 0, right
        while head is not None:  # what the right part begins with, down to one symbol
            if head in reach:
                ranks, reached = reach[head]
                at = bisect_left(ranks, rank)
                best = max(best, reached[at - 1] if at else 0)
            head = made.get(head)
        total = len(left) + best
        ranks, reached = reach.setdefault(left, ([], []))
        ranks.append(rank)
        reached.append(max(total, reached[-1] if reached else 0))
        longest = max(longest, total)
    return longest + 1  # the last symbol differs too, as it carries the word end


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges, lowest rank first and leftmost on ties."""
    size = len(symbols)
    held: list[str | None] = list(symbols)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    heap = [(r, i, held[i], held[i + 1]) for i in range(size - 1) if (r := ranks.get((held[i], held[i + 1]))) is not None]
    heapify(heap)
    while heap:
        _, left, a, b = heappop(heap)
        right = after[left]
        if right >= size or held[left] != a or held[right] != b:
            continue
        held[left], held[right] = a + b, None
        after[left] = follower = after[right]
        leader = before[left]
        if follower < size:
            before[follower] = left
            if (r := ranks.get((held[left], held[follower]))) is not None:
                heappush(heap, (r, left, held[left], held[follower]))
        if leader >= 0 and (r := ranks.get((held[leader], held[left]))) is not None:
            heappush(heap, (r, leader, held[leader], held[left]))
    return [h for h in held if h is not None]


class WordTransducer:
    """Takes the symbols of one word bit by bit and gives tokens as soon as they are stable."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.room = 4 * vocabulary.lookahead
        self.buffer: list[str] = []

    def feed(self, symbols: Sequence[str]) -> Iterator[str]:
        at = 0
        while at < len(symbols):
            more = symbols[at : at + self.room + 1 - len(self.buffer)]
            self.buffer.extend(more)
            at += len(more)
            if len(self.buffer) > self.room:
                yield from self._stable()

    def _stable(self) -> Iterator[str]:
        border, done = len(self.buffer) - self.vocabulary.lookahead, 0
        for token in merged(self.buffer, self.vocabulary.ranks):
            if done + len(token) > border:
                break
            yield token
            done += len(token)
        del self.buffer[:done]

    def finish(self) -> Iterator[str]:
        if self.buffer:
            self.buffer[-1] += self.vocabulary.end
            yield from merged(self.buffer, self.vocabulary.ranks)
        self.buffer = []


class TextDecoder:
    """Takes identifiers bit by bit: token strings become bytes, bytes become text.

    The state is the part of a character whose bytes have not all come yet. A byte that
    cannot go on or begin a character becomes U+FFFD.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.of_symbol = {s: b for b, s in enumerate(byte_symbols())}
        self.code, self.missing, self.least = 0, 0, 0

    def feed(self, ids: Iterable[int]) -> Iterator[str]:
        for i in ids:
            token = self.vocabulary.tokens[i]
            if token in self.vocabulary.special:
                yield from self.finish()
                yield token + " "
                continue
            ends = self.vocabulary.end and token.endswith(self.vocabulary.end)
            for symbol in token[: -len(self.vocabulary.end)] if ends else token:
                yield from self._byte(self.of_symbol[symbol])
            if ends:
                yield from self.finish()
                yield " "

    def _byte(self, byte: int) -> Iterator[str]:
        if self.missing and byte & 0xC0 == 0x80:
            self.code, self.missing = self.code << 6 | byte & 0x3F, self.missing - 1
            if not self.missing:
                valid = self.least <= self.code < 0x110000 and not 0xD800 <= self.code < 0xE000
                yield chr(self.code) if valid else "�"
            return
        yield from self.finish()
        if byte < 0x80:
            yield chr(byte)
        elif 0xC2 <= byte < 0xF5:
            self.missing = 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
            self.code = byte & (0x3F >> self.missing)
            self.least = (0x80, 0x800, 0x10000)[self.missing - 1]
        else:
            yield "�"

    def finish(self) -> Iterator[str]:
        if self.missing:
            self.missing = 0
            yield "�"


class JoinedDecoder:
    """Takes identifiers bit by bit, as a tokenizer file without a decoder wants them: every token, joined by one space.

    The state is what goes before the next token: nothing at first, then a space.
    """

    def __init__(self, table: dict[int, bytes]):
        self.table, self.gap = table, b""

    def feed(self, ids: Iterable[int]) -> bytes:
        table = self.table
        tokens = [table[i] for i in ids]
        if not tokens:
            return b""
        before, self.gap = self.gap, b" "
        return before + b" ".join(tokens)


class Run(bytes):
    """A word's identifiers, four bytes each: a worker keeps very many of them."""

    __slots__ = ()

    @property
    def ids(self) -> list[int]:
        return memoryview(self).cast("i").tolist()


class Encoder(dict):
    """Word -> its run; computes what it lacks. A full table becomes the older half of what is kept."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.symbols = byte_symbols()
        self.plain, self.wide = _words(0x10000), _words(0x110000)
        self.older: dict[str, Run] = {}
        self.specials = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")
        self.gap = re.compile(f"[{_SPACES}]")
        # How identifiers and tokens are written.
        self.figures = {i: str(i).encode() for i in vocabulary.tokens}
        self.written = {i: token.encode("utf-8") for i, token in vocabulary.tokens.items()}

    def _run(self, ids: Iterable[int]) -> Run:
        return Run(array("i", ids).tobytes())

    def _encoded(self, word: str) -> Iterator[int]:
        ids, transducer = self.vocabulary.ids, WordTransducer(self.vocabulary)
        for at in range(0, len(word), SLICE_CHARS):
            data = word[at : at + SLICE_CHARS].encode("utf-8", "surrogatepass")
            for token in transducer.feed([self.symbols[b] for b in data]):
                yield ids[token]
        for token in transducer.finish():
            yield ids[token]

    def __missing__(self, word: str) -> Run:
        run = self.older.get(word) or self._run(self._encoded(word))
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = run
        return run

    def _slices(self, text: str) -> Iterator[str]:
        """The text in pieces that end before white space, where no word and no character goes on."""
        at = 0
        while len(text) - at > 2 * SLICE_CHARS:
            found = self.gap.search(text, at + SLICE_CHARS)
            if not found:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]

    def runs(self, text: str | None) -> Iterator[list[Run]]:
        """The runs of the text, slice by slice; strings of special tokens stand for those tokens."""
        if not text:
            return
        for i, part in enumerate(self.specials.split(text) if self.vocabulary.special else [text]):
            if i % 2:
                yield [self._run([self.vocabulary.special[part]])]
                continue
            for piece in self._slices(part):
                words = self.plain  # its sets are looked up at once, those of the wide pattern range by range
                if not piece.isascii():
                    piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                    words = self.wide if max(piece) > "\uffff" else words
                found = [self[w] for w in words.findall(piece.lower())]
                if found:
                    yield found

    def numbers(self, text: str | None) -> Iterator[list[int]]:
        """The identifiers of the text, slice by slice."""
        for runs in self.runs(text):
            yield memoryview(b"".join(runs)).cast("i").tolist()


_WORKER: dict[int, Encoder] = {}

_DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoded_rows(
    encoder: Encoder, keys: pa.Array, texts: pa.Array, id_column: str, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    """The rows of `encoded` for these texts, in batches that the row which fills them closes."""
    first, counts, written, back, kept = 0, [], [], [], array("i")
    for at, text in enumerate(texts, 1):
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        writer, decoder = JoinedDecoder(encoder.figures), JoinedDecoder(encoder.written)
        for numbers in encoder.numbers(text.as_py()):
            ids.update(writer.feed(numbers))
            decoded.update(decoder.feed(numbers))
            n += len(numbers)
            if with_ids:
                kept.extend(numbers)
        counts.append(n)
        written.append(ids.hexdigest())
        back.append(decoded.hexdigest())
        if len(kept) < BATCH_IDS and at < len(texts):
            continue
        columns = [keys[first:at], pa.array(counts, pa.int64()), pa.array(written), pa.array(back)]
        names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            ends = pa.array(np.cumsum([0, *counts]), pa.int32())
            columns.append(pa.ListArray.from_arrays(ends, pa.array(np.array(kept, dtype=np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)
        first, counts, written, back, kept = at, [], [], [], array("i")


def encoded(
    docs: DataFrame,
    tokenizer_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Per row: its id, n_tokens, ids_sha256, decoded_sha256, and on request the ids themselves.

    The decoded form comes from the identifiers, slice by slice, through `JoinedDecoder`, as the
    tokenizer file names no decoder; `decoded_texts` gives the text back. NULL and empty texts have no tokens and the digests
    of the empty string. Rows stand by themselves, repeated rows and NULL ids too; texts of any
    length are encoded whole. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(Vocabulary(file.read()))  # a fixed size
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {_DIGESTS}" + (", ids array<int>" if with_ids else "")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        if id(vocabulary) not in _WORKER:
            _WORKER.clear()
            _WORKER[id(vocabulary)] = Encoder(vocabulary)
        encoder = _WORKER[id(vocabulary)]
        for batch in batches:
            yield from _encoded_rows(encoder, batch.column(0), batch.column(1), id_column, with_ids)

    return docs.select(quoted(id_column), quoted(text_column).cast("string").alias("text")).mapInArrow(each, schema)


def decoded_texts(frame: DataFrame, tokenizer_file: str, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """The frame with the text that each row's identifiers stand for; NULL gives NULL."""
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = frame.sparkSession.sparkContext.broadcast(Vocabulary(file.read()))

    @F.udf("string", useArrow=True)
    def back(ids):
        if ids is None:
            return None
        decoder = TextDecoder(shared.value)
        return "".join([*decoder.feed(int(i) for i in ids), *decoder.finish()]).strip()

    return frame.withColumn(into, back(quoted(ids_column)))
