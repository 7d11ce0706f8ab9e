"""Personal data by weak supervision, on DataFrame functions only.

Spans of four base kinds follow fixed rules and always stay. Beside them wider patterns
propose candidates: spelled-out addresses, national phone numbers, card-like numbers and
secrets. Labelers vote on every span, base or candidate: a strict shape, a checksum or
range, a gazetteer and the words before it. Expectation-maximisation over the counts of the
vote patterns of all documents estimates how reliable each labeler is, without any labels. Its
posteriors are the soft labels of a naive Bayes span classifier, which decides on candidates.

Both tables that reach the driver, vote patterns and feature patterns, are bounded by the
number of kinds, votes and buckets, whatever the corpus. Patterns use possessive quantifiers
and start only where a run starts, so no text makes them backtrack far.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted

# The kinds in the order of the contract; secrets come after them.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
_LOCAL = "[A-Za-z0-9._%+-]"
# \G lets a match begin within a run where the previous match has ended.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9])++",
}
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9]{24,}+(?![A-Za-z0-9])",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
DOMAINS = "com|org|net|edu|gov|int|info|biz|io|eu|uk|us|de|fr|es|it|nl|ch|at|be|pl|se|no|dk|fi|pt|ru|jp|cn|in|br|ca|au"
CUES = {
    "email": r"e-?mail|contact|write to|schreib|correo|courriel|@",
    "ip": r"\bip\b|host|server|address|addr|login|from",
    "card": r"card|visa|master|amex|credit|karte|tarjeta|carte",
    "phone": r"tel|phone|call|mobile|fax|anruf|appel|llam",
    "secret": r"token|secret|passw|api.?key|\bkey\b|\bpwd\b|bearer|auth",
}
DOUBTS = r"version|isbn|issn|order|invoice|chapter|page|section|sha|md5|commit|hash|id\s*[=:]?\s*$"
# What a text must hold for a pattern to match at all; most texts are settled by these.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": "[0-9]", "secret": "[0-9]"}
CONTEXT_CHARS = 24
LABELERS = ("shape", "check", "gazetteer", "context")
FEATURES = ("length", "digits", "breaks", "cue", "checked")
ACCEPT = 0.5

_SPAN = "array<struct<start:bigint,end:bigint,match:string,before:string>>"


def _bound(value: Column, body) -> Column:
    """The body over a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _found(text: Column, pattern: str) -> Column:
    """The matches in order, with code point positions (end exclusive) and the text before each.

    Positions are running sums of the lengths of matches and of the gaps between them. They
    grow in pieces of about the square root of the number of matches, each counted from 0, and
    are then moved by the length of all pieces before: one growing array would be copied for
    every match.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zero, none = F.lit(0).cast("long"), F.array().cast(_SPAN)

    def add(done: Column, each: Column) -> Column:
        start = done["at"] + F.length(each["gap"])
        end = start + F.length(each["match"])
        span = F.struct(
            start.alias("start"), end.alias("end"), each["match"].alias("match"),
            F.right(each["gap"], F.lit(CONTEXT_CHARS)).alias("before"),
        )
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    def moved(piece: Column, by: Column) -> Column:
        return F.transform(
            piece["out"],
            lambda s: F.struct(
                (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["match"].alias("match"), s["before"].alias("before")
            ),
        )

    def joined(pieces: Column) -> Column:
        nothing = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        offsets = F.aggregate(
            pieces,
            nothing,
            lambda done, p: F.struct(
                (done["at"] + p["at"]).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")
            ),
            lambda done: done["out"],
        )
        return F.flatten(F.zip_with(pieces, offsets, moved))

    def spans(pairs: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(pairs))).cast("int")
        empty = F.struct(zero.alias("at"), none.alias("out"))
        pieces = F.transform(
            F.sequence(F.lit(1), F.size(pairs), step), lambda i: F.aggregate(F.slice(pairs, i, step), empty, add)
        )
        return F.when(F.size(pairs) > 0, _bound(pieces, joined)).otherwise(none)

    pairs = F.zip_with(
        matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: F.struct(m.alias("match"), g.alias("gap"))
    )
    return _bound(pairs, spans)


def _sought(text: Column, kind: str, pattern: str) -> Column:
    return F.when(text.rlike(NEEDS[kind]), _found(text, pattern)).otherwise(F.array().cast(_SPAN))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    # Longer digit strings are no cards; the bound keeps the sum short.
    short = F.substring(digits, 1, 19)
    return F.aggregate(F.sequence(F.lit(1), F.length(short)), F.lit(0), add) % 10 == 0


def _between(match: Column, least: int, most: int) -> Column:
    n = F.length(_digits(match))
    return (n >= least) & (n <= most)


def _card(match: Column) -> Column:
    return F.when(_between(match, 12, 19), _luhn(_digits(match))).otherwise(F.lit(False))


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
    "card": _card,
    "phone": lambda m: _between(m, 9, 15),
}


def _passing(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: _VALID[kind](s["match"]))


def _of_rank(rank: int) -> Column:
    return F.filter("__base", lambda s: s["rank"] == rank)


def _tagged(spans: Column, kind: str, base: bool) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"),
            F.lit(base).alias("base"), s["match"].alias("match"), F.lower(s["before"]).alias("before"),
        ),
    )


def _spans(docs: DataFrame, text_column: str) -> DataFrame:
    """The frame with __base and __wide: spans that follow the rules, and candidates."""
    text = F.col("__text")
    frame = docs.withColumn("__text", F.coalesce(quoted(text_column).cast("string"), F.lit("")))
    frame = frame.withColumns({f"__b_{k}": _sought(text, k, p) for k, p in BASE.items()})
    frame = frame.withColumns({f"__w_{k}": _sought(text, k, p) for k, p in WIDE.items()})
    base = [_tagged(_passing(f"__b_{k}", k), k, True) for k in BASE]
    # A number of a card's length that fails the checksum is a candidate too.
    like_card = F.filter("__b_card", lambda s: _between(s["match"], 13, 16) & ~_card(s["match"]))
    # A secret holds a digit; long words do not count.
    frame = frame.withColumn("__w_secret", F.filter("__w_secret", lambda s: s["match"].rlike("[0-9]")))
    wide = [_tagged(F.col(f"__w_{k}"), k, False) for k in WIDE] + [_tagged(like_card, "card", False)]
    return frame.select(
        *[quoted(c) for c in docs.columns if c != text_column],
        F.array_sort(F.concat(*base)).alias("__base"),
        F.array_sort(F.concat(*wide)).alias("__wide"),
    )


def _by_kind(span: Column, of: dict[str, Column], otherwise: Column) -> Column:
    chosen = otherwise
    for kind, value in of.items():
        chosen = F.when(span["rank"] == KINDS.index(kind), value).otherwise(chosen)
    return chosen


def _sign(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(-1))


def _votes(span: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 for, -1 against, 0 for none."""
    m, before, zero = span["match"], span["before"], F.lit(0)
    cue = _by_kind(span, {k: before.rlike(p) for k, p in CUES.items()}, F.lit(False))
    return {
        "shape": _by_kind(
            span,
            {"secret": _sign(m.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$")), "card": _sign(m.rlike("^[0-9]{13,16}$|^[0-9]{4}[ -]"))},
            F.when(span["base"], F.lit(1)).otherwise(zero),
        ),
        "check": _by_kind(
            span,
            {
                "card": _sign(_card(m)),
                "phone": _sign(_between(m, 9, 15) & ~before.rlike(r"\+[0-9]{1,3}[ .(-]*$")),
                "secret": _sign(m.rlike("[0-9]") & m.rlike("[A-Za-z]")),
                "ip": F.lit(1),
            },
            zero,
        ),
        "gazetteer": _by_kind(
            span,
            {
                "email": _sign(F.lower(m).rlike(rf"[.)\]\x20](?:{DOMAINS})$")),
                "ip": _sign(~m.rlike(r"^(?:0|10|127|255)\.|^192\.168\.|^169\.254\.")),
                "card": _sign(_digits(m).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")),
                "phone": F.when(m.rlike(r"^\+(?:1|3[0-9]|4[0-9]|[27]|8[16]|9[0-8])|^\(?0"), F.lit(1)).otherwise(zero),
            },
            zero,
        ),
        "context": F.when(cue, F.lit(1)).when(before.rlike(DOUBTS), F.lit(-1)).otherwise(zero),
    }


def _features(span: Column) -> dict[str, Column]:
    """Small buckets that describe a span for the final classifier."""
    m, before = span["match"], span["before"]
    digits = F.length(_digits(m))
    cue = _by_kind(span, {k: before.rlike(p) for k, p in CUES.items()}, F.lit(False))
    return {
        "length": F.when(F.length(m) < 10, 0).when(F.length(m) < 16, 1).when(F.length(m) < 20, 2).when(F.length(m) < 32, 3).otherwise(4),
        "digits": F.when(digits * 10 < F.length(m), 0).when(digits * 2 < F.length(m), 1).when(digits < F.length(m), 2).otherwise(3),
        "breaks": F.least(F.length(F.regexp_replace(m, "[^\\x20().@-]", "")), F.lit(3)),
        "cue": F.when(cue, 1).when(before.rlike(DOUBTS), 2).otherwise(0),
        "checked": _by_kind(span, {"card": F.when(_card(m), 1).otherwise(0)}, F.when(span["base"], 1).otherwise(2)),
    }


class Labelling:
    """What the votes of a corpus say: per kind a prior, and per labeler P(vote | true or not)."""

    def __init__(self, patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 60):
        self.prior: dict[int, float] = {}
        self.given: dict[tuple[int, int, int, int], float] = {}
        for kind in sorted({k for k, _, _ in patterns}):
            own = [(v, n) for k, v, n in patterns if k == kind]
            belief = {v: 0.9 if sum(v) > 0 else 0.5 if sum(v) == 0 else 0.1 for v, _ in own}
            for _ in range(rounds):
                self._maximise(kind, own, belief)
                belief = {v: self.posterior(kind, v) for v, _ in own}

    def _maximise(self, kind: int, own, belief) -> None:
        weight = {1: sum(n * belief[v] for v, n in own), 0: sum(n * (1 - belief[v]) for v, n in own)}
        self.prior[kind] = (weight[1] + 1) / (weight[0] + weight[1] + 2)
        for label in range(len(LABELERS)):
            for vote in (-1, 0, 1):
                for truth in (0, 1):
                    hits = sum(n * (belief[v] if truth else 1 - belief[v]) for v, n in own if v[label] == vote)
                    # A labeler is taken to be right more often than wrong until votes say otherwise.
                    lean = 2.0 if vote == (1 if truth else -1) else 0.5
                    self.given[kind, label, vote, truth] = (hits + lean) / (weight[truth] + 4.5)

    def posterior(self, kind: int, votes: tuple[int, ...]) -> float:
        odds = math.log(self.prior[kind]) - math.log(1 - self.prior[kind])
        for label, vote in enumerate(votes):
            odds += math.log(self.given[kind, label, vote, 1]) - math.log(self.given[kind, label, vote, 0])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


class SpanClassifier:
    """Naive Bayes over the span features, trained on soft labels; weights by kind, feature and bucket."""

    def __init__(self, rows: list[tuple[int, tuple[int, ...], float, int]]):
        weight: dict[int, list[float]] = defaultdict(lambda: [1.0, 1.0])
        counts: dict[tuple[int, int, int], list[float]] = defaultdict(lambda: [1.0, 1.0])
        for kind, features, belief, n in rows:
            for truth, share in ((1, belief), (0, 1 - belief)):
                weight[kind][truth] += n * share
                for place, bucket in enumerate(features):
                    counts[kind, place, bucket][truth] += n * share
        self.base = {k: math.log(w[1] / w[0]) for k, w in weight.items()}
        self.weights = {
            key: math.log(c[1] / (weight[key[0]][1] + 4)) - math.log(c[0] / (weight[key[0]][0] + 4))
            for key, c in counts.items()
        }

    def log_odds(self, span: Column) -> Column:
        """Log odds of a span; a kind or bucket that training has not seen counts against it."""
        base = _by_kind(span, {KINDS[k]: F.lit(v) for k, v in self.base.items()}, F.lit(-60.0))
        for place, bucket in enumerate(_features(span).values()):
            own = {f"{k} {b}": w for (k, p, b), w in self.weights.items() if p == place}
            if own:
                table = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])
                base = base + F.coalesce(table[F.concat_ws(" ", span["rank"], bucket)], F.lit(0.0))
        return base


def fit_spans(docs: DataFrame, text_column: str = "text") -> tuple[Labelling, SpanClassifier]:
    """Reliabilities and classifier from all spans of all documents."""
    spans = _spans(docs.select(quoted(text_column).alias("text")), "text").select(
        F.explode(F.concat("__base", "__wide")).alias("s")
    )
    votes, features = _votes(F.col("s")), _features(F.col("s"))
    named = spans.select(
        F.col("s.rank").alias("rank"),
        *[v.alias(f"v_{k}") for k, v in votes.items()],
        *[f.alias(f"f_{k}") for k, f in features.items()],
    )
    counted = named.groupBy(*named.columns).count().collect()  # bounded by kinds, votes and buckets
    rows = [
        (r["rank"], tuple(r[f"v_{k}"] for k in LABELERS), tuple(r[f"f_{k}"] for k in FEATURES), r["count"])
        for r in counted
    ]
    patterns: dict[tuple[int, tuple[int, ...]], int] = defaultdict(int)
    for kind, vote, _, n in rows:
        patterns[kind, vote] += n
    labelling = Labelling([(k, v, n) for (k, v), n in sorted(patterns.items())])
    return labelling, SpanClassifier([(k, f, labelling.posterior(k, v), n) for k, v, f, n in sorted(rows)])


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ","
    )


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: its id, n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    base_sha256 digests the spans of the base rules, written kind:start:end; `spans` also holds
    the candidates that the classifier accepts. NULL and empty texts have no spans. Rows stand
    by themselves, repeated rows and NULL ids too; no rows give no rows. Other columns are
    not read.
    """
    _, classifier = fit_spans(docs, text_column)
    read = docs.select(quoted(id_column).alias("__id"), quoted(text_column).alias("__in"))
    found = _spans(read, "__in").withColumn(
        "__added", F.filter("__wide", lambda s: classifier.log_odds(s) >= math.log(ACCEPT / (1 - ACCEPT)))
    )
    counts = [
        F.size(_of_rank(rank)).cast("long").alias(f"n_{kind}") for rank, kind in enumerate(BASE_KINDS)
    ]
    return found.select(
        F.col("__id").alias(id_column),
        *counts,
        F.sha2(_written(F.col("__base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("__base", "__added"))).alias("spans"),
    )
