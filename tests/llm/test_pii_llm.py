import random
import re

from odd_rows import ODD_ROWS, clashing, sha

from tidegate.llm.pii import BASE_KINDS, Labelling, personal_data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


RULES = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def base(text):
    found = []
    for rank, (pattern, valid) in enumerate(RULES):
        found += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text or "") if valid(m.group())]
    return [f"{BASE_KINDS[r]}:{s}:{e}" for s, r, e in sorted(found)]


def check(docs, rows):
    got = sorted(personal_data(docs).collect(), key=repr)
    want = sorted([(d, *[sum(s.startswith(k) for s in base(t)) for k in BASE_KINDS], sha(",".join(base(t)))) for d, t in rows], key=repr)
    assert sorted([tuple(r)[:6] for r in got], key=repr) == want
    return got


def test_base_spans_match_brute_force(spark):
    random_, rows = random.Random(8), list(ODD_ROWS)
    parts = ["a.b@c.de", "x@y", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "00012.1.1.1", "4111 1111 1111 1111",
             "4111111111111112", "+1 (017) 555-7713", "+12", "+49.30-1234567", "é", " ", "-", ".", "@", "7", "a@b.c_d@e.f",
             "00", "(", "+", "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "\n"]
    rows += [(100 + i, "".join(random_.choice(parts) for _ in range(random_.randint(1, 25)))) for i in range(400)]
    rows += [(900, "a" * 60_000 + "@"), (901, "1" * 60_000), (902, "+1" + "(" * 60_000), (903, "1.2." * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in check(clashing(docs), rows):
        own = base(dict(rows).get(r.doc_id))
        spans = [s for s in r.spans.split(",") if s]
        if r.doc_id is not None and r.doc_id >= 100:
            assert [s for s in spans if s in own] == own  # base spans stay, in order


def test_ip_parts_may_be_zero(spark):
    random_ = random.Random(9)
    ips = ["10.0.0.1", "0.0.0.0", "1.2.3.0", "192.168.000.1", "00.1.2.3", "255.255.255.0", "256.0.0.1", "1.0.0.1000", "0.0.0.00256"]
    rows = [(i, f"from {ip} on") for i, ip in enumerate(ips)]
    rows += [(100 + i, "".join(random_.choice([*ips, ".", "0", " "]) for _ in range(9))) for i in range(200)]
    rows += [(900, "0" * 4_000 + ".0.0.0"), (901, "0.0.0." + "0" * 4_000 + "300"), (902, ".".join(["0" * 4_000] * 4))]
    got = {r.doc_id: r.n_ip for r in check(spark.createDataFrame(rows, "doc_id long, text string"), rows)}
    assert [got[i] for i in range(len(ips))] == [1] * 6 + [0] * 3
    assert got[900] == 1 and got[901] == 0 and got[902] == 1


def test_method_adds_secrets(spark):
    rows = [(i, f"call token = {i:08x}{'0123456789abcdef' * 2} now") for i in range(50)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert all("secret:13:53" in r.spans for r in got)


def test_secrets_of_any_length(spark):
    rows = [(i, f"call token = {i:08x}{'0123456789abcdef' * 2} now") for i in range(50)]
    rows += [(100, f"call token = {'0123456789abcdef' * 8}0 now"), (101, f"call token = {'0123456789abcdef' * 2_000} now")]
    rows += [(102, "call token = " + "ab" * 64 + "-" + "x" * 200)]  # no digit
    got = {r.doc_id: r.spans for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "secret:13:142" and got[101] == "secret:13:32013" and got[102] == ""


def test_empty_table(nothing):
    assert personal_data(nothing).count() == 0


def test_labelling_learns_reliability():
    # The second labeler is noise, the others agree with the truth most of the time.
    random_, counts = random.Random(2), {}
    for _ in range(4000):
        truth = random_.random() < 0.3
        votes = tuple(
            (1 if truth else -1) if random_.random() < right else (-1 if truth else 1) for right in (0.95, 0.5, 0.9, 0.9)
        )
        counts[votes] = counts.get(votes, 0) + 1
    learnt = Labelling([(0, v, n) for v, n in sorted(counts.items())])
    assert abs(learnt.prior[0] - 0.3) < 0.05
    assert learnt.given[0, 0, 1, 1] > 0.9 and abs(learnt.given[0, 1, 1, 1] - 0.5) < 0.1


def test_a_text_full_of_matches_takes_its_length(spark):
    """Two hundred thousand numbers in one text; quadratic work would take hours."""
    import time

    text = " ".join(f"{i:07d}" for i in range(200_000))
    mails = " ".join(f"a{i}@b.com" for i in range(50_000))
    docs = spark.createDataFrame([(1, text), (2, mails), (3, "x 1.2.3.4 y")], "doc_id long, text string")
    begun = time.time()
    got = {r.doc_id: r for r in personal_data(docs).collect()}
    assert time.time() - begun < 120
    assert got[2].n_email == 50_000 and got[3].n_ip == 1
    spans, at = [], 0
    for i in range(50_000):
        mail = f"a{i}@b.com"
        spans.append(f"email:{at}:{at + len(mail)}")
        at += len(mail) + 1
    assert got[2].base_sha256 == sha(",".join(spans))
