import random
import re

from odd_rows import ODD_ROWS, clashing, sha

from tidegate.llm.decontam import contamination, drop_contaminated

ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta"),
    (2, "One, two!"),
    (3, None),
    (4, "..."),
    (12, " ".join(f"k{i}" for i in range(25))),
    (5, " ".join(f"k{i}" for i in range(12))),
    (5, "alpha beta gamma delta epsilon zeta eta"),
    (6, "long long long long long long long long long long long"),
    (7, "solo"),
]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items):
    windows = {}
    for item, text in items:
        held = words(text)
        for i in range(max(1, len(held) - 9) if held else 0):
            windows.setdefault(tuple(held[i : i + 10]), set()).add(str(item))
    out = []
    for doc, text in rows:
        held, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(held) - size + 1):
                if (w := tuple(held[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[w]
        out.append((doc, len(held), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    random_ = random.Random(9)
    rows = list(ODD_ROWS)
    for doc in range(100, 160):
        text = [random_.choice(["the", "of", "Alpha", "two", "k5", "long", "été"]) for _ in range(random_.randint(0, 60))]
        for _ in range(random_.randint(0, 3)):
            part = words(random_.choice(ITEMS)[1])
            at = random_.randint(0, len(text))
            text[at:at] = part[random_.randint(0, 3) : random_.randint(4, 40)]
        rows.append((doc, random_.choice([" ", ", ", "\n"]).join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contamination(clashing(docs), clashing(bench)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, ITEMS)
    clean = drop_contaminated(clashing(docs), bench)
    assert clean.columns == clashing(docs).columns
    assert clean.where("doc_id >= 100").count() == sum(not r[-1] for r in brute(rows, ITEMS) if (r[0] or 0) >= 100)


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(odd, none).where("contaminated or n_items > 0 or n_hit > 0").count() == 0
    assert contamination(odd, none).count() == len(ODD_ROWS)
    assert contamination(nothing, none).count() == 0
