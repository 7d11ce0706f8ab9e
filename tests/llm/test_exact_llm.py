import re
from collections import defaultdict

from odd_rows import ODD_ROWS, clashing, sha

from tidegate.llm.exact import drop_exact_copies, exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    out = []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        out += [(i, least, len(ids), sha(text)) for i in ids]
    return sorted(out, key=repr)


def test_matches_brute_force(odd):
    got = exact_duplicates(odd).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute(ODD_ROWS)
    # One row of each group is kept, also where id and text repeat.
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_filter_keeps_all_columns(odd):
    docs = clashing(odd)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r[3] for r in brute(ODD_ROWS)})


def test_large_group_and_empty_table(spark, nothing):
    many = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('t ', id)) as text")
    got = exact_duplicates(many)
    assert got.where("kept").count() == 2001 and got.where("group_size = 1000 and keep_id = 0").count() == 1000
    assert exact_duplicates(nothing).count() == 0
