from collections import defaultdict

from relayframe.llm.exact_dedup import PREFIX_CHARS, drop_exact_duplicates, duplicate_groups
from tests.llm.helpers import documents

LONG = "x" * (PREFIX_CHARS * 3)
TEXTS = ["a", "b", "a", "", None, "a", LONG + "1", LONG + "2", LONG + "1", "é", "ab", "A"]


def test_groups_match_brute_force(spark):
    ids = [5, 1, 9, 2, 3, 9, 4, 6, 7, None, 8, 10]
    docs = documents(spark, TEXTS, ids=ids)
    got = sorted(map(tuple, duplicate_groups(docs).collect()), key=repr)
    groups = defaultdict(list)
    for i, t in zip(ids, TEXTS):
        groups[t or ""].append(i)
    want = []
    for members in groups.values():
        known = [i for i in members if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in members:
            want.append((i, keep, len(members), i == keep and left > 0))
            left -= i == keep
    assert got == sorted(want, key=repr)


def test_stage_keeps_one_row_a_text(spark):
    docs = documents(spark, TEXTS + TEXTS)
    out = drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(r.text or "" for r in rows) == sorted({t or "" for t in TEXTS})
    assert {r.text: r.doc_id for r in rows}["a"] == len(TEXTS) + 5


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert duplicate_groups(docs, with_digest=True).count() == 0
    assert drop_exact_duplicates(docs).count() == 0
