import random
import re

from relayframe.llm import pii
from tests.llm.helpers import documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_force(text):
    out = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if valid:
                out.append((m.start(), number, m.end()))
    return sorted(out)


def test_base_spans_match_plain_patterns(spark):
    rng = random.Random(6)
    parts = ["a.b", "@", "x-1", ".", "com", " ", "1.2.3.4", "256", "0007", "+", "1 (301) 555-0346", "-", "4111111111111111"]
    parts += ["4111 1111 1111 1112", "é", "日", "\n", "%", "user@mail.example.com", "00.1.", "("]
    texts = [None, "", "a@b", "a@b.c@d.e", "x a@b.co_x@y.z", "1.2.3.4.5.6.7.8", "+1 23 456 789 01)", "1" * 30_000, "z" * 30_000 + "@"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    found = {r.id: r.spans for r in pii.find_spans(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in found[i] if s.is_base] == brute_force(text), text


def test_added_spans_and_redaction(spark):
    valid = [f"card {p} end" for p in ("4111 1111 1111 1111", "5500000000000004", "340000000000009")] * 20
    texts = [*valid, "card 4111 1111 1111 1112 end", "write to jo.doe (at) example (dot) com now", 'token = "ab12cd34ef56ab78cd90" x']
    docs = documents(spark, texts + ["mail a@example.com"] * 5 + ['password: "deadbeef1234deadbeef"'] * 5)
    from pyspark.sql import functions as F

    spans = pii.find_spans(docs)
    rows = docs.join(spans.withColumnRenamed("id", "doc_id"), "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t"))
    got = {r.doc_id: r.t for r in rows.collect()}
    assert got[0] == "card [CARD] end"
    assert "4111" not in got[60] and "1112" not in got[60]
    assert "jo.doe" not in got[61] and got[61].startswith("write to ") and got[61].endswith(" now")
    assert "ab12" not in got[62]


def test_empty_table_and_repeated_rows(spark):
    docs = documents(spark, ["a@b.cd", "a@b.cd", "plain"], ids=[None, None, 1])
    assert pii.find_spans(docs.limit(0)).count() == 0
    assert sorted(len(r.spans) for r in pii.find_spans(docs).collect()) == [0, 1, 1]


def test_values_beside_other_numbers_are_found(spark):
    card = "4111 1111 1111 1111"
    cases = {
        f"card {card} 12/26 end": card,
        f"card {card} 123 end": card,
        "card 3400 000000 00009 12/26 end": "3400 000000 00009",
        "room 24 301-555-0346 end": "301-555-0346",
        "on 2024-01-05 301-555-0346 end": "301-555-0346",
        "ssn 123-45-6789 301-555-0346 end": "123-45-6789",
        f"x 77 {card} end": card,
    }
    texts = list(cases) * 8
    found = {r.id: r.spans for r in pii.find_spans(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        at = text.index(cases[text])
        assert (at, at + len(cases[text])) in {(s.start, s.end) for s in found[i]}, (text, found[i])


def test_parts_of_long_runs_match_plain_patterns(spark):
    """Runs are cut into stretches; no part is lost or made at their ends."""
    rng = random.Random(11)
    marks = [" ", " ", "-", ".", ") ", "(", "/", "", " ("]
    texts = ["".join(str(rng.randrange(10 ** rng.randint(1, 4))) + rng.choice(marks) for _ in range(700)) + "0" for _ in range(6)]
    texts += ["1 " * 3_000, "4111 1111 1111 1111 " * 60]
    rows = pii.candidates(documents(spark, texts)).where(f"kind = {pii.KINDS.index('part')}").select("id", "start", "end").collect()
    want = set()
    for i, text in enumerate(texts):
        for run in re.finditer(pii.WIDE["number"], text):
            if len(re.sub("[^0-9]", "", run[0])) > 9:
                for pattern in pii.PARTS.values():
                    for m in re.finditer(rf"(?<![0-9(])(?=({pattern})(?![0-9]))", run[0]):
                        if len(m[1]) < len(run[0]):
                            want.add((i, run.start() + m.start(), run.start() + m.end(1)))
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
