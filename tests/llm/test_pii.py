import hashlib
import re
import time

import pytest
from pyspark.sql import types as T

from tidemark.llm import pii

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("base", T.StringType()),
])
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m.group())]
    return [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


TEXTS = [
    None, "", "nothing here", "a@b.com", "x a.b+c@mail.example.org, y", "a@b.c_d@e.f", "a@b@c.d.e", "@b.c a@ b@c d@e..f", "é🙂 ñ@x.de 🙂a@b.co",
    "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0255.0.0.1 1.2.3", "10.0.0.1/24 999.10.10.10.10.10",
    "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111111111111112", "45 4111111111111111", "1  2 3-4", "12345678901234567890123",
    "+1 (205) 555-0613", "+12", "+1234567890123456", "++4915112345678 x", "+1 555.123-4567).", "call +49 (0) 30 1234567, or +1-2",
    "mail me: q@r.st\nip 8.8.8.8 card 5500 0000 0000 0004 tel +44 20 7946 0958", "🙂" * 5 + "1.1.1.1",
    "a" * 20_000, "1" * 20_000, "1." * 15_000, "a@" + "b." * 15_000 + "c", "+1" + "(" * 20_000, "a.b@" * 8_000, "1 " * 15_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)]
    for i in range(300):
        rows.append((1000 + i, f"the heren +1 ({200 + i}) 555-{1000 + i} of 4785380592391{i:03d} and {i % 300}.10.2.{i} at u{i}@mail.example.com x", "clash"))
    rows += [(None, "a@b.com", ""), (3, "a@b.com", "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_base_spans_equal_the_patterns(docs):
    began = time.time()
    got = pii.digests(pii.find(docs, {k: pii.KindModel() for k in pii.KINDS})).collect()
    assert time.time() - began < 120
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    for row in got:
        want = plain_spans(texts[row.doc_id])
        assert row.spans == ",".join(want), texts[row.doc_id][:80]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]


def test_trees_add_spans_and_keep_the_base(spark, docs):
    models = pii.train(docs)
    assert models["phone"].threshold < float("inf")
    extra = spark.createDataFrame([(1, "call (377) 555-1234 now", ""), (2, "value 12 of 13", ""), (3, "josé@mail.example.com", "")], SCHEMA)
    got = {r.doc_id: r.spans for r in pii.digests(pii.find(extra, models)).collect()}
    assert got[1] == "phone:5:19"
    assert got[2] == ""
    assert got[3] == "email:0:21"
    full = {r.doc_id: r for r in pii.find(docs, models).collect()}
    assert all(set(map(tuple, r.base)) <= set(map(tuple, r.spans)) for r in full.values())


def test_sql_score_equals_the_trees(spark, docs):
    models = pii.train(docs)
    rows = [dict.fromkeys(pii.FEATURES, 0) | {"digits": i % 5, "lead": i % 2, "gaps": i % 4, "tail": i // 3 % 2, "luhn": i // 7 % 2} for i in range(40)]
    frame = spark.createDataFrame(rows).selectExpr(f"struct({', '.join(pii.FEATURES)}) AS c")
    for model in models.values():
        if model.threshold < float("inf"):
            taken = [r[0] for r in frame.selectExpr("c.*", model.sql("c") + " AS taken").select("taken").collect()]
            assert taken == [model.score(r) >= model.threshold for r in rows]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é a@b.co, +1 (205) 555-0613!", ""), (2, None, "")], SCHEMA)
    found = pii.find(docs, {k: pii.KindModel() for k in pii.KINDS})
    assert {r.doc_id: r.text for r in pii.redact(found).collect()} == {1: "é [EMAIL], [PHONE]!", 2: ""}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    models = pii.train(empty)
    assert all(m.sql("c") == "false" for m in models.values())
    assert pii.digests(pii.find(empty, models)).count() == 0
