import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import pii, queries
from tests.conftest import rows
from tests.llm.conftest import SMALL, documents, texts_of


def by_hand(text):
    """The patterns as they are stated, without shortcuts."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def base_spans(text):
    return [(k, a, b) for k, a, b, _ in pii.find(text) if k in pii.BASE_KINDS]


@settings(max_examples=500, deadline=None)
@given(st.text("ab@.-+1239 0%()é😀", max_size=40))
def test_any_text_as_the_stated_patterns(text):
    assert base_spans(text) == by_hand(text)


def test_edges():
    for text in (
        "a@b.c@d.e", "@a.b x@y", "a@b", "..@a.b", "a@b.c.d-", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.04", "4111 1111 1111 1111-",
        "4111111111111111 4111111111111112", "+1 (202) 555-0147x", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "x" * 10_000 + "@a.b",
        "1" * 20_000, "+1" + "(" * 10_000, "999999999999.1.1.1", "0000001.2.3.4",
    ):
        assert base_spans(text) == by_hand(text), text[:40]


def test_iban_and_context():
    (kind, a, b, score) = pii.find("pay to account GB82 WEST 1234 5698 7654 32 now")[0]
    assert (kind, a, b, score) == ("iban", 15, 42, 1.0)
    assert not [s for s in pii.find("GB82 WEST 1234 5698 7654 33") if s[0] == "iban"]
    plain, near, against = (pii.find(t)[0][3] for t in ("x +44 20 7946 0958", "call me: +44 20 7946 0958", "order +44 20 7946 0958"))
    assert against < plain < near


def test_whole_table(spark):
    got = {r["doc_id"]: r for r in queries.op7_personal_data(spark, SMALL).collect()}
    texts = texts_of(documents(spark))
    assert set(got) == set(texts)
    for key, text in texts.items():
        spans = by_hand(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[key]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[key][f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]


def test_odd_rows_and_redaction(spark, odd, nothing):
    got = odd.withColumn("spans", pii.spans(spark, F.col("text")))
    assert got.count() == odd.count() and got.filter("size(spans) > 0").count() == 0
    assert rows(nothing.select(pii.spans(spark, F.col("text")))) == []
    df = spark.createDataFrame([("😀 mail me@a.bc or me@a.bc, +44 20 7946 0958.",)], "t string")
    df = df.withColumn("s", pii.spans(spark, F.col("t")))
    assert rows(df.select(pii.redacted(F.col("t"), F.col("s")))) == [("😀 mail [email] or [email], [phone].",)]
