import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rollcall.llm import queries, secrets
from tests.conftest import rows
from tests.llm.conftest import SMALL, documents, texts_of

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def by_hand(text):
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted(((m.start(), order[k], m.end(), k) for k, m in found))


def test_whole_table(spark):
    got = {r["doc_id"]: r for r in queries.op6_secrets(spark, SMALL).collect()}
    texts = texts_of(documents(spark))
    assert set(got) == set(texts)
    for key, text in texts.items():
        spans = by_hand(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert got[key]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), key
        assert [got[key][f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")
        ]


TRICKY = [
    "password=abcdef", "PassWord : 'abc", "secret=token=abcdefg", "secret = \"tok token:123456 api_key=  q", "apikey:aaaaaa API_KEY=bbbbbbb",
    "😀😀 token='🙂' token=abcdef 😀", "AKIA" + "A" * 15, "AKIA" + "B" * 16 + "c" + "AKIA" * 6, "f" * 23, "f" * 24 + "g" + "0" * 40,
    "passwd=", "password=a password=abcdef", "", None, "secret", "x" * 50_000 + "secret=abcdef", "tokentoken=token=1", "token=abcde" * 40,
]


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_tricky_texts_as_plain_expressions(spark, broadcast_rows):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    found = secrets.scan(df, secrets.BASE, broadcast_rows=broadcast_rows)
    got = dict(rows(found, "doc_id", secrets.joined_spans(F.col("found"), secrets.BASE)))
    for key, text in enumerate(TRICKY):
        assert got[key] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in by_hand(text or "")), text


def test_counted_expressions_find_the_same(spark):
    """Random runs of the letters that the base kinds are made of."""
    import random

    rng = random.Random(4)
    parts = ["a" * 7, "0f" * 6, "F", "AKIA", "AKI", "Z9" * 5, "g", " ", "token=", "b" * 24, "12345", "=", "secret:"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = dict(rows(secrets.scan(df, secrets.BASE), "doc_id", secrets.joined_spans(F.col("found"), secrets.BASE)))
    assert all(got[k] == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in by_hand(t)) for k, t in enumerate(texts))
    assert sum(map(bool, got.values())) > 1000


def test_very_long_texts(spark):
    """20 MB of runs that are no secrets, of runs that are, and of one run."""
    key = "0123456789abcdef" * 2
    texts = {1: "face " * 4_000_000, 2: f"{key} ghost " * 60_000, 3: "f" * 3_000_000, 4: "😀 token=abcdefgh\n" * 20_000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["found"] for r in secrets.scan(df, secrets.BASE).select("doc_id", "found").collect()}
    assert found[1]["hex"] == [] and found[3]["hex"] == [(0, 3_000_000)]
    assert found[2]["hex"] == [(39 * i, 39 * i + 32) for i in range(60_000)]
    assert found[4]["assign"] == [(17 * i + 2, 17 * i + 16) for i in range(20_000)]


def test_added_kinds(spark):
    text = ("-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " xoxb-123456789012 eyJhbGci.eyJzdWIi.c2ln AIza" + "x" * 35)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    one = secrets.scan(df).first()["found"]
    assert [len(one[r.kind]) for r in secrets.ADDED] == [1] * 5
    for rule in secrets.ADDED:
        a, b = one[rule.kind][0]
        assert re.fullmatch(rule.regex, text[a:b])


def test_trigram_queries_hold_for_matches():
    queries_of = {r.kind: r.query for r in secrets.RULES}
    assert queries_of["hex"] == [] and queries_of["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in queries_of["assign"] and len(queries_of["assign"]) == 6
    assert secrets.trigram_query("ab[cd]ef") == [] and secrets.trigram_query("(abc|xyz)+q?") == [frozenset({"abc"}), frozenset({"xyz"})]
    assert secrets.trigram_query("a?bcd") == [frozenset({"bcd"})] and secrets.trigram_query("abc|d") == []


def test_odd_rows(odd, nothing):
    got = secrets.scan(odd)
    assert sorted(got.columns) == sorted(odd.columns) and got.count() == odd.count()
    assert rows(secrets.scan(nothing)) == []


def test_no_python_in_the_plan(spark):
    plan = secrets.scan(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)
