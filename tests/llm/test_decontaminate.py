import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import decontaminate as dc
from rollcall.llm import queries
from tests.conftest import rows
from tests.llm.conftest import SMALL, documents, texts_of


def plain_alignment(a, b):
    best, row = 0, [0] * (len(a) + 1)
    for w in b:
        new = [0]
        for j, x in enumerate(a, 1):
            new.append(max(0, row[j - 1] + (2 if x == w else -1), row[j] - 1, new[-1] - 1))
        row, best = new, max(best, *new)
    return best


@pytest.mark.parametrize("seed", range(30))
def test_alignment_equals_plain_loops(seed):
    rnd = random.Random(seed)
    a, b = ([rnd.choice("abcdef") for _ in range(rnd.randint(1, 40))] for _ in range(2))
    assert dc.alignment(a, b)[0] == plain_alignment(a, b)
    assert dc.alignment(list("xxabcdyy"), list("abcd")) == (8, 6)


def words(rnd, n):
    return [f"k{rnd.randrange(5000)}" for _ in range(n)]


@pytest.fixture()
def corpus(spark):
    rnd = random.Random(3)
    items = [words(rnd, 30) for _ in range(8)]
    items[7] = words(rnd, 4)
    docs = {}
    for i in range(60):
        docs[i] = words(rnd, rnd.randint(20, 300))
    for i in range(8):  # whole copies in the middle
        docs[100 + i] = words(rnd, 50) + items[i] + words(rnd, 50)
    for i in range(7):  # a fifth of the words changed, two words left out
        edited = [w if rnd.random() > 0.2 else "changed" for w in items[i]]
        del edited[10:12]
        docs[200 + i] = words(rnd, 20) + edited + words(rnd, 9)
    for i in range(40):  # item 0 leaks often and is still found
        docs[300 + i] = items[0] + words(rnd, 5)
    docs[400] = words(rnd, 30) + items[1][:8] + words(rnd, 30)  # a quarter of an item is none
    bench = spark.createDataFrame([(i, " ".join(w).upper() + "!") for i, w in enumerate(items)], "item_id long, text string")
    return spark.createDataFrame([(k, ", ".join(w)) for k, w in docs.items()], "doc_id long, text string"), bench


@pytest.mark.parametrize("max_bits", [1 << 10, 1 << 26])
def test_copies_and_edited_copies_are_found_and_nothing_else(corpus, max_bits):
    docs, bench = corpus
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.contaminated(docs, bench, max_bits=max_bits).collect()}
    want = {(100 + i, i) for i in range(8)} | {(200 + i, i) for i in range(7)} | {(300 + i, 0) for i in range(40)}
    assert set(got) == want
    assert all(got[100 + i, i] == 1 for i in range(8)) and all(0.4 <= got[200 + i, i] < 1 for i in range(7))
    left = dc.without_contaminated(docs, bench)
    assert {r["doc_id"] for r in left.collect()} == {*range(60), 400} and left.columns == docs.columns
    assert dc.without_contaminated(docs, bench, broadcast_rows=0).count() == 61


def test_whole_table_against_every_pair(spark):
    found = {(r["doc_id"], r["item_id"]) for r in queries.op10_decontaminate(spark, SMALL).collect()}
    items = {r["item_id"]: dc.words_of(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = set()
    for key, text in texts_of(documents(spark)).items():
        joined = f" {' '.join(dc.words_of(text or ''))} "
        want |= {(key, i) for i, w in items.items() if f" {' '.join(w)} " in joined}
    assert want <= found and len(want) > 10
    # whatever else is found aligns with four tenths of the item or more
    assert len(found - want) <= 2


def test_a_common_phrase_is_no_seed(spark):
    phrase = "this is a very common phrase"
    docs = spark.createDataFrame([(i, f"{phrase} n{i} m{i} o{i}") for i in range(200)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, f"{phrase} " + " ".join(f"z{i}" for i in range(12)))], "item_id long, text string")
    assert dc.contaminated(docs, bench).count() == 0


@pytest.mark.parametrize("copies", [25, 400])
def test_one_edited_copy_in_many_documents(spark, copies):
    rnd = random.Random(5)
    items = [words(rnd, 38) for _ in range(12)]
    edited = [[w if rnd.random() > 0.2 else "changed" for w in item] for item in items]
    edited[0] = [w if k % 5 != 4 else "changed" for k, w in enumerate(items[0])]
    edited[1] = items[1][:20]
    docs = [(100 * copies + i, " ".join(words(rnd, 60))) for i in range(50)]
    docs += [(i * copies + k, " ".join(words(rnd, 9) + e + words(rnd, 9))) for i, e in enumerate(edited) for k in range(copies)]
    docs += [(200 * copies + i, " ".join(words(rnd, 9) + item + words(rnd, 9))) for i, item in enumerate(items)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    want = {(i * copies + k, i) for i in range(12) for k in range(copies)} | {(200 * copies + i, i) for i in range(12)}
    assert all(plain_alignment(e, i) >= 0.4 * 2 * 38 for e, i in zip(edited, items, strict=True))
    assert got == want


def test_words_of_many_scripts():
    assert dc.words_of("Übung, ÉTÉ_2 don't") == ["übung", "été_2", "don", "t"]
    assert dc.words_of("北京是。首都ab 犬1") == ["北", "京", "是", "首", "都", "ab", "犬", "1"]
    assert dc.words_of("ภาษา かな") == [*"ภาษา", *"かな"] and dc.words_of("Привет мир, 한국어 x𠀀y") == ["Привет", "мир", "한국어", "x", "𠀀", "y"]
    for text in ("", "中", "a中", "中a", "、中", "中、", "𠀀"):
        assert dc.words_of(text) == [c for c in text if c != "、"]


def test_scripts_without_spaces_and_other_letters(spark):
    rnd = random.Random(8)
    han = [chr(0x4E00 + k) for k in range(3000)]
    item = "".join(rnd.choices(han, k=40))
    edited = "".join(c if rnd.random() > 0.15 else rnd.choice(han) for c in item)
    cyrillic = ["".join(rnd.choices("абвгдежзиклмнопрстуфхц", k=6)) for _ in range(30)]
    changed = [w if k % 5 else "иначе" for k, w in enumerate(cyrillic)]
    filler = lambda: "".join(rnd.choices(han, k=200))
    docs = [(i, filler()) for i in range(30)] + [(100, filler() + item + filler()), (101, filler() + "。" + edited)]
    docs += [(200, "начало " + " ".join(changed) + " конец"), (201, "начало " + " ".join(cyrillic) + " конец")]
    bench = spark.createDataFrame([(1, item), (2, " ".join(cyrillic))], "item_id long, text string")
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()}
    assert set(got) == {(100, 1), (101, 1), (200, 2), (201, 2)} and got[100, 1] == got[201, 2] == 1


def test_items_shorter_than_an_n_gram(spark):
    docs = [(i, f"some words of number n{i} and the others") for i in range(60)]
    docs += [(100, "he said Quixotic Zephyr!"), (101, "quixotic, zephyr"), (102, "zephyr quixotic"), (103, "only xylograph here")]
    bench = spark.createDataFrame([(1, "Quixotic zephyr"), (2, "xylograph"), (3, "the others"), (4, "?!")], "item_id long, text string")
    found = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in found.collect()} == {(100, 1, 1.0), (101, 1, 1.0), (103, 2, 1.0)}


def test_a_long_item_lengthens_no_other_passages(spark):
    rnd = random.Random(9)
    short, long = words(rnd, 20), words(rnd, 3000)
    docs = [(1, " ".join(words(rnd, 4000) + short + words(rnd, 4000))), (2, " ".join(words(rnd, 50) + long[500:2600] + words(rnd, 50)))]
    items = spark.createDataFrame([(0, " ".join(short)), (1, " ".join(long))], "item long, text string")
    grams = dc.item_grams(items, 3)
    seeds = grams.select("item", "class", "gram", F.lit(9).alias("seeds"))
    classes = dc.classes_of(seeds, grams.groupBy("class").agg(F.max("size").alias("size")), 3, 2, 1 << 20)
    assert [(c.n, c.reach, c.least) for c in classes] == [(3, 20, 2), (3, 3000, 2)]
    found = dc.passages(spark.createDataFrame(docs, "id long, text string"), classes)
    sizes = {(r["id"], r["class"]): len(r["words"].split()) for r in found.collect() if len(r["grams"]) >= 18}
    assert sizes[1, classes[0].number] == 60 and sizes[2, classes[1].number] == 2200
    bench = items.withColumnRenamed("item", "item_id")
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 0), (2, 1)}


def test_texts_are_counted_once(spark, monkeypatch):
    """The counts of pass 1 are a table by the time the seeds are chosen."""
    seen = []
    real = dc.rare_seeds

    def chosen(found, counts, *more):
        seen.append(counts._jdf.queryExecution().executedPlan().toString())
        return real(found, counts, *more)

    monkeypatch.setattr(dc, "rare_seeds", chosen)
    queries.op10_decontaminate(spark, SMALL)
    assert len(seen) == 1 and "MapInPandas" not in seen[0] and "Scan parquet" in seen[0]


def test_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame(
        [(1, "two three four five six"), (1, "two three four five six"), (2, None), (3, ""), (4, "ab"), (None, "text without an id")],
        "item_id long, text string",
    ).withColumn("gram", F.lit(1))
    got = sorted(rows(dc.contaminated(odd, bench).select("doc_id", "item_id", "score")), key=str)
    assert got == sorted([(1, 1, 1.0), (2, 1, 1.0), (None, None, 1.0)], key=str)
    left = dc.without_contaminated(odd, bench)
    assert left.columns == odd.columns and {3, 4, 5, 6, 7} <= {r["doc_id"] for r in left.collect()}
    assert rows(dc.contaminated(nothing, bench)) == [] and rows(dc.contaminated(odd, bench.limit(0))) == []
    assert dc.without_contaminated(odd, bench.limit(0)).count() == odd.count()
