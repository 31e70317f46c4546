import corpus_pipeline
from rollcall.llm import decontaminate, queries, toxicity
from rollcall.llm.common import keep_table
from tests.llm.conftest import SMALL, documents, texts_of
from tests.llm.test_near import plain_groups


def test_every_stage_does_its_work_on_what_the_one_before_kept(spark):
    docs = documents(spark)
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = texts_of(docs)
        docs = keep_table(stage(spark, docs, SMALL), name)
        kept[name] = (before, {r["doc_id"] for r in docs.select("doc_id").collect()})
        assert docs.columns == columns or name == "byte_bpe"

    before, after = kept["toxicity"]
    model = toxicity.learn(documents(spark), queries.table(spark, SMALL, "labels"))
    verdict = dict(toxicity.with_toxicity(documents(spark), model).select("doc_id", "toxic").collect())
    assert after == {k for k in before if not verdict[k]} and len(after) < len(before)

    before, after = kept["exact_dedup"]
    last = {}
    for k, t in before.items():
        last[t or ""] = max(k, last.get(t or "", k))
    assert after == set(last.values())

    before, after = kept["near_dedup"]
    assert after == {k for k, (_, c) in plain_groups(before).items() if k == c} and len(after) < len(before)

    before, after = kept["decontaminate"]
    items = [decontaminate.words_of(r["text"]) for r in queries.table(spark, SMALL, "benchmark").collect()]
    for k, text in before.items():
        joined = f" {' '.join(decontaminate.words_of(text or ''))} "
        if any(f" {' '.join(w)} " in joined for w in items):
            assert k not in after
    assert len(before) - 40 < len(after) < len(before)

    before, after = kept["byte_bpe"]
    assert after == set(before) and docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


def test_stages_are_in_order_and_registered():
    import __spark_entry__

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "byte_bpe"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in __spark_entry__.queries()}


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_odd_rows_in_every_stage(spark, odd, tmp_path):
    """Null, repeated, empty, long and clashing: what each stage leaves is what its docstring says."""
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, "A text, without an ID!"), (2, None), (None, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = odd, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = keep_table(stage(spark, docs, str(tmp_path)), name)
        assert name == "byte_bpe" or docs.columns == odd.columns
        left[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert left["toxicity"] == sorted((r["doc_id"] for r in odd.collect()), key=str)
    assert left["exact_dedup"] == left["near_dedup"] == sorted([2, 4, 5, 6, 7, None], key=str)
    assert left["decontaminate"] == left["byte_bpe"] == [2, 4, 5, 6, 7]
    sizes = {r["doc_id"]: (r["n_tokens"], len(r["ids"])) for r in docs.collect()}
    assert sizes[4] == (0, 0) and sizes[7][0] > 30_000
