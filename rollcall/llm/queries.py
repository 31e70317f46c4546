"""The registered queries of the text operators, and SQL where SQL can express them.

Each reads whole tables through its operator and derives digests from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    alignment,
    bpe,
    decontaminate,
    exact,
    hmm,
    html,
    lexical,
    near,
    neighbours,
    pii,
    secrets,
    token_files,
    toxicity,
)
from rollcall.llm.common import keep_table, remainder, text_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(path: str | None = None, pattern: str | None = None) -> bpe.Vocabulary:
    """The byte-level vocabulary; by default the public file that is installed beside the libraries."""
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    return bpe.Vocabulary.read(path, pattern)


def tokenizer_definition(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def aligned_tokenizers(a: str | None = None, b: str | None = None) -> tuple[str, bytes]:
    """The definition of the byte-level tokenizer and the sentencepiece model, by default the public files."""
    if a is None or b is None:
        import public_tokenizers

        a = a or public_tokenizers.path("byte_bpe_50k.json")
        b = b or public_tokenizers.path("piece_bpe_32k.model")
    with open(a, encoding="utf-8") as definition, open(b, "rb") as model:
        return definition.read(), model.read()


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.with_toxicity(docs, model).select("doc_id", held, "score", "predicted", "threshold", "toxic")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    words = vocabulary()
    docs = table(spark, folder, "documents")
    coded = docs.select("doc_id", bpe.encode(spark, words, text_of("text")).alias("ids"))
    both = coded.withColumn("decoded", bpe.decode(spark, words, F.col("ids")))
    return both.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(table(spark, folder, "pages"))
    size = F.length("main_text").cast("long").alias("n_chars")
    return found.select("page_id", "url", F.col("main_text").alias("text"), size)


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_groups(table(spark, folder, "documents"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = keep_table(secrets.scan(table(spark, folder, "documents")).select("doc_id", "found"), "spans")
    counts = [F.size(f"found.{r.kind}").cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.joined_spans(F.col("found"), secrets.BASE), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("found"), secrets.RULES).alias("spans"),
    )


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = docs.select("doc_id", pii.spans(spark, F.col("text")).alias("found"))

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"),
    )


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    blocks = token_files.write_tokenized(table(spark, folder, "documents"), tokenizer_definition())
    sums = token_files.read_sums(blocks)
    return sums.select(F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def op9_hmm_score(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.scored(table(spark, folder, "documents"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"), *aligned_tokenizers())


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_exact_dedup,
        op3_byte_bpe,
        op4_html_text,
        op5_near_dedup,
        op6_secrets,
        op7_personal_data,
        op8_token_files,
        op9_hmm_score,
        op10_decontaminate,
        op11_token_alignment,
        op12_ranked_search,
        op13_nearest_vectors,
    )
}

#: The others are tested against brute-force versions, round trips or held-out accuracy: see tests/llm.
SQL: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_ranked_search": r"""
        WITH found AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
        factor AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM sizes, total),
        asked AS (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        scores AS (
          SELECT item_id, doc_id,
                 sum(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN factor USING (doc_id), total GROUP BY ALL),
        ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 20""",
}
