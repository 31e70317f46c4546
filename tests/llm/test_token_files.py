import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollcall.llm import queries
from rollcall.llm import token_files as tf
from tests.conftest import rows
from tests.llm.conftest import SMALL, documents, texts_of


@pytest.fixture(scope="module")
def definition():
    return queries.tokenizer_definition()


@pytest.fixture(scope="module")
def library(definition):
    return Tokenizer.from_str(definition)


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 65_536])
def test_blocks_come_back(planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint64).astype("<u4")
    payload = tf.pack_block(ids, planes)
    assert np.array_equal(tf.unpack_block(payload), ids)
    assert struct.unpack_from("<II", payload) == (n, 32 if planes == "bit" else 4)


def test_small_ids_cost_little():
    ids = np.arange(65_536, dtype="<u4") % 2
    assert len(tf.pack_block(ids, "bit")) < 2_000


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_any_text_as_the_library(text):
    definition = queries.tokenizer_definition()
    global _coder
    coder = globals().setdefault("_coder", tf.PieceCoder(definition, 2))
    for t in (text, f"Été {text}, don't\n{text}.", f"{'q' * 300}{text} J{text}", f"A{text},\nÀ. ×. ÿ, x. {text}"):
        assert np.frombuffer(coder([t])[0], "<u4").tolist() == [*coder.tokenizer.encode(t, add_special_tokens=False).ids, 2]


def test_whole_table_as_the_library(spark, library):
    texts = texts_of(documents(spark))
    got = {r[0]: r[1:] for r in rows(queries.op8_token_files(spark, SMALL))}
    start = 0
    for key in sorted(texts):
        ids = [*library.encode(texts[key] or "", add_special_tokens=False).ids, 2]
        assert got[key] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("block", [1, 3, 64, 1 << 16])
def test_any_sizes_cross_block_edges(spark, planes, block):
    sizes = [0, 1, 5, 0, 0, 130, 64, 2, 0]
    df = spark.createDataFrame([(i, bytearray(np.arange(n, dtype="<u4") + 1000 * i)) for i, n in enumerate(sizes)], "k long, packed binary")
    blocks = tf.write_token_files(df.orderBy(F.desc("k")), "packed", "k", parts=2, block_ids=block, planes=planes)
    got = sorted((r["id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in tf.read_token_files(blocks).collect())
    starts = np.cumsum([0, *sizes])
    assert got == [(i, starts[i], (np.arange(n) + 1000 * i).tolist()) for i, n in enumerate(sizes)]


def test_numbers_of_hashes():
    rng = np.random.default_rng(1)
    keys = rng.choice(np.arange(1, 10**6, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3000, replace=False)
    crowded = np.concatenate([keys, np.arange(1, 500, dtype=np.uint64)])  # small keys all want the same place
    table = tf.HashNumbers(3500)
    for part in np.array_split(crowded, 7):
        assert (table.find(part) < 0).all()
        table.add(part)
    assert np.array_equal(table.find(crowded), np.arange(len(crowded)))
    assert table.find(np.array([10**17 + 1], np.uint64))[0] == -1 and len(table.find(np.zeros(0, np.uint64))) == 0


def test_blocks_of_one_partition():
    rows = [(4, np.arange(5, dtype="<u4").tobytes()), (5, b"")]
    found = list(tf.blocks_of(iter(rows), 3, 2, "byte"))
    assert [(r[0], r[1], r[2], r[3], r[5], r[6], r[7]) for r in found] == [
        (3, 0, 0, 2, [4], [0], [5]), (3, 1, 2, 2, [4], [0], [5]), (3, 2, 4, 1, [4, 5], [0, 5], [5, 0]),
    ]
    assert list(tf.blocks_of(iter([]), 0, 2, "byte")) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=50), max_size=6))
def test_checksum_of_joined_pieces(pieces):
    assert tf.combine_crc32([(zlib.crc32(p), len(p)) for p in pieces]) == zlib.crc32(b"".join(pieces))


def test_checksum_of_long_pieces():
    a, b = bytes(3_000_001), np.random.default_rng(1).bytes(70_000)
    assert tf.combine_crc32([(zlib.crc32(a), len(a)), (zlib.crc32(b), len(b))]) == zlib.crc32(a + b)


def test_files_grow_in_number_to_a_bound():
    assert [tf.file_count(n, 10, 5) for n in (0, 1, 10, 11, 50, 51, 1000)] == [1, 1, 1, 2, 5, 5, 5]


def wide_exchanges(df):
    """Exchanges of a plan whose rows hold the column ids or pieces of it."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    lines = plan.split("\n")
    found = []
    for i, line in enumerate(lines):
        if "Exchange " in line:
            deep = len(line) - len(line.lstrip(" :+-"))
            below = next((x for x in lines[i + 1 :] if len(x) - len(x.lstrip(" :+-")) > deep), "")
            found.append((line, below))
    return found, plan


def test_ids_stay_where_they_are_read(spark):
    """Without a limit to go by, offsets are broadcast all the same: only pieces of cut documents shuffle."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, bytearray(np.arange(50, dtype="<u4"))) for i in range(200)], "k long, packed binary")
        blocks = tf.write_token_files(df, "packed", "k", parts=3, block_ids=64)
        for read in (tf.read_token_files(blocks), tf.read_sums(blocks)):
            found, plan = wide_exchanges(read)
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
            assert all("hashpartitioning(part" in x for x, _ in found if "hashpartitioning" in x)
            assert sum("doc_start" in x and "hashpartitioning" in x for x, _ in found) == 1  # the pieces of cut documents
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("block", [3, 64])
def test_sums_of_documents(spark, block):
    sizes = [0, 1, 5, 0, 0, 130, 64, 2, 0]
    packed = [np.arange(n, dtype="<u4") + 1000 * i for i, n in enumerate(sizes)]
    df = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(packed)], "k long, packed binary")
    got = sorted(rows(tf.read_sums(tf.write_token_files(df, "packed", "k", parts=2, block_ids=block))))
    starts = np.cumsum([0, *sizes])
    assert got == [(i, starts[i], len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(packed)]


def test_large_keys_beside_null_keys(spark):
    big = (1 << 53) + 1
    df = spark.createDataFrame([(big, bytearray(8)), (None, bytearray(4)), (big + 1, bytearray(0))], "k long, packed binary")
    assert rows(tf.read_sums(tf.write_token_files(df, "packed", "k", parts=1)).orderBy("start", "id"), "id", "start", "n_ids") == [
        (None, 0, 1), (big, 1, 2), (big + 1, 3, 0),
    ]


def test_one_key_with_most_rows_is_spread(spark):
    df = spark.createDataFrame([(7, bytearray(np.full(40, i, "<u4"))) for i in range(3000)], "k long, packed binary").repartition(8)
    blocks = tf.write_token_files(df, "packed", "k", parts=6)
    sizes = [r["n"] for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * 40 * 3000


def test_odd_rows(spark, odd, nothing, definition, library):
    got = sorted(rows(tf.tokenized(odd, definition)), key=lambda r: r[1])
    assert [r[0] for r in got[:2]] == [None, None] and len(got) == odd.count()
    assert [len(r[2]) // 4 for r in got if r[0] in (3, 4, 5)] == [1, 1, 1]
    end = 0
    for _, start, ids in got:
        assert start == end
        end += len(ids) // 4
    assert rows(tf.tokenized(nothing, definition)) == []
