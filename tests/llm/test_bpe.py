import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import bpe, queries
from rollcall.llm.common import ragged
from tests.conftest import rows
from tests.llm.conftest import SMALL, documents, texts_of


@pytest.fixture(scope="module")
def words():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def library(words):
    ranks = dict(zip(words.tokens, words.ids.tolist(), strict=True))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_hash_is_perfect_and_minimal(words):
    found = words.hashed.find(bpe.hash_bytes(words.tokens))
    assert np.array_equal(np.sort(found), np.arange(len(words.tokens))) and len(words.hashed.slot) == len(words.tokens)
    find = bpe.Lookup(words)
    assert [find(t) for t in words.tokens] == words.ids.tolist() and find(b"no such token at all") == -1


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 64, 1000])
def test_perfect_hash_of_any_size(n):
    keys = bpe.hash_bytes([str(i).encode() for i in range(n)])
    hashed = bpe.PerfectHash.of(keys)
    assert sorted(hashed.find(keys).tolist()) == list(range(n)) if n else len(hashed.slot) == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_any_text_as_the_library(words, library, text):
    coder, decode = bpe.Encoder(words), bpe.Decoder(words)
    packed = [coder.encode(t) for t in (text, "", text + " " + text)]
    assert np.frombuffer(packed[0], "<u4").tolist() == library.encode_ordinary(text)
    assert packed[1] == b"" and decode(packed) == [text.encode(), b"", (text + " " + text).encode()]


def test_whole_table_as_the_library(spark, library):
    texts = texts_of(documents(spark))
    got = {r[0]: r[1:] for r in rows(queries.op3_byte_bpe(spark, SMALL))}
    assert set(got) == set(texts)
    for key, text in texts.items():
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert got[key] == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_odd_rows(spark, odd, nothing, words):
    coded = odd.withColumn("packed", bpe.encode(spark, words, F.col("text")))
    back = coded.select("text", bpe.decode(spark, words, F.col("packed")).cast("string").alias("back"), bpe.n_tokens(F.col("packed")))
    for text, again, n in rows(back):
        assert again == (text or "") and (n > 0) == bool(text)
    assert rows(nothing.select(bpe.encode(spark, words, F.col("text")))) == []
    verified = odd.select(bpe.encode(spark, words, F.col("text"), verify=True))
    assert sorted(rows(verified)) == sorted(rows(coded.select("packed")))


def test_ragged():
    assert ragged(np.array([5, 0, 9, 2]), np.array([2, 0, 1, 3])).tolist() == [5, 6, 9, 2, 3, 4]
    assert ragged(np.array([], int), np.array([], int)).tolist() == []
