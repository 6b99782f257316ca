"""Stitched encoding against encoding at once, and the round trip."""

from __future__ import annotations

from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from turnmill.llm.bpe import Codec, boundaries, decode, encode_documents, encode_piece, encoding, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return encoding(read_ranks(PATH), PATTERN)


def expected(own, text):
    ids = own.encode_ordinary(text or "")
    digests = sha256(",".join(map(str, ids)).encode()), sha256((text or "").encode())
    return len(ids), *(d.hexdigest() for d in digests), ids


@pytest.mark.parametrize("chunk,overlap", [(40, 15), (1000, 100), (10**6, 10)])
def test_awkward_rows(awkward, own, chunk, overlap):
    made = encode_documents(awkward, PATH, PATTERN, chunk=chunk, overlap=overlap)
    assert made.columns == [*awkward.columns, "bpe"]
    rows = made.collect()
    assert len(rows) == awkward.count()
    for row in rows:
        assert tuple(row["bpe"]) == expected(own, row["text"])


def test_texts_that_do_not_resynchronise_are_encoded_whole(spark, own):
    texts = ["x" * 500, "a'" * 300 + "re" * 9, " " * 400 + "b", "it's  \n\n we'll 'tis " * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for row in encode_documents(docs, PATH, PATTERN, chunk=64, overlap=9).collect():
        assert tuple(row["bpe"]) == expected(own, row["text"])


def test_decoding_gives_the_bytes_back(spark, awkward):
    codec = Codec(spark, PATH, PATTERN)
    made = encode_documents(awkward, PATH, PATTERN)
    for row in made.select("text", decode(codec)("bpe.ids").alias("d")).collect():
        assert bytes(row["d"]) == (row["text"] or "").encode()


def test_empty_table(nothing):
    assert encode_documents(nothing, PATH, PATTERN).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \n'arelv.é1!", min_size=2, max_size=60), st.data())
def test_a_piece_between_boundaries_is_encoded_like_the_whole(own, text, data):
    ends = [0, *boundaries(text, PATTERN)]
    cut = data.draw(st.sampled_from(ends))
    left = encode_piece(own, text, PATTERN, 0, cut)
    assert left + encode_piece(own, text, PATTERN, cut, len(text)) == own.encode_ordinary(text)


def test_a_column_of_the_result_name_is_replaced(spark, own, awkward):
    made = encode_documents(awkward.withColumn("BPE", F.lit(1)), PATH, PATTERN, chunk=64, overlap=9)
    assert made.columns == [*awkward.columns, "bpe"]
    for row in made.collect():
        assert tuple(row["bpe"]) == expected(own, row["text"])
