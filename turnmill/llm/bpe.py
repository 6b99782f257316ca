"""Byte-level BPE encoding and decoding with given ranks.

A text is pre-tokenised by the pattern and each match is encoded by itself. Texts longer than a
chunk are cut into overlapping chunks that tasks pre-tokenise in parallel. A match depends only on
the text from its start on, so once a chunk and its predecessor share a boundary in their overlap,
they agree from there on: the first common boundary is where the one hands over to the other. A
text with an overlap that shares no boundary (one run of letters, say) is encoded whole.
Decoding concatenates the bytes of the tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnmill.llm.common import free_name
from turnmill.session import materialize

CHUNK = 65_536  # characters
OVERLAP = 2_048  # characters on either side of a chunk
UNSURE = 8  # the end of a chunk may cut a match; boundaries this close to it are not used
BATCH_MATCHES = 100_000  # distinct matches remembered by a task

_ENCODINGS: dict[tuple[str, int], tiktoken.Encoding] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoder, built once per worker process."""
    key = (pattern, hash(ranks))
    if key not in _ENCODINGS:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _ENCODINGS[key] = tiktoken.Encoding(
            "given",
            pat_str=pattern,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={},
        )
    return _ENCODINGS[key]


class Codec:
    """Ranks and pattern, handed to tasks as one broadcast of the vocabulary file."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str) -> None:
        self.pattern = pattern
        self.ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def get(self) -> tiktoken.Encoding:
        return encoding(self.ranks.value, self.pattern)


def boundaries(text: str, pattern: str, start: int = 0) -> list[int]:
    """Ends of the matches from `start` on."""
    return [match.end() for match in regex.compile(pattern).finditer(text, start)]


def encode_piece(codec: tiktoken.Encoding, text: str, pattern: str, start: int, end: int) -> list[int]:
    """Ids of the matches from boundary `start` to boundary `end`; the rest is looked at only."""
    ids: list[int] = []
    known: dict[str, list[int]] = {}
    for match in regex.compile(pattern).finditer(text, start):
        if match.start() >= end:
            break
        piece = match.group()
        if piece not in known:
            if len(known) >= BATCH_MATCHES:
                known.clear()
            known[piece] = codec.encode_ordinary(piece)
        ids += known[piece]
    return ids


def digest(codec: tiktoken.Encoding, ids: list[int]) -> tuple[int, str, str]:
    named = ",".join(map(str, ids)).encode()
    decoded = codec.decode_bytes(ids)
    return len(ids), sha256(named).hexdigest(), sha256(decoded).hexdigest()


def _whole_udf(codec: Codec, with_ids: bool):
    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    @F.pandas_udf(fields + (", ids array<int>" if with_ids else ""))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec.get()
        for texts in batches:
            rows = []
            for text in texts:
                ids = own.encode_ordinary(text or "")
                rows.append((*digest(own, ids), ids)[: 4 if with_ids else 3])
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            yield pd.DataFrame(rows, columns=names[: 4 if with_ids else 3])

    return encode


def _edges_udf(pattern: str, overlap: int):
    @F.pandas_udf("head array<int>, tail array<int>")
    def edges(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for pieces, offsets, starts, ends in batches:
            rows = []
            for piece, offset, start, end in zip(pieces, offsets, starts, ends):
                sure = offset + len(piece) - UNSURE
                found = [offset + b for b in boundaries(piece, pattern) if offset + b <= sure]
                rows.append(
                    (
                        [b for b in found if start - overlap <= b <= start + overlap],
                        [b for b in found if b >= end - overlap],
                    )
                )
            yield pd.DataFrame(rows, columns=["head", "tail"])

    return edges


def _piece_udf(codec: Codec):
    @F.pandas_udf("array<int>")
    def encode(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.Series]:
        own = codec.get()
        for pieces, starts, ends in batches:
            yield pd.Series(
                [
                    encode_piece(own, piece, codec.pattern, int(start), int(end))
                    for piece, start, end in zip(pieces, starts, ends)
                ],
                dtype=object,
            )

    return encode


def _digest_udf(codec: Codec):
    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def of_ids(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec.get()
        for many in batches:
            rows = [digest(own, [int(i) for i in ids]) for ids in many]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return of_ids


def decode(codec: Codec):
    """A UDF from ids to bytes."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec.get()
        for many in batches:
            yield pd.Series([own.decode_bytes([int(i) for i in ids]) for ids in many])

    return decoded


def _encode_long(texts: DataFrame, codec: Codec, chunk: int, overlap: int) -> DataFrame:
    """`key, ids` of distinct texts `key, text` by stitched chunks; ids are null where that failed."""
    length = F.length("text")
    pieces = (
        texts.withColumn("k", F.explode(F.sequence(F.lit(0), F.ceil(length / chunk).cast("int") - 1)))
        .withColumns({"start": F.col("k") * chunk, "end": F.least((F.col("k") + 1) * chunk, length)})
        .withColumn("offset", F.greatest(F.col("start") - overlap, F.lit(0)))
        .withColumn(
            "piece",
            F.substring("text", F.col("offset") + 1, F.col("end") + overlap - F.col("offset")),
        )
        .drop("text")
        .repartition("key", "k")
    )
    near = _edges_udf(codec.pattern, overlap)("piece", "offset", "start", "end")
    edged = pieces.withColumn("near", near)
    chunks = Window.partitionBy("key").orderBy("k")
    common = F.array_min(F.array_intersect("near.head", F.lag("near.tail").over(chunks)))
    joined = edged.withColumn("from", F.when(F.col("k") == 0, 0).otherwise(common)).withColumns(
        {
            "to": F.coalesce(F.lead("from").over(chunks), F.lit(2**31 - 1)),
            "lost": F.max(F.col("from").isNull()).over(Window.partitionBy("key")),
        }
    )
    ids = _piece_udf(codec)("piece", F.col("from") - F.col("offset"), F.col("to") - F.col("offset"))
    done = (
        joined.filter("not lost")
        .select("key", "k", ids.alias("ids"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("all"))
        .select("key", F.flatten("all.ids").alias("ids"))
    )
    lost = joined.filter("lost and k = 0").select("key", F.lit(None).cast("array<int>").alias("ids"))
    return done.unionByName(lost)


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    into: str = "bpe",
    with_ids: bool = True,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """`docs` with a struct column `into`: `n_tokens, ids_sha256, decoded_sha256` and `ids`.

    Every row of `docs` stays, with all its columns but one named `into`, which is replaced; a null text is encoded as an empty one: no
    tokens. The digests are of the ids in decimal, joined by commas, and of the bytes that
    decoding gives back, which are the UTF-8 bytes of the text. Special tokens are ordinary text.
    Equal long texts are encoded once. An empty table gives an empty result.
    """
    codec = Codec(docs.sparkSession, ranks_path, pattern)
    is_long = F.coalesce(F.length(text), F.lit(0)) > chunk
    whole = _whole_udf(codec, with_ids)
    short = docs.filter(~is_long).withColumn(into, whole(F.col(text)))
    key = free_name(docs, "_text_key")
    keyed = docs.filter(is_long).withColumn(key, F.sha2(F.col(text), 256))
    texts = keyed.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = texts.groupBy("key").agg(F.first("text").alias("text"))
    stitched = _encode_long(texts, codec, chunk, overlap)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    made = materialize(
        stitched.withColumn("d", _digest_udf(codec)(F.coalesce("ids", F.array())))
        .select("*", "d.*")
        .select(F.col("key").alias(key), F.col("ids").isNull().alias("lost"), *names),
        "bpe-long",
    )
    found = made.filter("not lost").select(key, F.struct(*names).alias(into))
    columns = [*[c for c in docs.columns if c.lower() != into.lower()], into]
    out = short.select(columns).unionByName(keyed.drop(into).join(found, key).select(columns))
    lost = made.filter("lost").select(key)
    if lost.limit(1).count():
        at_once = keyed.join(lost, key, "left_semi").withColumn(into, whole(F.col(text)))
        out = out.unionByName(at_once.select(columns))
    return out
