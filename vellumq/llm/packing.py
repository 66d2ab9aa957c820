"""Packing by power-of-two decomposition.

A document's tokens, with the end token, are cut into pieces whose lengths are powers of two:
as many of the full length as fit, then the binary digits of the rest, largest first. A piece is
a sequence by itself and sits in the bucket of its length, so no sequence crosses documents and
none is padded. Cutting needs nothing but the document: rows stream through the tasks, nothing
is shuffled, and a hot source or a very long text costs no more than its length.

Defined results: a null or empty text is the end token alone, one piece of length 1; repeated rows
are packed each for itself; a null doc_id stays null; an empty table gives no pieces; extra columns
aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared, words

PIECES = "doc_id bigint, start bigint, length int, doc_tokens bigint, ids binary"

#: Texts of these characters are split alike by both tokenizer libraries (tests compare all of them).
_BEYOND = re.compile("[^\x00-ɏ]")


@lru_cache(maxsize=4)
def encoder(vocabulary: str, ranks: str | None):
    """Text -> array of unsigned 32-bit ids, as the library tokenizers gives them for the vocabulary file.

    ranks names the same vocabulary as a rank file: the library tiktoken then gives the same ids in a
    quarter of the time. Texts that may be split otherwise there (characters beyond Latin, the strings of
    special tokens) go to tokenizers.
    """
    import base64

    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]

    def slow(text: str) -> np.ndarray:
        return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")

    if not ranks:
        return slow
    import tiktoken

    with open(ranks, "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not text.isascii() and _BEYOND.search(text) or any(s in text for s in special):
            return slow(text)
        return fast.encode_to_numpy(text).astype("<u4", copy=False)

    return encode


def cuts(n: int, full: int) -> list[int]:
    """Lengths of the pieces of n tokens: full ones, then the binary digits of the rest."""
    rest = n % full
    return [full] * (n // full) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(documents: DataFrame, vocabulary: str, ranks: str | None = None, full: int = 1024, end: int = 0) -> DataFrame:
    """Pieces of documents(doc_id, text): doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, bucket.

    full: a power of two, the longest sequence. end: the id after each document.
    """
    if full < 1 or full & full - 1:
        raise ValueError("full must be a power of two")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for part in words.pieces(batches, "text"):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text) if text else np.zeros(0, "<u4"), np.array([end], "<u4"))
                data, at = ids.tobytes(), 0
                for n in cuts(len(ids), full):
                    for x, y in zip(rows, (doc_id, at, n, len(ids), data[4 * at : 4 * (at + n)]), strict=True):
                        x.append(y)
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    pieces = documents.select("doc_id", "text").mapInArrow(cut, PIECES)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("bucket", F.col("length"))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum for their ids, and their bucket."""
    return pieces.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"), F.col("bucket").cast("long").alias("bucket"))


def bucketed(pieces: DataFrame, path: str) -> None:
    """Writes the pieces so that equal lengths lie together: a folder for each bucket."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(path)


def buckets(pieces: DataFrame) -> DataFrame:
    """bucket, sequences, tokens of each length: partial counts, at most a row for each power of two."""
    return pieces.groupBy("bucket").agg(F.count("*").alias("sequences"), F.sum("length").alias("tokens"))


def pack_documents(documents: DataFrame) -> DataFrame:
    return pack(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """All whole documents in sequences of 1024 byte-level BPE tokens or a lesser power of two. Odd rows as in the module's text."""
    return digests(pack_documents(shared.table(spark, sf_dir, "documents")))
