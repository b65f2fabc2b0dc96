"""Byte-pair encoding and decoding of whole text columns.

Encoding is by the backtracking encoder, decoding by an offset table; both equal the
tokenizers library on the same file. Ids are packed as little-endian unsigned 32-bit
integers, so their digests need no further step.
Cases: a null or empty text, or one of white space only, has no ids and decodes to the
empty text; special tokens in a text become their ids; texts of any length are encoded
whole, with a bounded table of known words per worker; null ids decode to the empty
text; repeated rows are encoded one by one; other columns never leave the JVM, and a
column of the result's name is replaced; empty tables stay empty.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.backtracking import WordVocabulary
from tremorlake.llm.chunks import blocks, joined_ids
from tremorlake.llm.worker import held


def word_vocabulary() -> str:
    """Path of the public vocabulary; it is the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _vocabulary(path: str) -> WordVocabulary:
    return held(("word vocabulary", path), lambda: WordVocabulary(path))


def encoded(text: str | Column, path: str) -> Column:
    """Packed ids of a text column."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(path)
        parts = [joined_ids(block, vocabulary.encode_all) for _, block in blocks(texts)]
        return pa.concat_arrays(parts or [pa.array([], pa.large_binary())]).cast(pa.binary())

    return encode(text)


def decoded(ids: str | Column, path: str) -> Column:
    """Text of packed ids: the tokens with a space between."""

    @F.arrow_udf("string")
    def decode(packed: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(path)
        return pa.array([vocabulary.decode(p.as_py() or b"") for p in packed], pa.string())

    return decode(ids)


def unpacked(ids: str | Column) -> Column:
    """Packed ids as an array of whole numbers."""

    @F.arrow_udf("array<bigint>")
    def unpack(packed: pa.Array) -> pa.Array:
        import numpy as np

        rows = [np.frombuffer(p.as_py() or b"", np.uint32).astype(np.int64) for p in packed]
        return pa.array(rows, pa.list_(pa.int64()))

    return unpack(ids)


def encode_texts(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    return docs.withColumn(ids, encoded(F.col(f"`{text}`"), path or word_vocabulary()))


def decode_ids(docs: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    return docs.withColumn(text, decoded(F.col(f"`{ids}`"), path or word_vocabulary()))


def digests(docs: DataFrame, *more: str) -> DataFrame:
    """Per document: the number of tokens, and digests of its ids and of the decoded text."""
    both = decode_ids(encode_texts(docs.select("doc_id", "text", *more)))
    return both.select(
        "doc_id",
        *more,
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_bpe(spark, sf_dir):
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
