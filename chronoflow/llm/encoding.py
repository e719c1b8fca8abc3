"""Encoding a corpus of texts with a public tokenizer, one pass, no shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoflow.llm.bpe import encoder


def default_vocabulary() -> str:
    """Path of the 50k byte-level vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode_texts(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key`` and ``ids`` (array<int>) of each row; an empty list for a null or empty text.

    Rows are kept as they are, repeated ones too; other columns are not read. Whole texts are
    encoded, however long.
    """
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"))

    def run(batches):
        own = encoder(path)
        for batch in batches:
            packed = [own.encode_packed(t) if t else b"" for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) >> 2 for p in packed], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["k", "ids"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, ids array<int>").select(F.col("k").alias(key), "ids")


def count_tokens(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key`` and ``tokens`` (bigint) of each row; 0 for a null or empty text."""
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"))

    def run(batches):
        own = encoder(path)
        for batch in batches:
            sizes = [len(own.encode_packed(t)) >> 2 if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["k", "tokens"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, tokens bigint").select(F.col("k").alias(key), "tokens")


def decode_ids(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """``key`` and ``text`` of each row of ids; a null list gives an empty text."""
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{ids}`").alias("x"))

    def run(batches):
        own = encoder(path)
        for batch in batches:
            texts = [own.decode(x) if x is not None else "" for x in batch.column(1).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["k", "text"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, text string").select(F.col("k").alias(key), "text")
