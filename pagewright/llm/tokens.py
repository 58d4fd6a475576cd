"""Sizes of documents in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the tokenizer's vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer of a file of base64 pieces and ranks, or of the copy that was sent to the executors; loaded once per
    Python worker."""
    import tiktoken
    from pyspark import SparkFiles

    with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as pieces:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, pieces)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, keys: dict[str, str], path: str = TOKENIZER) -> DataFrame:
    """`keys` (name to type) and n_tokens of each document's whole text; a null text has none. `path` is the
    tokenizer's file on the driver, which is sent to the executors."""
    documents.sparkSession.sparkContext.addFile(path)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in source:
            sizes = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(sizes, pa.int64())], names=[*keys, "n_tokens"])

    return documents.select(*keys, "text").mapInArrow(batches, ", ".join(f"`{k}` {t}" for k, t in keys.items()) + ", n_tokens long")
