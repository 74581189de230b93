"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, pick

# Where the vocabulary files lie; another folder or file can be given to every operator.
TOKENIZER = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str):  # noqa: ANN201
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, *, id_col: str, text_col: str, more: dict[str, str] | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, tokens, columns of `more`): whole texts are counted; null and empty texts have 0 tokens. Rows of null id are left out.

    The vocabulary is read from its file once per task.
    """
    more = more or {}
    src = pick(df, text=text_col, id=id_col, **more).where("id IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:]) + ", tokens long"
    names = [*src.columns[1:], "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        for b in chunks(batches, 1000):
            sizes = [len(encode(t)) if t else 0 for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(sizes, pa.int64())], names=names)

    return src.mapInArrow(run, schema)
