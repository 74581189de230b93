"""Shared pieces of the text operators: work tables, shingles and column picking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir  # noqa: F401

WORD = regex.compile(r"[^\W_]+")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names.

    Every operator starts with this, so extra input columns, whatever they are
    called, can't clash with the operator's working columns.
    """
    return df.select(*[df[f"`{source}`" if source in df.columns else source].alias(name) for name, source in columns.items()])


def same(a: str, b: str) -> Column:
    return F.col(a) == F.col(b)


class WordHashes(dict):
    """64-bit hashes of words, each computed once per task; emptied when it grows large."""

    LIMIT = 2_000_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15) + y
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], n: int, hashes: WordHashes) -> list[np.ndarray]:
    """For each text the distinct 64-bit hashes of its runs of n words, in the order of signed numbers, as SQL sorts them.

    Words are the longest runs of letters and digits of the lower-cased text.
    A text of fewer than n words has the empty set.
    """
    words = [WORD.findall(t.lower()) for t in texts]
    flat = np.fromiter((hashes[w] for ws in words for w in ws), dtype=np.uint64, count=sum(map(len, words)))
    if len(flat) < n:
        return [np.empty(0, np.uint64)] * len(texts)
    runs = flat[: len(flat) - n + 1]
    for k in range(1, n):
        runs = mix(runs, flat[k : len(flat) - n + 1 + k])
    sets, at = [], 0
    for ws in words:
        sets.append(_distinct(runs[at : at + len(ws) - n + 1]) if len(ws) >= n else runs[:0])
        at += len(ws)
    return sets


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values.view(np.int64)).view(np.uint64)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def rows_to_batch(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most so many rows, to bound memory on long texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def list_array(arrays: list[np.ndarray]) -> pa.Array:
    """An Arrow list<int64> of 64-bit arrays without a Python object per value."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def distinct_texts(df: DataFrame) -> DataFrame:
    """(text): each text of a column `text` once. Only texts that occur again are shuffled; the others stay where they are."""
    keyed = df.select("text", F.xxhash64("text").alias("digest"))
    again = materialize(keyed.groupBy("digest").agg(F.count("*").alias("rows")).where("rows > 1").select("digest"), "copies")
    if not again.head(1):
        return keyed.select("text")
    return keyed.join(again, "digest", "left_anti").unionByName(keyed.join(again, "digest", "left_semi").dropDuplicates(["text"])).select("text")
