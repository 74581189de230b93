"""Downloaded contents to results: validation, archives, hashes, text. Errors are data, never exceptions."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 15_000_000
# Results leave a task in batches of about so many bytes of text.
BATCH_BYTES = 32_000_000
MAX_ROWS = 256


def is_pdf(content: Column, max_bytes: int = MAX_BYTES) -> Column:
    """Starts with %PDF and has 1 to max_bytes bytes."""
    return F.coalesce(F.octet_length(content).between(1, max_bytes) & F.startswith(content, F.lit(b"%PDF")), F.lit(False))


def pdf_of(data: bytes, max_bytes: int = MAX_BYTES) -> bytes | None:
    """The data if it is a PDF, or the first PDF in a ZIP archive by the archive's order, within size; None otherwise."""
    if data[:2] == b"PK":
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for info in z.infolist():
                    if info.filename.lower().endswith(".pdf") and 0 < info.file_size <= max_bytes:
                        inner = z.read(info)
                        if inner.startswith(b"%PDF"):
                            return inner
        except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError):
            return None
        return None
    return data if data.startswith(b"%PDF") and 0 < len(data) <= max_bytes else None


def process(downloads: DataFrame, extractor: Callable[[], Callable[[bytes], str]], *, max_bytes: int = MAX_BYTES, validated_at: datetime | None = None) -> DataFrame:
    """url, worker_result (null on failure), error (null on success) for rows of url, content, error.

    extractor is called once per task and returns the function from PDF bytes to
    markdown, so a model is loaded once. Rows that already carry an error keep it.
    """
    at = (validated_at or datetime.now(timezone.utc)).isoformat()
    result = pa.struct([("ocr_markdown", pa.string()), ("content_hash", pa.string()), ("content_length", pa.int64()), ("validated_at", pa.string()), ("validation_outcome", pa.string())])

    def one(extract: Callable[[bytes], str], content: bytes | None, error: str | None) -> tuple[dict | None, str | None]:
        if error:
            return None, error if error.startswith("download:") else f"download: {error}"
        if not content:
            return None, "download: empty body"
        pdf = pdf_of(content, max_bytes)
        if pdf is None:
            return None, "download: not a valid pdf"
        try:
            markdown = extract(pdf)
        except Exception as e:  # noqa: BLE001
            return None, f"ocr: {type(e).__name__}: {e}"
        return {"ocr_markdown": markdown, "content_hash": hashlib.sha256(pdf).hexdigest(), "content_length": len(pdf), "validated_at": at, "validation_outcome": "valid_pdf"}, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = extractor()
        rows: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), result, pa.string()))], names=["url", "worker_result", "error"])
            rows.clear()
            return batch

        for b in batches:
            for url, content, failed in zip(*(b.column(k) for k in range(3))):
                done, error = one(extract, content.as_py(), failed.as_py())
                rows.append((url.as_py(), done, error))
                size += len(done["ocr_markdown"]) if done else 0
                if size >= BATCH_BYTES or len(rows) >= MAX_ROWS:
                    yield out()
                    size = 0
        yield out()

    schema = "url string, worker_result struct<ocr_markdown: string, content_hash: string, content_length: long, validated_at: string, validation_outcome: string>, error string"
    return downloads.select("url", "content", "error").mapInArrow(run, schema)
