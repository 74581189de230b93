"""PDF bytes to markdown: waste pages dropped, embedded text first, recognition where there is none.

No PDF library is assumed: a reader and a recogniser are passed in, and called
once per task where they hold a model.
"""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass


class PdfError(ValueError):
    """A PDF that can't be read, optimised or recognised."""


@dataclass(frozen=True)
class Page:
    """A page as a reader gives it: whether it has a content stream, its embedded text, and whatever the reader needs to write it again."""

    has_content: bool
    text: str = ""
    handle: object = None


@dataclass(frozen=True)
class Reader:
    """read: bytes to pages, raising on a broken file. write: pages to bytes; None if the reader can't write, which keeps the bytes as they are."""

    read: Callable[[bytes], list[Page]]
    write: Callable[[list[Page]], bytes] | None = None


def is_blank(page: Page, least_text: int = 0) -> bool:
    """A page without a content stream is blank; with least_text, so is one whose stripped text is shorter."""
    return not page.has_content or (least_text > 0 and len(page.text.strip()) < least_text)


def kept_pages(pages: list[Page], *, most: int | None = None, drop_blank: bool = True, least_text: int = 0) -> list[Page]:
    """The pages that aren't blank, the first `most` of them. No page at all, or only blank ones, is an error."""
    if not pages:
        raise PdfError("the PDF has no pages")
    kept = [p for p in pages if not (drop_blank and is_blank(p, least_text))]
    if not kept:
        raise PdfError("all pages are blank")
    return kept[:most] if most and most > 0 else kept


def optimised(data: bytes, reader: Reader, **rules: object) -> bytes:
    """The PDF with its kept pages only."""
    if not data:
        raise PdfError("the PDF is empty")
    try:
        pages = reader.read(data)
    except Exception as e:  # noqa: BLE001
        raise PdfError(f"unreadable: {e}") from e
    kept = kept_pages(pages, **rules)
    return reader.write(kept) if reader.write else data


def embedded_text(data: bytes, reader: Reader) -> str | None:
    """The embedded texts of the pages that have any, numbered as they come, from the second on under page comments; None without any or for a broken file."""
    if not data:
        return None
    try:
        texts = [t for p in reader.read(data) if (t := p.text.strip())]
    except Exception:  # noqa: BLE001
        return None
    return "\n\n".join(t if i == 1 else f"<!-- Página {i} -->\n\n{t}" for i, t in enumerate(texts, 1)) or None


def markdown_extractor(reader: Reader, recognise: Callable[[bytes], str], *, seconds: float = 300, **rules: object) -> Callable[[bytes], str]:
    """The function from PDF bytes to markdown: optimise (the bytes stay as they are if that fails), embedded text, else recognition.

    Recognition that takes longer than `seconds`, or gives no text, is an error.
    """

    def extract(data: bytes) -> str:
        try:
            data = optimised(data, reader, **rules)
        except PdfError:
            pass
        if text := embedded_text(data, reader):
            return text
        if not data:
            raise PdfError("the PDF is empty")
        pool = ThreadPoolExecutor(1)
        try:
            text = pool.submit(recognise, data).result(timeout=seconds)
        finally:
            pool.shutdown(wait=False, cancel_futures=True)
        if not text or not text.strip():
            raise PdfError("recognition gave no text")
        return text

    return extract


def mime_type(data: bytes) -> str | None:
    """The type by libmagic where Python has it, else application/pdf for a PDF header and None for anything else."""
    try:
        return importlib.import_module("magic").from_buffer(data, mime=True)
    except ImportError:
        return "application/pdf" if data.startswith(b"%PDF") else None
    except Exception:  # noqa: BLE001
        return None


def validate(data: bytes | None, *, most: int) -> str | None:
    """None for a valid PDF of at most `most` bytes, else what is wrong with it."""
    if not data:
        return "empty"
    if len(data) > most:
        return "too large"
    if mime_type(data) != "application/pdf":
        return "not a PDF"
    return None if data.startswith(b"%PDF") else "no PDF header"


@dataclass(frozen=True)
class ExtractionSettings:
    """Settings of recognition, with the names of their environment variables."""

    language: str = "latin"
    tier: str = "tiny"
    gpu: bool = False
    force: bool = False
    seconds: int = 300

    @classmethod
    def from_env(cls, prefix: str = "OCR_") -> ExtractionSettings:
        """Each field from PREFIX + its name in capitals; unset ones keep their defaults."""
        base = cls()
        kinds = {bool: lambda v: v.lower() == "true", int: int, str: str}
        return cls(**{n: kinds[type(d)](v) for n, d in vars(base).items() if (v := os.environ.get(prefix + n.upper())) is not None})


def extractor_factory(reader: Callable[[], Reader], recogniser: Callable[[ExtractionSettings], Callable[[bytes], str]], settings: ExtractionSettings | None = None) -> Callable[[], Callable[[bytes], str]]:
    """What `process.process` calls once per task: reader and recogniser are made there, so a model is loaded once."""
    chosen = settings or ExtractionSettings.from_env()
    return lambda: markdown_extractor(reader(), recogniser(chosen), seconds=chosen.seconds)
