"""Failure texts and status codes as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status codes by meaning.
BLOCKING = [401, 403, 429]
EXPECTED = [400, 401, 403, 404, 408, 410, 413, 414, 415, 429, 500, 502, 503, 504]
RETRYABLE = [408, 425, 429, 500, 502, 503, 504]
PERMANENT = [404, 410, 422]
EXPECTED_CLASSES = ["ConnectionError", "Timeout", "TooManyRedirects"]

_STATUS = r"(?i)\bHTTP\s+(\d{3})\b|\b(\d{3})\s+(?:Client|Server)\s+Error\b|\bstatus\s+code\s+(\d{3})\b"


def status_code(error: Column) -> Column:
    """The status code that an error text names; null if none."""
    found = [F.nullif(F.regexp_extract(error, _STATUS, k), F.lit("")) for k in (1, 2, 3)]
    return F.coalesce(*found).cast("int")


def is_blocking(code: Column) -> Column:
    return F.coalesce(code.isin(BLOCKING), F.lit(False))


def is_retryable(code: Column, *, any_server_error: bool = False) -> Column:
    hit = code.isin(RETRYABLE)
    return F.coalesce(hit | (code >= 500) if any_server_error else hit, F.lit(False))


def is_expected_failure(error: Column, error_class: Column | None = None) -> Column:
    """A failure that sources show now and then: a known status, else a known class of error."""
    code = status_code(error)
    by_class = error_class.isin(EXPECTED_CLASSES) if error_class is not None else F.lit(False)
    return F.coalesce(F.when(code.isNotNull(), code.isin(EXPECTED)).otherwise(by_class), F.lit(False))


def severity(error: Column, error_class: Column | None = None) -> Column:
    return F.when(error.isNull(), None).when(is_expected_failure(error, error_class), "warning").otherwise("error")


def error_kind(error: Column) -> Column:
    """download_error, invalid_pdf or extraction_error; null without an error."""
    return (
        F.when(error.isNull() | (error == ""), None)
        .when(F.lower(error).rlike("^download"), "download_error")
        .when(F.lower(error).rlike("invalid|not a pdf|%pdf|empty|too large"), "invalid_pdf")
        .otherwise("extraction_error")
    )


def diagnostic(source: Column, url: Column, reason: Column, code: Column | None = None) -> Column:
    """struct<source, url, kind, reason, status_code>; the code may be null."""
    return F.struct(source.alias("source"), url.alias("url"), F.lit("diagnostic").alias("kind"), reason.alias("reason"), (code if code is not None else F.lit(None)).cast("int").alias("status_code"))
