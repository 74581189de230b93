"""Landed payloads: page envelopes, backfill claims, checkpoints."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import caps
from ..session import read_text, replace_text

PAGE_LIMIT = 20


def records_of_pages(pages: DataFrame, *, query: list[str], page: str = "page", data: str = "data", total: str = "total_pages", failed: str | None = None, limit: int = PAGE_LIMIT) -> DataFrame:
    """The records of landed pages, one row each, with pos in the page.

    Of every query's pages those up to the limit and to the total that a page
    states count; a failed page ends its query, earlier pages stay. Null data has
    no records, null records are dropped. A missing or unreadable total ends the
    query at its page.
    """
    kept = caps.page_cap(pages, page, limit)
    keys = [*query]
    if failed:
        kept = caps.stop_after_streak(kept, 1, F.col(failed), page, keys).where(~F.coalesce(F.col(failed), F.lit(False)))
    last = kept.where((F.coalesce(F.col(total).try_cast("int"), F.lit(0)) <= F.col(page))).groupBy(*keys).agg(F.min(page).alias("__last"))
    kept = kept.join(last, keys, "left").where(F.col("__last").isNull() | (F.col(page) <= F.col("__last"))).drop("__last")
    return kept.select(*keys, page, F.posexplode(data).alias("pos", "record")).where("record IS NOT NULL")


def claimed(claims: DataFrame, *, url: str = "url", kind: str = "kind", metadata: str = "candidate_metadata") -> DataFrame:
    """Claims with a usable url; kind defaults to pdf, metadata to {}; metadata that isn't a JSON object becomes {} and is marked."""
    parsed = F.try_parse_json(F.col(metadata)) if hasattr(F, "try_parse_json") else None
    good = F.schema_of_variant(parsed).startswith("OBJECT") if parsed is not None else F.get_json_object(metadata, "$").startswith("{")
    ok = F.coalesce(good, F.lit(False))
    return (
        claims.where(F.trim(F.coalesce(F.col(url), F.lit(""))) != "")
        .withColumn("metadata_ok", F.col(metadata).isNull() | ok)
        .withColumn(kind, F.coalesce(kind, F.lit("pdf")))
        .withColumn(metadata, F.when(ok, F.col(metadata)).otherwise("{}"))
    )


def load_checkpoint(path: str) -> datetime | None:
    """The stored instant; None for a missing, broken or odd file. A path with a scheme is read through the active session."""
    try:
        text = read_text(SparkSession.active(), path) if "://" in path else Path(path).read_text()
        at = datetime.fromisoformat(json.loads(text or "")["last_successful_update"])
    except (OSError, ValueError, KeyError, TypeError):
        return None
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def save_checkpoint(path: str, at: datetime) -> None:
    """Written beside and moved into place. On a cluster the path has a scheme and lies in a shared folder; a plain one is the driver's disk."""
    text = json.dumps({"last_successful_update": at.astimezone(timezone.utc).isoformat()})
    if "://" in path:
        return replace_text(SparkSession.active(), path, text)
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "w") as f:
        f.write(text)
    os.replace(name, target)
