"""Pages of text as paged markdown, with native array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"^\s+|\s+$"


def _marked(sections: Column) -> Column:
    """Sections joined by blank lines, from the second on under a page comment with its position."""
    return F.array_join(F.transform(sections, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("<!-- Página "), (i + 1).cast("string"), F.lit(" -->\n\n"), x))), "\n\n")


def _stripped(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, _BLANK, "")), lambda p: p != "")


def from_pages(pages: Column) -> Column:
    """Embedded page texts: blank pages dropped, the others renumbered from 1. Null pages are blank."""
    return _marked(_stripped(F.filter(pages, lambda p: p.isNotNull())))


def with_page_counters(text: Column) -> Column:
    """Page comments for text with `<!-- PAGE n -->` marks, or, without any, with form feeds.

    Marks keep their numbers: empty pages are skipped, page 1 has no comment, a
    page that follows a part of the same number has none either, and text before
    the first mark stays. Form-feed pages are renumbered, blank ones dropped.
    """
    numbers = F.regexp_extract_all(text, F.lit(r"<!-- PAGE (\d+) -->"), F.lit(1))
    parts = F.transform(F.split(text, r"<!-- PAGE \d+ -->"), lambda p: F.regexp_replace(p, _BLANK, ""))
    pages = F.filter(F.arrays_zip(numbers.alias("n"), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).alias("t")), lambda x: x["t"] != "")
    start = F.struct(F.lit(None).cast("string").alias("last"), F.filter(F.array(F.element_at(parts, 1)), lambda p: p != "").alias("out"))
    folded = F.aggregate(
        pages,
        start,
        lambda acc, x: F.struct(
            x["n"].alias("last"),
            F.array_append(acc["out"], F.when((x["n"].cast("int") == 1) | x["n"].eqNullSafe(acc["last"]), x["t"]).otherwise(F.concat(F.lit("<!-- Página "), x["n"].cast("int").cast("string"), F.lit(" -->\n\n"), x["t"]))).alias("out"),
        ),
    )
    fed = _stripped(F.split(text, "\f"))
    return F.when(F.size(numbers) > 0, F.array_join(folded["out"], "\n\n")).otherwise(F.when(F.size(fed) > 0, _marked(fed)).otherwise(F.regexp_replace(text, _BLANK, "")))


def from_recognised(pages: Column) -> Column:
    """Recognised pages, array<struct<page_index int, rec_texts array<string>>>: lines joined, under `<!-- PAGE index+1 -->`; a page without index only if it has text."""
    joined = F.transform(pages, lambda p: F.struct(p["page_index"].alias("i"), F.array_join(F.coalesce(p["rec_texts"], F.array().cast("array<string>")), "\n").alias("t")))
    kept = F.filter(joined, lambda p: p["i"].isNotNull() | (p["t"] != ""))
    return F.array_join(F.transform(kept, lambda p: F.when(p["i"].isNull(), p["t"]).otherwise(F.concat(F.lit("<!-- PAGE "), (p["i"] + 1).cast("string"), F.lit(" -->\n"), p["t"]))), "\n\n")
