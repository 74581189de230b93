"""Landed pages to candidates, for any source of the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..functions.html import anchors
from ..operators import caps, dedup
from ..session import materialize
from ..sources.specs import LinkRule, SourceSpec, keep_and_shape, resolve, route_allowed


def links(pages: DataFrame, rule: LinkRule, spec: SourceSpec | None = None) -> DataFrame:
    """(page_url, page_seq, seq, url) of the anchors that a rule keeps, first of each url by page if the rule is distinct.

    pages: page_url, page_seq, html. Null pages have no links.
    """
    found = anchors(pages.select("page_url", "page_seq", "html"), keep=["page_url", "page_seq"], scope=[list(c) for c in spec.scope] if spec and spec.scope else None, json_in=spec.json_in if spec else None)
    place = ["page_url", "page_seq", "seq"]
    resolved = urls.once(found, [*place, "text", "title", "aria_label"], href=F.trim("href"), url=resolve(rule, F.col("page_url"), F.trim("href")))
    keep, url = keep_and_shape(rule, base=F.col("page_url"), href=F.col("href"), url=F.col("url"), text=F.col("text"), title=F.col("title"), aria_label=F.col("aria_label"))
    if rule.query == "routes":
        keep = keep & route_allowed(urls.query(F.col("url")))
    rows = urls.once(resolved, place, url=url, keep=keep).where("keep AND url <> ''").drop("keep")
    return dedup.keep_first(rows, ["page_url", "page_seq", "url"], "seq") if rule.distinct else rows


def discover(listings: DataFrame, details: DataFrame | None, spec: SourceSpec, *, discovered_at: Column, min_year: int | None = None, policy: str | None = None) -> DataFrame:
    """Candidates of a source from its landed listing and detail pages, in order of discovery, within its caps.

    listings and details: page_url, page_seq, html. Columns: seq, url, kind,
    metadata (source, listing_url, detail_url, discovered_at, origin,
    extracted_year). A url counts once; listing files come before detail files.
    """
    parts = []
    if spec.listing_pdf:
        own = links(listings, spec.listing_pdf, spec)
        parts.append(own.select(F.struct(F.lit(0).alias("stage"), F.col("page_seq"), F.lit(0).cast("long").alias("detail_seq"), F.col("seq").alias("place")).alias("seq"), "url", F.col("page_url").alias("listing_url"), F.lit(None).cast("string").alias("detail_url"), F.lit(spec.listing_origin).alias("origin")))
    if spec.detail and details is not None:
        found = dedup.keep_first(links(listings, spec.detail, spec).withColumn("order", F.struct("page_seq", "seq")), ["url"], "order")
        wanted = caps.cap(found, spec.detail_cap, "order").select(F.col("url").alias("detail"), F.col("page_url").alias("listing_url"), "order")
        files = links(details, spec.detail_pdf).join(wanted, F.col("page_url") == F.col("detail"))
        parts.append(files.select(F.struct(F.lit(1).alias("stage"), F.col("order.page_seq").alias("page_seq"), F.col("order.seq").cast("long").alias("detail_seq"), F.col("seq").alias("place")).alias("seq"), "url", "listing_url", F.col("detail").alias("detail_url"), F.when(urls.looks_like_pdf(F.col("url")), spec.listing_origin).otherwise(spec.detail_origin).alias("origin")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if spec.min_year and min_year is not None:
        rows = rows.where(urls.passes_min_year(F.col("url"), min_year))
    used = policy or spec.policy
    if used and spec.policy:
        rows = rows.where(text.is_likely_notice(urls.filename(F.col("url")), F.col("url"), used))
    first = dedup.keep_first(rows, ["url"], "seq")
    if spec.cap_by_page and spec.candidate_cap is not None:
        # pages are few: a capped source has at most detail_cap of them beside its listings
        capped = caps.cap_by_page(first.withColumn("__p", F.coalesce("detail_url", "listing_url")).withColumn("__one", F.lit(1)), spec.candidate_cap, "__p", ["__one"]).drop("__p", "__one")
    else:
        capped = caps.cap(first, spec.candidate_cap, "seq")
    return capped.select(
        "seq",
        "url",
        F.lit("pdf").alias("kind"),
        F.struct(F.lit(spec.name).alias("source"), "listing_url", "detail_url", discovered_at.alias("discovered_at"), "origin", F.coalesce(urls.year(F.col("url")), urls.year(F.col("detail_url"))).alias("extracted_year")).alias("metadata"),
    )


# ---------------------------------------------------------------- pages inside JSON

# Where a keyword's scan ends.
KEYWORD_PAGES, KEYWORD_FAILURES, KEYWORD_STALE = 200, 3, 5


def wrapped_links(payloads: DataFrame, rule: LinkRule, spec: SourceSpec | None = None, *, path: str = "$.body") -> DataFrame:
    """(page_url, page_seq, seq, url) of the anchors in HTML that comes as a field of JSON payloads (page_url, page_seq, payload).

    A payload that is null, no JSON or without the field has no links and is no error.
    """
    return links(payloads.select("page_url", "page_seq", F.get_json_object("payload", path).alias("html")), rule, spec)


def merged_details(listing: DataFrame, wrapped: DataFrame) -> DataFrame:
    """The links of static listings, then those of wrapped pages, each url once at its first place: (url, seq) with seq a struct."""
    ordered = [x.select("url", F.struct(F.lit(k).alias("part"), "page_seq", F.col("seq").alias("place")).alias("seq")) for k, x in enumerate((listing, wrapped))]
    return dedup.keep_first(ordered[0].unionByName(ordered[1]), ["url"], "seq")


def keyword_details(pages: DataFrame, rule: LinkRule, spec: SourceSpec | None = None) -> DataFrame:
    """(keyword_no, page, seq, url) of the detail links that scans by keyword find, each url where it is first seen.

    pages: keyword_no, page (from 1), page_url, payload (JSON with the HTML in
    its body; null if every attempt failed). Keywords are scanned in order; a
    scan ends after KEYWORD_PAGES pages, at the third failed page in a row, at a
    page without links, or at the fifth page in a row (failed ones left out)
    that has only links already seen, be it under an earlier keyword. Links of
    pages beyond the end are not seen. Keywords are a handful of parameters, so
    they are taken one by one; each one's pages are judged in one pass.
    """
    capped = pages.where(F.col("page").between(1, KEYWORD_PAGES))
    body = F.coalesce(F.get_json_object("payload", "$.body"), F.lit(""))
    html = capped.where("payload IS NOT NULL").select("page_url", "keyword_no", "page", body.alias("html"))
    numbered = html.select("page_url", (F.col("keyword_no") * (KEYWORD_PAGES + 1) + F.col("page")).alias("page_seq"), "html")
    found = links(numbered, rule, spec).select(F.floor(F.col("page_seq") / (KEYWORD_PAGES + 1)).cast("int").alias("keyword_no"), (F.col("page_seq") % (KEYWORD_PAGES + 1)).cast("int").alias("page"), "seq", "url")
    found = materialize(found, "keyword-links")
    state = materialize(capped.select(F.col("keyword_no").cast("int").alias("keyword_no"), F.col("page").cast("int").alias("page"), F.col("payload").isNull().alias("failed")), "keyword-pages")
    result = found.limit(0)
    for k in [r.keyword_no for r in state.select("keyword_no").distinct().orderBy("keyword_no").collect()]:
        own, mine = state.where(F.col("keyword_no") == k), found.where(F.col("keyword_no") == k)
        fresh = dedup.keep_first(mine.withColumn("order", F.struct("page", "seq")), ["url"], "order").drop("order").join(result.select("url"), "url", "left_anti")
        counts = own.join(mine.groupBy("page").agg(F.count("*").alias("links")), "page", "left").join(fresh.groupBy("page").agg(F.count("*").alias("new")), "page", "left").na.fill(0, ["links", "new"])
        counts = materialize(counts, "keyword-counts")
        kept = caps.stop_after_streak(counts, KEYWORD_FAILURES, F.col("failed"), "page", []).drop("streak")
        good = caps.stop_after_streak(counts.where("NOT failed"), KEYWORD_STALE, F.col("new") == 0, "page", []).drop("streak")
        ends = counts.where("NOT failed AND links = 0").agg(F.min("page").alias("stop")).first().stop
        visited = kept.join(good.select("page"), "page", "left_semi").where(F.lit(True) if ends is None else F.col("page") < ends).select("page")
        result = materialize(result.unionByName(fresh.join(visited, "page", "left_semi").select(*result.columns)), "keyword-found")
    return result
