"""Anchors of HTML pages. Parsing is the one step that Spark has no expression for; it runs Arrow-batched over the standard parser."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset(("script", "style"))
ANCHOR = "seq int, href string, text string, title string, aria_label string"


class Anchors(HTMLParser):
    """Anchors in document order: href, stripped text of all descendants joined by blanks, title, aria-label.

    With `scope`, a list of id chains such as [["content", "body"], ["content"]],
    only anchors inside the first chain that occurs are kept; none if none does.
    With `json_in`, (class, attribute), JSON arrays in such elements are collected.
    """

    def __init__(self, json_in: tuple[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.stack: list[tuple[str, str]] = []
        self.open: list[tuple[int, dict]] = []
        self.json_in = json_in
        self.json_texts: list[str] = []
        self.json_open: list[int] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in reversed(attrs)}
        if tag == "a":
            self._close("a")
            anchor = {"href": a.get("href"), "parts": [], "title": a.get("title"), "aria_label": a.get("aria-label"), "ids": [i for _, i in self.stack if i] + ([a["id"]] if a.get("id") else [])}
            self.found.append(anchor)
            self.open.append((len(self.stack), anchor))
        if self.json_in and self.json_in[0] in a.get("class", "").split():
            if a.get(self.json_in[1]):
                self.json_texts.append(a[self.json_in[1]])
            else:
                self.json_open.append(len(self.stack))
                self.json_texts.append("")
        if tag not in _VOID:
            self.stack.append((tag, a.get("id", "")))

    def _close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                self.open = [o for o in self.open if o[0] < i]
                self.json_open = [o for o in self.json_open if o < i]
                return

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] in _RAW:
            return
        if self.json_open:
            self.json_texts[-1] += data
        text = data.strip()
        if text:
            for _, anchor in self.open:
                anchor["parts"].append(text)


def _in_chain(ids: list[str], chain: list[str]) -> bool:
    it = iter(ids)
    return all(any(x == wanted for x in it) for wanted in chain)


def parse_anchors(html: str | None, scope: list[list[str]] | None = None, json_in: tuple[str, str] | None = None) -> list[dict]:
    """The anchors of a page; those of JSON items (link, title, description) follow the others. Malformed markup and JSON never fail."""
    if not html:
        return []
    parser = Anchors(json_in)
    parser.feed(html)
    parser.close()
    found = parser.found
    if scope:
        present = _ids(html)
        chain = next((c for c in scope if all(i in present for i in c) and (any(_in_chain(x["ids"], c) for x in found) or len(c) == 1)), None)
        found = [x for x in found if chain and _in_chain(x["ids"], chain)]
    rows = [{"seq": i, "href": x["href"], "text": " ".join(x["parts"]), "title": x["title"], "aria_label": x["aria_label"]} for i, x in enumerate(found) if x["href"]]
    for text in parser.json_texts:
        try:
            items = json.loads(text)
        except ValueError:
            continue
        for item in items if isinstance(items, list) else []:
            if isinstance(item, dict) and isinstance(item.get("link"), str) and item["link"]:
                rows.append({"seq": len(rows), "href": item["link"], "text": str(item.get("title") or ""), "title": str(item.get("description") or ""), "aria_label": None})
    return [r | {"seq": i} for i, r in enumerate(rows)]


def _ids(html: str) -> set[str]:
    class Ids(HTMLParser):
        seen: set[str] = set()

        def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
            self.seen.update(v for k, v in attrs if k == "id" and v)

    parser = Ids()
    parser.seen = set()
    parser.feed(html)
    return parser.seen


def anchors(pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None, scope: list[list[str]] | None = None, json_in: tuple[str, str] | None = None) -> DataFrame:
    """One row per anchor with an href: the `keep` columns of its page, seq, href, text, title, aria_label. Null pages have none."""
    keep = [c for c in pages.columns if c != html_col] if keep is None else keep
    src = pages.select(*[pages[f"`{c}`"] for c in keep], pages[f"`{html_col}`"].alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, origin = [], []
            for i, page in enumerate(b.column(b.num_columns - 1).to_pylist()):
                found = parse_anchors(page, scope, json_in)
                rows += found
                origin += [i] * len(found)
            kept = [b.column(k).take(pa.array(origin, pa.int64())) for k in range(b.num_columns - 1)]
            types = {"seq": pa.int32(), "href": pa.string(), "text": pa.string(), "title": pa.string(), "aria_label": pa.string()}
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([r[n] for r in rows], t) for n, t in types.items())], names=[*keep, *types])

    return src.mapInArrow(run, f"{schema}, {ANCHOR}" if schema else ANCHOR)
