from datetime import datetime, timedelta, timezone
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from garimpo.functions import dates, markdown, status, text, urls
from garimpo.functions.html import anchors, parse_anchors


def column(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


BASE = "https://www.a.example/x/y/list.html?p=1"
REFS = ["b.pdf", "./b.pdf", "../b.pdf", "../../../b.pdf", "/c/d", "//h.example/z?q", "?k=v", "#f", "", "https://o.example/a b.pdf", "mailto:a@b.example", "d/e/../f/./g?x=1#y", "..", ".", "/a/../b/", "c//d"]


def test_join_as_browsers_do(spark):
    got = column(spark, REFS, "string", lambda x: urls.join(F.lit(BASE), x))
    assert got == [urljoin(BASE, r) for r in REFS]


def test_canonical_and_parts(spark):
    u = ["HTTP://User@WWW.A.example:80/p/q/?b=1#f", "https://a.example", None, "not a url", "https://a.example/x y/z.pdf "]
    assert column(spark, u, "string", urls.host) == ["www.a.example", "a.example", None, "", "a.example"]
    assert column(spark, u, "string", urls.bare_host)[0] == "a.example"
    assert column(spark, u, "string", urls.canonical)[:2] == ["http://User@WWW.A.example:80/p/q?b=1", "https://a.example"]
    assert column(spark, u, "string", urls.filename)[4] == "z.pdf "


def test_year_is_the_greatest_of_exact_runs(spark):
    u = ["https://a.example/2019/edital-2024.pdf", "https://a.example/202307/x", "https://a.example/x?ano=2031", "https://2026.example/x#2025", "https://a.example/1899/3000", None]
    assert column(spark, u, "string", urls.year) == [2024, None, 2031, None, None, None]
    assert column(spark, u, "string", lambda x: urls.passes_min_year(x, 2026)) == [False, True, True, True, True, True]


def test_sanitize_query(spark):
    q = ["utm_source=a&b=2&a=1&FBCLID=x", "", "a=&a=1&b", "x=a%20b&gclid=1", None]
    assert column(spark, q, "string", urls.sanitize_query) == ["a=1&b=2", "", "a=&a=1&b=", "x=a+b", None]


def test_safe_literals(spark):
    u = ["http://10.0.0.1/", "http://8.8.8.8/", "https://localhost/", "ftp://a.example/", "http://x.internal/", "http://[::1]/", "http://[fe80::1]/", "http://[::ffff:10.0.0.1]/", "https://a.example./", "http:///x", None, "http://100.64.1.1", "http://172.32.0.1"]
    assert column(spark, u, "string", urls.is_safe_literal) == [False, True, False, False, False, False, False, False, True, False, False, False, True]


def test_notice_policies(spark):
    names = ["edital.pdf", "Termo de Referencia.pdf", "relatório-final.pdf", "Manual.pdf", None]
    assert column(spark, names, "string", lambda x: text.is_likely_notice(x, F.lit(""))) == [True, False, False, False, True]
    assert column(spark, names, "string", lambda x: text.is_likely_notice(x, F.lit(""), "include_tdr"))[1] is True
    assert column(spark, names, "string", lambda x: text.is_likely_notice(x, F.lit(""), "no_prefilter")) == [True] * 5
    with pytest.raises(ValueError):
        text.is_likely_notice(F.lit("a"), F.lit("b"), "other")


def test_priorities(spark):
    kinds = ["Edital", "Aviso de Contratação Direta", "termo de referencia", "Outros", None]
    assert column(spark, kinds, "string", lambda x: text.document_priority(x, F.lit(None))) == [10, 20, 30, 100, 100]
    assert column(spark, ["a, b,,a , c"], "string", text.split_list) == [["a", "b", "c"]]


def test_dates_in_three_notations(spark):
    values = ["20260625180000", "2026-06-25T18:00:00", "2026-06-25T18:00:00Z", "2026-06-25T18:00:00-05:00", "20260625", "2026-06-25", "2026-13-40", "", " 20260625180000 ", None, "20261325180000", "2026-06-25 18:00"]
    base = datetime(2026, 6, 25, 21)
    want = [base, base, base - timedelta(hours=3), base + timedelta(hours=2), base.replace(hour=3), base.replace(hour=3), None, None, base, None, None, base]
    assert column(spark, values, "string", lambda x: dates.parse_datetime(x).cast("timestamp_ntz")) == want


def test_window_boundaries():
    now = datetime(2026, 6, 13, 2, tzinfo=timezone.utc)
    assert dates.window_boundaries(now) == {"today": "20260612", "publication_start": "20260513", "proposal_end": "20260811", "update_start": "20260610"}
    assert dates.window_boundaries(now, datetime(2026, 6, 1, 12, tzinfo=timezone.utc))["update_start"] == "20260531"


def test_status(spark):
    e = ["HTTP 404 not found", "503 Server Error: x", "bad status code 429", "timeout", None]
    assert column(spark, e, "string", status.status_code) == [404, 503, 429, None, None]
    assert column(spark, e, "string", status.severity) == ["warning", "warning", "warning", "error", None]
    assert column(spark, [408, 507, None], "int", lambda x: status.is_retryable(x, any_server_error=True)) == [True, True, False]


def test_paging_goldens(spark):
    assert column(spark, ["<!-- PAGE 1 -->\nfirst page\n\n<!-- PAGE 2 -->\nsecond page"], "string", markdown.with_page_counters) == ["first page\n\n<!-- Página 2 -->\n\nsecond page"]
    raw = ["intro\n<!-- PAGE 1 --> a <!-- PAGE 3 --> b <!-- PAGE 3 --> c <!-- PAGE 4 -->  ", "a\f \fb", "plain ", ""]
    assert column(spark, raw, "string", markdown.with_page_counters) == ["intro\n\na\n\n<!-- Página 3 -->\n\nb\n\nc", "a\n\n<!-- Página 2 -->\n\nb", "plain", ""]
    assert column(spark, [["x", None, " ", "y"], []], "array<string>", markdown.from_pages) == ["x\n\n<!-- Página 2 -->\n\ny", ""]
    pages = [[(0, ["a", "b"]), (None, []), (None, ["c"]), (2, None)]]
    assert column(spark, pages, "array<struct<page_index: int, rec_texts: array<string>>>", markdown.from_recognised) == ["<!-- PAGE 1 -->\na\nb\n\nc\n\n<!-- PAGE 3 -->\n"]


HTML = """<div id=content><p>x<a href="a.pdf" title="T">one <b>two</b></a><a>no href</a>
<a href='b.pdf' aria-label=L>open <a href="c.pdf">next</a></div><script>"<a href=z>"</script>
<div id="content"><div id="inner"><a href="d.pdf">in</a></div></div><span class="j k" data-d='[{"link":"e","title":"E"}, 3, {"x":1}]'></span>"""


def test_anchors(spark):
    got = parse_anchors(HTML)
    assert [a["href"] for a in got] == ["a.pdf", "b.pdf", "c.pdf", "d.pdf"]
    assert (got[0]["text"], got[0]["title"], got[1]["aria_label"]) == ("one two", "T", "L")
    assert [a["href"] for a in parse_anchors(HTML, scope=[["content", "inner"], ["content"]])] == ["d.pdf"]
    assert parse_anchors(HTML, json_in=("j", "data-d"))[-1]["href"] == "e"
    assert parse_anchors(None) == [] and parse_anchors("<<<a <a href=>") == []
    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "p int, html string")
    assert anchors(pages).count() == 4
