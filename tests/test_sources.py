import http.server
import io
import json
import threading
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from garimpo.plans import discovery, process, records
from garimpo.sources import http as connectors
from garimpo.sources import landing
from garimpo.sources.specs import SPECS, names


def pages(spark, rows):
    return spark.createDataFrame([(u, i, h) for i, (u, h) in enumerate(rows)], "page_url string, page_seq int, html string")


def a(href, text="", **more):
    return f'<a href="{href}" ' + " ".join(f'{k}="{v}"' for k, v in more.items()) + f">{text}</a>"


def kept(spark, name, listing, *links, rule="detail"):
    spec = SPECS[name]
    return sorted(r.url for r in discovery.links(pages(spark, [(listing, "".join(links))]), getattr(spec, rule), spec).collect())


CASES = [
    ("bndes", "detail", "https://www.bndes.gov.br/wps/x", [a("/wps/edital-um/"), a("/imprensa/edital"), a("https://other.example/edital"), a("/wps/z?urile=wcm:path:/a/BNDES-Corais", "Edital"), a("/wps/z?urile=wcm:path:/a/outra", "Edital")], ["https://www.bndes.gov.br/wps/edital-um", "https://www.bndes.gov.br/wps/z?urile=wcm%3Apath%3A%2Fa%2Fbndes-corais"]),
    ("brde", "detail", "https://www.brde.com.br/fsa/l/", [a("/fsa/chamada-publica-brde-fsa-1/#x"), a("/fsa/outra"), a("https://x.example/fsa/chamada-publica-brde-fsa-2")], ["https://www.brde.com.br/fsa/chamada-publica-brde-fsa-1"]),
    ("fapergs", "detail", "https://fapergs.rs.gov.br/abertos", [a("/x?id=1", "Edital 1"), a("/edital.pdf"), a("/y", "nada")], ["https://fapergs.rs.gov.br/x?id=1"]),
    ("funbio", "detail", "https://chamadas.funbio.org.br/", [a("/projeto-mar/"), a("/noticias", "chamada"), a("/a/b", "edital")], ["https://chamadas.funbio.org.br/projeto-mar"]),
    ("iis_rio", "detail", "https://www.iis-rio.org/noticias/", [a("https://iis-rio.org/noticias/tdr-1/?x=1", "TdR"), a("/noticias/", "edital"), a("/noticias/a/b", "edital")], ["https://www.iis-rio.org/noticias/tdr-1"]),
    ("sema_rs", "detail", "https://www.sema.rs.gov.br/l", [a("/e?id=2", "Chamamento"), a("/chamada.pdf"), a("/e?id=2", "Edital")], ["https://www.sema.rs.gov.br/e?id=2"]),
    ("wwf", "detail", "https://www.wwf.org.br/sobrenos/aquisicoesecontratacoes/", [a("/sobrenos/aquisicoesecontratacoes/?uNewsID=12"), a("/sobrenos/aquisicoesecontratacoes/?uNewsID=1&uNewsID=b"), a("/sobrenos/?uNewsID=3")], ["https://www.wwf.org.br/sobrenos/aquisicoesecontratacoes/?uNewsID=12"]),
    ("unep", "listing_pdf", "https://www.unep.org/l", [a("https://unep.org/call-for-proposals.pdf?utm_source=x&b=2&a=1#p"), a("https://www.unep.org/other.pdf", "nothing"), a("https://x.example/call-for-proposals.pdf")], ["https://www.unep.org/call-for-proposals.pdf?a=1&b=2"]),
    ("worldbank", "listing_pdf", "https://www.worldbank.org/", [a("https://docs.worldbank.org/a.pdf", "EOI"), a("https://docs.worldbank.org/b.pdf", "geoid")], ["https://docs.worldbank.org/a.pdf"]),
    ("kfw", "listing_pdf", "https://www.kfw.de/", [a("https://www.kfw-entwicklungsbank.de/PDF/Download-Center/PDF-Dokumente-Richtlinien/p.pdf", "procurement"), a("https://www.kfw-entwicklungsbank.de/x/p.pdf", "procurement"), a("/q.pdf", "Request for Proposals")], ["https://www.kfw-entwicklungsbank.de/PDF/Download-Center/PDF-Dokumente-Richtlinien/p.pdf", "https://www.kfw.de/q.pdf"]),
    ("fundacao_grupo_boticario", "detail", "https://fundacaogrupoboticario.org.br/", [a("/chamada-1/"), a("/noticias", "edital"), a("https://goias.gov.br/fapeg/edital"), a("https://goias.gov.br/x/edital")], ["https://fundacaogrupoboticario.org.br/chamada-1", "https://goias.gov.br/fapeg/edital"]),
    ("msgov", "detail", "https://editaisms.prosas.com.br", [a("/edital?id=1#x"), a("/edital.html?id="), a("/outra?id=2")], ["https://editaisms.prosas.com.br/edital?id=1"]),
    ("fao", "listing_pdf", "https://www.fao.org/x/", [a("/f.pdf", "Call for proposals"), a("/g.pdf")], ["https://www.fao.org/f.pdf"]),
]


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_link_rules(spark, case):
    name, rule, listing, links, want = case
    assert kept(spark, name, listing, *links, rule=rule) == want


def test_scoped_and_json_sources(spark):
    html = f'<div id="content-core"><div id="parent-fieldname-text">{a("./chamamento-1/")}{a("x.pdf")}</div>{a("./fora")}</div>{a("./menu")}'
    assert kept(spark, "govbr_mma", "https://www.gov.br/mma/editais", html) == ["https://www.gov.br/mma/editais/chamamento-1"]
    items = json.dumps([{"link": "/conecte-se/comunicacao/noticias/edital-1/", "title": "Edital"}, 5]).replace('"', "&quot;")
    html = f'<span class="articleAggregationDetailsStr" data-details="{items}"></span>'
    assert kept(spark, "tnc", "https://www.tnc.org.br/conecte-se/comunicacao/noticias/", html) == ["https://www.tnc.org.br/conecte-se/comunicacao/noticias/edital-1"]


def test_discovery_end_to_end(spark):
    base = "https://www.brde.com.br"
    listings = pages(spark, [(base + "/palacete/editais/", a("/f/edital-2026.pdf") + a("/f/resultado-2026.pdf") + a("/f/edital-2020.pdf")), (base + "/fsa/l/", a("/fsa/chamada-publica-brde-fsa-2026/"))])
    details = pages(spark, [(base + "/fsa/chamada-publica-brde-fsa-2026", a("/g/regulamento.pdf") + a("/f/edital-2026.pdf"))])
    got = discovery.discover(listings, details, SPECS["brde"], discovered_at=F.lit("now"), min_year=2026).orderBy("seq").collect()
    assert [(r.url.rsplit("/", 1)[1], r.metadata.origin, r.metadata.extracted_year) for r in got] == [("edital-2026.pdf", "listing_pdf", 2026), ("regulamento.pdf", "listing_pdf", 2026)]


def test_registry():
    assert len(names()) == 15 and names(" fao ,, bndes,fao") == ["fao", "bndes"]
    with pytest.raises(ValueError):
        names("fao,other")


def test_landed_pages(spark):
    rows = [("q", 1, [1, None, 2], "3", False), ("q", 2, None, "3", False), ("q", 3, [3], None, False), ("q", 4, [4], "9", False), ("r", 1, [5], "9", False), ("r", 2, [6], "9", True), ("r", 3, [7], "9", False)]
    df = spark.createDataFrame(rows, "q string, page int, data array<int>, total_pages string, failed boolean")
    assert sorted(r.record for r in landing.records_of_pages(df, query=["q"], failed="failed").collect()) == [1, 2, 3, 5]


def test_claims_and_checkpoint(spark, tmp_path):
    df = spark.createDataFrame([("u", None, '{"a": 1}'), (" ", "pdf", "{}"), ("v", "doc", '{"a": '), ("w", "pdf", None), ("x", "pdf", "[1]")], "url string, kind string, candidate_metadata string")
    got = {r.url: (r.kind, r.candidate_metadata, r.metadata_ok) for r in landing.claimed(df).collect()}
    assert got == {"u": ("pdf", '{"a": 1}', True), "v": ("doc", "{}", False), "w": ("pdf", "{}", True), "x": ("pdf", "{}", False)}
    path = str(tmp_path / "c" / "state.json")
    assert landing.load_checkpoint(path) is None
    at = datetime(2026, 1, 2, tzinfo=timezone.utc)
    landing.save_checkpoint(path, at)
    assert landing.load_checkpoint(path) == at
    (tmp_path / "c" / "state.json").write_text("{")
    assert landing.load_checkpoint(path) is None
    shared = f"file://{tmp_path}/shared/state.json"
    assert landing.load_checkpoint(shared) is None
    for at in (datetime(2026, 1, 2, tzinfo=timezone.utc), datetime(2026, 1, 3, tzinfo=timezone.utc)):
        landing.save_checkpoint(shared, at)
        assert landing.load_checkpoint(shared) == at


def zipped(*files):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, data in files:
            z.writestr(name, data)
    return buffer.getvalue()


def test_processing_makes_errors_data(spark):
    rows = [("a", b"%PDF-1 x", None), ("b", zipped(("n.txt", b"x"), ("bad.pdf", b"no"), ("ok.pdf", b"%PDF-2")), None), ("c", b"", None), ("d", b"<html>", None), ("e", None, "http 404"), ("f", b"%PDF fail", None), ("g", b"PK broken", None)]
    df = spark.createDataFrame([(u, bytearray(c) if c is not None else None, e) for u, c, e in rows], "url string, content binary, error string")

    def extractor():
        def extract(pdf):
            if b"fail" in pdf:
                raise RuntimeError("no text")
            return pdf.decode()

        return extract

    got = {r.url: (r.worker_result.ocr_markdown if r.worker_result else None, r.error) for r in process.process(df, extractor).collect()}
    assert got["a"] == ("%PDF-1 x", None) and got["b"] == ("%PDF-2", None)
    assert got["e"][1] == "download: http 404" and got["f"][1] == "ocr: RuntimeError: no text"
    assert all(got[k][1].startswith("download:") for k in "cdg")
    assert [r.p for r in df.orderBy("url").select(process.is_pdf(F.col("content")).alias("p")).collect()] == [True, False, False, False, False, True, False]


class Handler(http.server.BaseHTTPRequestHandler):
    tries: dict = {}

    def do_GET(self):
        page = int(self.path.split("pagina=")[1].split("&")[0]) if "pagina=" in self.path else 0
        Handler.tries[self.path] = Handler.tries.get(self.path, 0) + 1
        if "/moved" in self.path:
            self.send_response(302)
            self.send_header("Location", "/file")
            self.end_headers()
            return
        if "code=flaky" in self.path and Handler.tries[self.path] == 1:
            self.send_response(503)
            self.send_header("Retry-After", "0")
            self.end_headers()
            return
        if "/missing" in self.path:
            self.send_response(404)
            self.end_headers()
            return
        body = b"%PDF" if "/file" in self.path else json.dumps({"data": [page], "totalPaginas": 2}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_connectors(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"
    connectors.register(spark)
    read = spark.read.format("json_pages").option("url", base + "/api").option("queries", json.dumps([{"code": "flaky"}, {"code": 6}])).option("allow_private", "true").load()
    got = read.collect()
    assert {(json.loads(r.query)["code"], r.page, r.error) for r in got} == {("flaky", 1, None), ("flaky", 2, None), (6, 1, None), (6, 2, None)}
    files = spark.read.format("downloads").option("urls", json.dumps([base + "/moved", base + "/missing", base + "/file"])).option("allow_private", "true").load().collect()
    assert {r.url.rsplit("/", 1)[1]: (r.status, bytes(r.content) if r.content else None) for r in files} == {"moved": (200, b"%PDF"), "missing": (404, None), "file": (200, b"%PDF")}
    blocked = spark.read.format("downloads").option("urls", json.dumps([base + "/file"])).load().first()
    assert "unsafe" in blocked.error
    server.shutdown()
    assert not connectors.is_safe("http://a.example/", resolve=lambda h: ["8.8.8.8", "10.0.0.1"])


def test_record_window(spark):
    now = F.lit("2026-06-12 12:00:00").cast("timestamp")
    rows = [("2026", 1, None, "20260625180000"), ("2025", 1, None, "20260625180000"), ("2026", 2, None, "20260625180000"), ("2026", None, "20260701000000", "20260725180000"), ("2026", 1, "bad", None), (None, 1, None, "20260625180000"), ("2026", None, "x", "20260625180000")]
    df = spark.createDataFrame(rows, "y string, s int, o string, d string")
    got = df.select(records.in_window(now, year=F.col("y"), status=F.col("s"), opening=F.col("o"), deadline=F.col("d"), least_year=2026).alias("k")).collect()
    assert [r.k for r in got] == [True, False, False, False, False, False, True]
