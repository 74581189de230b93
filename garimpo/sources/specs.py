"""The registry of HTML sources: what each one scans and which links it keeps, as data for one generic builder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import urls

# What call-for-proposal links say, with blanks, underscores or hyphens between the words.
_SEP = r"[\s_-]*"
CALLS = rf"call{_SEP}for{_SEP}proposals?"
REQUESTS = rf"request{_SEP}for{_SEP}proposals?"
INTEREST = rf"expression{_SEP}of{_SEP}interest|(?<![\w])eoi(?![\w])"


def words(*names: str) -> str:
    """A pattern for any of the words, with Unicode word borders."""
    return r"(?<![\w])(?:" + "|".join(names) + r")(?![\w])"


@dataclass(frozen=True)
class LinkRule:
    """Which anchors of a page are kept, and in which form.

    host: `listing` (equal to the page's host), `listing_bare` (both without
    `www.`), a tuple of domains (with subdomains), `=` before a domain for the
    bare host exactly, or None. path is a pattern for the path without slashes
    at its end. signal is searched in the joined `see` parts: h(ref), p(ath),
    t(ext), i (title), a(ria-label). pdf: True only PDFs, False no PDFs, None either.
    """

    host: str | tuple[str, ...] | None = "listing"
    path: str | None = None
    path_not: str | None = None
    path_by_host: tuple[tuple[str, str], ...] = ()
    signal: str | None = None
    block: str | None = None
    always: str | None = None
    see: str = "hptia"
    pdf: bool | None = None
    query_needs: str | None = None
    query_all: str | None = None
    query: str = "drop"
    strip_slash: bool = True
    listing_netloc: bool = False
    netloc: tuple[str, str] | None = None
    under_base: bool = False
    distinct: bool = True


@dataclass(frozen=True)
class SourceSpec:
    name: str
    listings: tuple[str, ...]
    detail: LinkRule | None = None
    listing_pdf: LinkRule | None = None
    detail_pdf: LinkRule = field(default_factory=lambda: LinkRule(host=None, pdf=True, query="keep", strip_slash=False, distinct=False))
    min_year: bool = True
    policy: str | None = "default"
    candidate_cap: int | None = 50
    cap_by_page: bool = False
    detail_cap: int | None = 20
    detail_origin: str = "detail_page"
    listing_origin: str = "listing_pdf"
    scope: tuple[tuple[str, ...], ...] = ()
    json_in: tuple[str, str] | None = None
    page_limit: int | None = None


def _match(rule: LinkRule, url: Column, base: Column) -> Column:
    keep = F.lit(True)
    if rule.host == "listing":
        keep = urls.host(url) == urls.host(base)
    elif rule.host == "listing_bare":
        keep = urls.bare_host(url) == urls.bare_host(base)
    elif isinstance(rule.host, tuple):
        keep = F.lit(False)
        for domain in rule.host:
            keep = keep | ((urls.bare_host(url) == domain[1:]) if domain.startswith("=") else urls.is_host_or_subdomain(url, domain))
    path = urls.strip_slashes(urls.path(url))
    if rule.path:
        keep = keep & path.rlike(rule.path)
    if rule.path_not:
        keep = keep & ~path.rlike(rule.path_not)
    for domain, pattern in rule.path_by_host:
        keep = keep & (~urls.is_host_or_subdomain(url, domain) | F.lower(path).rlike(pattern))
    if rule.query_needs:
        keep = keep & urls.query(url).rlike(rule.query_needs)
    if rule.query_all:
        keep = keep & urls.query(url).rlike(rule.query_all)
    if rule.under_base:
        prefix = urls.canonical(base, keep_query=False)
        keep = keep & urls.canonical(url, keep_query=False).startswith(F.concat(prefix, F.lit("/")))
    return keep


def resolve(rule: LinkRule, base: Column, href: Column) -> Column:
    """The url of an href on a page."""
    return urls.join(F.concat(urls.canonical(base, keep_query=False), F.lit("/")) if rule.under_base else base, href)


def keep_and_shape(rule: LinkRule, *, base: Column, href: Column, url: Column, text: Column, title: Column, aria_label: Column) -> tuple[Column, Column]:
    """(whether an anchor is kept, its canonical url); url is its resolved url, which is used many times and should be a column by itself."""
    keep = _match(rule, url, base)
    if rule.pdf is True and not rule.always:
        keep = keep & urls.looks_like_pdf(href)
    elif rule.pdf is False:
        keep = keep & ~urls.looks_like_pdf(url)
    parts = {"h": href, "p": urls.path(url), "t": text, "i": title, "a": aria_label}
    seen = F.lower(F.concat_ws(" ", *[F.coalesce(parts[c], F.lit("")) for c in rule.see]))
    if rule.signal:
        signalled = seen.rlike("(?U)" + rule.signal)
        if rule.always:
            signalled = F.lower(href).contains(rule.always) | (urls.looks_like_pdf(href) & signalled)
        keep = keep & signalled
    if rule.block:
        keep = keep & ~seen.rlike("(?U)" + rule.block)
    path = urls.strip_slashes(urls.path(url)) if rule.strip_slash else urls.path(url)
    query = {"drop": F.lit(""), "keep": urls.query(url), "sanitize": urls.sanitize_query(urls.query(url)), "routes": routes(urls.query(url))}[rule.query]
    scheme, netloc = (urls.scheme(base), urls.netloc(base)) if rule.listing_netloc else (urls.scheme(url), urls.netloc(url))
    if rule.netloc:
        netloc = F.when(urls.bare_host(url) == rule.netloc[0], rule.netloc[1]).otherwise(netloc)
    shaped = urls.build(scheme, netloc, path, query)
    if rule.pdf is None and rule.query == "routes":
        shaped = F.when(urls.looks_like_pdf(url), urls.canonical(url)).otherwise(shaped)
    return F.coalesce(keep, F.lit(False)) & (href != ""), shaped


# The route segments of the first source's query parameter.
ROUTES = ["bndes-periferias", "bndes-corais", "sertao-mais-produtivo"]
ROUTE_KEY = "urile"


def routes(query: Column) -> Column:
    """The query reduced to its sorted distinct allowed routes, in lower case; empty without any."""
    values = F.transform(F.filter(F.split(query, "&"), lambda p: p.startswith(ROUTE_KEY + "=")), lambda p: F.lower(F.coalesce(F.try_url_decode(F.substring(p, len(ROUTE_KEY) + 2, 4000)), F.lit(""))))
    allowed = F.filter(values, lambda v: F.arrays_overlap(F.split(v, "[/:]"), F.array(*map(F.lit, ROUTES))))
    return F.array_join(F.transform(F.array_sort(F.array_distinct(allowed)), lambda v: F.concat(F.lit(ROUTE_KEY + "="), F.url_encode(v))), "&")


def route_allowed(query: Column) -> Column:
    """Without any route parameter, or with at least one allowed."""
    return ~query.rlike(f"(^|&){ROUTE_KEY}=") | (routes(query) != "")


SPECS: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec(
            "bndes",
            ("https://www.bndes.gov.br/wps/portal/site/home/financiamento/produto/bndes-fundo-socioambiental", "https://www.bndes.gov.br/wps/vanityurl/chamadadeinovacao"),
            detail=LinkRule(host=("=bndes.gov.br",), path=".", path_not=r"(?i)/(imprensa|noticias|quem-somos)\b", signal=words("edital", "chamada", "cpsi", "inovacao", "fundo-socioambiental", "periferias", "corais", "sertao"), pdf=False, query="routes"),
            listing_pdf=LinkRule(host=("=bndes.gov.br",), path=".", path_not=r"(?i)/(imprensa|noticias|quem-somos)\b", signal=words("edital", "chamada", "cpsi", "inovacao", "fundo-socioambiental", "periferias", "corais", "sertao"), pdf=True, query="keep"),
            detail_origin="listing_detail",
        ),
        SourceSpec(
            "brde",
            ("https://www.brde.com.br/palacete/editais/", "https://www.brde.com.br/fsa/chamadas-de-investimento/"),
            detail=LinkRule(path=r"^/fsa/chamada-publica-brde-fsa-"),
            listing_pdf=LinkRule(host=None, pdf=True, query="keep", strip_slash=False),
            detail_origin="listing_detail",
        ),
        SourceSpec("fapergs", ("https://fapergs.rs.gov.br/abertos?classificacao=3242",), detail=LinkRule(signal=words("edital", "chamada", "centelha", "programa"), see="ht", pdf=False, query="keep"), detail_origin="listing_detail"),
        SourceSpec(
            "funbio",
            ("https://chamadas.funbio.org.br/",),
            detail=LinkRule(path="^/[a-z0-9-]+$", path_not="^/(calendario-chamadas|noticias|quem-somos|receba-informacoes)$", signal=words("chamada", "projeto", "edital", "floresta", "selecao")),
            detail_pdf=LinkRule(host=None, signal=words("regulamento", "edital", "chamada", "anexo", "termo"), block=words("privacidade", "politica", "cookie"), always="/download/regulamento", see="htia", query="keep", strip_slash=False, distinct=False),
        ),
        SourceSpec("iis_rio", ("https://www.iis-rio.org/noticias/",), detail=LinkRule(host="listing_bare", path="^/noticias/[^/]+$", signal=words("edital", "chamada", "consultoria", "tdr"), listing_netloc=True), policy="include_tdr", detail_cap=30, page_limit=10),
        SourceSpec("sema_rs", ("https://www.sema.rs.gov.br/residuos-solidos",), detail=LinkRule(signal=words("edital", "chamada", "chamamento"), see="htia", pdf=False, query="keep"), cap_by_page=True, detail_cap=40, page_limit=200),
        SourceSpec(
            "tnc",
            ("https://www.tnc.org.br/conecte-se/comunicacao/noticias/",),
            detail=LinkRule(host="listing_bare", path="^/conecte-se/comunicacao/noticias/[^/]+$", signal=words("edital", "chamada", "tdr", "consultoria", "documento"), see="htia", listing_netloc=True),
            json_in=("articleAggregationDetailsStr", "data-details"),
        ),
        SourceSpec(
            "wwf",
            ("https://www.wwf.org.br/sobrenos/aquisicoesecontratacoes/",),
            detail=LinkRule(path="^/sobrenos/aquisicoesecontratacoes(/|$)", query_needs=r"(^|&)uNewsID=\d+(&|$)", query_all=r"^(?!.*(^|&)uNewsID=(?!\d+(&|$)))", query="keep", strip_slash=False),
            listing_pdf=LinkRule(host=None, pdf=True, query="keep", strip_slash=False),
        ),
        SourceSpec("govbr_mma", ("https://www.gov.br/mma/pt-br/editais",), detail=LinkRule(host=None, under_base=True, pdf=False), scope=(("content-core", "parent-fieldname-text"), ("content-core",))),
        SourceSpec("unep", ("https://www.unep.org/gef/call-proposals",), listing_pdf=LinkRule(host=("unep.org",), pdf=True, signal=rf"(?:{CALLS}|concept{_SEP}note|gfc{_SEP}fund|applying{_SEP}for{_SEP}funding|{REQUESTS})", query="sanitize", strip_slash=False, netloc=("unep.org", "www.unep.org"))),
        SourceSpec("worldbank", ("https://www.worldbank.org/en/programs/procurement",), listing_pdf=LinkRule(host=("worldbank.org",), pdf=True, signal=rf"(?:{CALLS}|{REQUESTS}|{INTEREST}|procurement|funding{_SEP}strategy|resolution)", query="keep", strip_slash=False)),
        SourceSpec("fao", ("https://www.fao.org/plant-treaty/areas-of-work/funding/",), listing_pdf=LinkRule(host=("fao.org",), pdf=True, signal=rf"(?:{CALLS}|{REQUESTS}|{INTEREST}|procurement|funding{_SEP}strategy|resolution)", query="keep", strip_slash=False), min_year=False, policy=None),
        SourceSpec(
            "kfw",
            ("https://www.kfw-entwicklungsbank.de/International-financing/KfW-Development-Bank/Service/Procurement-regulations/",),
            listing_pdf=LinkRule(host=("kfw.de", "kfw-entwicklungsbank.de"), path_by_host=(("kfw-entwicklungsbank.de", "/service/procurement-regulations/|/document-center/|/pdf/download-center/pdf-dokumente-richtlinien/"),), pdf=True, signal=rf"(?:{CALLS}|{REQUESTS}|{INTEREST}|procurement)", query="keep", strip_slash=False),
            min_year=False,
            policy=None,
        ),
        SourceSpec(
            "fundacao_grupo_boticario",
            ("https://fundacaogrupoboticario.org.br/",),
            detail=LinkRule(host=("=fundacaogrupoboticario.org.br", "=goias.gov.br"), path="^/.", path_not="^/(noticias|quem-somos|nossa-atuacao|fale-conosco)$", path_by_host=(("goias.gov.br", "^/fapeg/"),), signal=words("chamada", "edital", "sprint", "bolsa")),
            min_year=False,
            policy=None,
            detail_origin="listing_pdf",
        ),
        SourceSpec("msgov", ("https://editaisms.prosas.com.br",), detail=LinkRule(path=r"^/edital(\.html)?$", query_needs="(^|&)id=[^&]", query="keep"), detail_pdf=LinkRule(host=None, signal=r"(?:\.pdf(?:$|[?#])|amazonaws\.com)", see="h", query="keep", strip_slash=False, distinct=False), min_year=False, policy=None, detail_cap=40, detail_origin="playwright_listing"),
    )
}


def names(listed: str | None = None) -> list[str]:
    """The sources of a comma-separated list, or all; an unknown name is an error."""
    if not listed or not listed.strip():
        return list(SPECS)
    wanted = list(dict.fromkeys(n.strip() for n in listed.split(",") if n.strip()))
    unknown = [n for n in wanted if n not in SPECS]
    if unknown:
        raise ValueError(f"unknown sources: {', '.join(unknown)}")
    return wanted
