"""The core queries by name, each over whole tables, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import dates, markdown, status, text, urls
from .functions.html import anchors
from .operators import caps, dedup, joins, stats, submit
from .plans import backlog, discovery, records
from .session import materialize, work_dir
from .sources import landing
from .sources.specs import LinkRule, SourceSpec, names

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
# Fixed instants make runs repeatable.
NOW = "2026-03-15 12:00:00"
LEAST_YEAR = 2026


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _now() -> F.Column:
    return F.to_timestamp(F.lit(NOW))


# ---------------------------------------------------------------- SQL pieces

RFC = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _u(k: int, col: str = "url") -> str:
    return f"regexp_extract({col}, '{RFC}', {k}, 's')"


SQL_HOST = f"lower(regexp_replace(regexp_replace({_u(2)}, '^.*@', ''), ':[0-9]*$', ''))"
SQL_PATH = f"regexp_replace({_u(3)}, '/+$', '')"


def _sql_build(scheme: str, netloc: str, path: str, query_: str) -> str:
    return (
        f"(case when {scheme} <> '' then {scheme} || ':' else '' end || case when {netloc} <> '' then '//' else '' end || {netloc} || {path}"
        f" || case when {query_} <> '' then '?' || {query_} else '' end)"
    )


SQL_CANONICAL = _sql_build(f"lower({_u(1)})", _u(2), SQL_PATH, _u(4))
SQL_CANONICAL_BARE = _sql_build(f"lower({_u(1)})", _u(2), SQL_PATH, "''")
SQL_YEAR = (
    f"list_max(list_transform(list_filter(regexp_extract_all({_u(3)} || ' ' || {_u(4)}, '[0-9]+'), lambda r: regexp_matches(r, '^(19|20)[0-9]{{2}}$')), lambda y: cast(y as integer)))"
)
SQL_FOLD = "translate(lower(coalesce({0}, '') || ' ' || coalesce({1}, '')), 'áéíóúãõç', 'aeiouaoc')"
SQL_EXCLUDED = "|".join(text.EXCLUSIONS)
SQL_EXCLUDED_TDR = "|".join(p for p in text.EXCLUSIONS if p != text.REFERENCE_TERMS)
SQL_FILENAME = f"string_split({_u(3)}, '/')[-1]"
SQL_DOC = "lower(coalesce(tipo_documento_nome, '') || ' ' || coalesce(titulo, ''))"
SQL_PRIORITY = "case " + " ".join(f"when contains({SQL_DOC}, '{t}') then {p}" for t, p in text.PRIORITIES) + f" else {text.OTHER_PRIORITY} end"


def sql_datetime(col: str) -> str:
    """A UTC timestamp of the three notations; without an offset three hours are added."""
    t = f"trim({col})"
    iso = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"
    off = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)(Z|[+-]\d{2}(?::?\d{2})?)$"
    sign = f"(case when regexp_extract({t}, '{off}', 2) in ('', 'Z') then 0 else (case when substr(regexp_extract({t}, '{off}', 2), 1, 1) = '-' then -1 else 1 end) * (try_cast(substr(regexp_extract({t}, '{off}', 2), 2, 2) as integer) * 60 + coalesce(try_cast(substr(replace(regexp_extract({t}, '{off}', 2), ':', ''), 4, 2) as integer), 0)) end)"
    return (
        f"(case when regexp_matches({t}, '{iso}') then try_cast({t} as timestamp) + interval 3 hour"
        f" when regexp_matches({t}, '{off}') then try_cast(regexp_extract({t}, '{off}', 1) as timestamp) - to_minutes({sign})"
        f" when regexp_matches({t}, '^\\d{{14}}$') then try_strptime({t}, '%Y%m%d%H%M%S') + interval 3 hour"
        f" when regexp_matches({t}, '^\\d{{8}}$') then try_strptime({t}, '%Y%m%d') + interval 3 hour end)"
    )


# ---------------------------------------------------------------- urls


@query(f"select candidate_id, lower({_u(1)}) as scheme, {SQL_HOST} as host, {_u(3)} as path, {_u(4)} as query, {_u(5)} as fragment, {SQL_FILENAME} as filename from candidates")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFC 3986 parts of every candidate's url."""
    u = F.col("url")
    return _t(spark, sf_dir, "candidates").select("candidate_id", urls.scheme(u).alias("scheme"), urls.host(u).alias("host"), urls.path(u).alias("path"), urls.query(u).alias("query"), urls.fragment(u).alias("fragment"), urls.filename(u).alias("filename"))


@query(f"select candidate_id, {SQL_CANONICAL} as canonical, {SQL_CANONICAL_BARE} as canonical_bare, regexp_replace({SQL_HOST}, '^www\\.', '') as bare_host from candidates")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """canonical forms with and without the query."""
    u = F.col("url")
    return _t(spark, sf_dir, "candidates").select("candidate_id", urls.canonical(u).alias("canonical"), urls.canonical(u, keep_query=False).alias("canonical_bare"), urls.bare_host(u).alias("bare_host"))


@query(
    f"""with p as (select candidate_id, unnest(list_filter(string_split({_u(4)}, '&'), lambda x: x <> '')) as p from candidates),
    kv as (select candidate_id, url_decode(string_split(p, '=')[1]) as k, url_decode(case when contains(p, '=') then substr(p, strpos(p, '=') + 1) else '' end) as v from p),
    kept as (select * from kv where not (starts_with(lower(k), 'utm_') or lower(k) in ('fbclid', 'gclid', 'mc_cid', 'mc_eid')))
    select candidate_id, replace(coalesce(string_agg(url_encode(k) || '=' || url_encode(v), '&' order by k, v), ''), '%20', '+') as query from candidates left join kept using (candidate_id) group by candidate_id"""
)
def url_sanitized_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """queries without tracking parameters, sorted and encoded again."""
    return _t(spark, sf_dir, "candidates").select("candidate_id", urls.sanitize_query(urls.query(F.col("url"))).alias("query"))


@query(f"select candidate_id, {SQL_YEAR} as year, coalesce({SQL_YEAR} >= {LEAST_YEAR}, true) as passes from candidates")
def url_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, P5: the greatest year in path and query, and the year guard."""
    u = F.col("url")
    return _t(spark, sf_dir, "candidates").select("candidate_id", urls.year(u).alias("year"), urls.passes_min_year(u, LEAST_YEAR).alias("passes"))


@query(
    f"select candidate_id, not regexp_matches({SQL_FOLD.format(SQL_FILENAME, 'url')}, '{SQL_EXCLUDED}') as by_default, not regexp_matches({SQL_FOLD.format(SQL_FILENAME, 'url')}, '{SQL_EXCLUDED_TDR}') as with_tdr, true as unfiltered,"
    " regexp_matches(lower(url), '\\.pdf($|[?#])') as is_pdf from candidates"
)
def notice_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notice prefilter under its three policies, and the PDF test."""
    u = F.col("url")
    return _t(spark, sf_dir, "candidates").select("candidate_id", *[text.is_likely_notice(urls.filename(u), u, p).alias(n) for n, p in (("by_default", "default"), ("with_tdr", "include_tdr"), ("unfiltered", "no_prefilter"))], urls.looks_like_pdf(u).alias("is_pdf"))


@query(
    f"""with u as (select url from candidates union select * from (values ('http://10.1.2.3/a'), ('https://172.20.0.1'), ('http://8.8.8.8/x'), ('http://localhost:80/'), ('ftp://files.example/a'), ('https://db.internal/x'), ('http://[::1]/'), ('https://printer.local.')) v(url)),
    h as (select url, lower({_u(1)}) as scheme, regexp_replace({SQL_HOST}, '\\.+$', '') as host from u)
    select url, scheme in ('http', 'https') and host <> '' and host not in ('localhost', 'localhost.localdomain', 'ip6-localhost', 'ip6-loopback') and not regexp_matches(host, '\\.(local|internal)$')
    and host not in ('10.1.2.3', '172.20.0.1') and not contains(url, '[::1]') as safe from h"""
)
def url_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls that may be fetched as far as their text tells, with literal addresses."""
    more = ["http://10.1.2.3/a", "https://172.20.0.1", "http://8.8.8.8/x", "http://localhost:80/", "ftp://files.example/a", "https://db.internal/x", "http://[::1]/", "https://printer.local."]
    known = _t(spark, sf_dir, "candidates").select("url").unionByName(spark.createDataFrame([(m,) for m in more], "url string")).distinct()
    return known.select("url", urls.is_safe_literal(F.col("url")).alias("safe"))


@query(f"select c.candidate_id, s.source, s.origin_kind from candidates c join source_catalog s on regexp_replace({SQL_HOST.replace('(url,', '(c.url,')}, '^www\\.', '') = regexp_replace(s.host, '^www\\.', '')")
def host_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by the known hosts; the catalog is small, and Spark broadcasts it by its size."""
    s = _t(spark, sf_dir, "source_catalog").select("source", "origin_kind", F.regexp_replace("host", r"^www\.", "").alias("h"))
    return _t(spark, sf_dir, "candidates").select("candidate_id", urls.bare_host(F.col("url")).alias("h")).join(s, "h").drop("h")


# ---------------------------------------------------------------- dates


@query(f"select seq, {sql_datetime('data_encerramento_proposta')} as deadline, {sql_datetime('data_abertura_proposta')} as opening, {sql_datetime('data_publicacao_pncp')} as published from procurement_records")
def record_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dates in three notations as UTC instants."""
    r = _t(spark, sf_dir, "procurement_records")
    return r.select("seq", *[dates.parse_datetime(F.col(c)).cast("timestamp_ntz").alias(n) for n, c in (("deadline", "data_encerramento_proposta"), ("opening", "data_abertura_proposta"), ("published", "data_publicacao_pncp"))])


_OPEN = (
    f"coalesce(case when regexp_matches(trim(ano_compra), '^[+-]?[0-9]+$') then try_cast(trim(ano_compra) as integer) end >= {LEAST_YEAR}, false) and coalesce(situacao_compra_id = 1, true) and coalesce({sql_datetime('data_encerramento_proposta')} > timestamp '{NOW}', false)"
    f" and coalesce({sql_datetime('data_abertura_proposta')} <= timestamp '{NOW}', true)"
)


@query(f"select seq from procurement_records where {_OPEN} and trim(coalesce(numero_controle_pncp, '')) <> '' and sequencial_compra is not null and ano_compra is not null")
def open_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are open at an instant and can be looked up."""
    r = _t(spark, sf_dir, "procurement_records")
    keep = records.in_window(_now(), year=F.trim("ano_compra"), status=F.col("situacao_compra_id"), opening=F.col("data_abertura_proposta"), deadline=F.col("data_encerramento_proposta"), least_year=LEAST_YEAR)
    return r.where(keep & records.can_look_up(F.col("numero_controle_pncp"), F.col("sequencial_compra"), F.col("ano_compra"))).select("seq")


_DAY = f"strftime({sql_datetime('data_publicacao_pncp')} - interval 3 hour, '%Y%m%d')"
_UPDATED = f"strftime({sql_datetime('data_atualizacao_global')} - interval 3 hour, '%Y%m%d')"
_BOUND = "strftime(timestamp '{0}' - interval 3 hour {1} interval {2} day, '%Y%m%d')"


@query(
    f"""select seq, coalesce({_DAY} between {_BOUND.format(NOW, '-', 30)} and {_BOUND.format(NOW, '-', 0)}, false) as published, coalesce({_UPDATED} between {_BOUND.format('2026-03-10 05:00:00', '-', 1)} and {_BOUND.format(NOW, '-', 0)}, false) as updated,
    {_BOUND.format(NOW, '+', 60)} as proposal_end from procurement_records"""
)
def window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the windows of an incremental run that follows one of 2026-03-10."""
    b = dates.window_boundaries(datetime(2026, 3, 15, 12, tzinfo=timezone.utc), datetime(2026, 3, 10, 5, tzinfo=timezone.utc))
    day = lambda c: F.date_format(dates.parse_datetime(F.col(c)) - F.expr("INTERVAL 3 HOURS"), "yyyyMMdd")
    between = lambda c, low: F.coalesce(day(c).between(b[low], b["today"]), F.lit(False))
    return _t(spark, sf_dir, "procurement_records").select("seq", between("data_publicacao_pncp", "publication_start").alias("published"), between("data_atualizacao_global", "update_start").alias("updated"), F.lit(b["proposal_end"]).alias("proposal_end"))


@query("select download_id, hour(fetched_at at time zone 'UTC' at time zone 'America/Los_Angeles') between 8 and 18 as daytime from downloads where fetched_at is not null")
def daytime_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: downloads fetched by day on the west coast."""
    return _t(spark, sf_dir, "downloads").where("fetched_at IS NOT NULL").select("download_id", dates.in_daytime(F.col("fetched_at").cast("timestamp")).alias("daytime"))


# ---------------------------------------------------------------- dedup, order


@query(
    """with r as (select *, row_number() over (partition by numero_controle_pncp order by coalesce(data_atualizacao_global, '') desc, coalesce(data_atualizacao, '') desc, seq) as n,
    min(seq) over (partition by numero_controle_pncp) as first_seq from procurement_records where trim(coalesce(numero_controle_pncp, '')) <> '')
    select numero_controle_pncp, seq, first_seq, objeto_compra from r where n = 1"""
)
def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each control number the record of the latest update, first seen on ties."""
    return records.latest_records(_t(spark, sf_dir, "procurement_records")).select("numero_controle_pncp", "seq", "first_seq", "objeto_compra")


@query(f"with c as (select candidate_id, {SQL_CANONICAL} as canonical from candidates) select canonical, min(candidate_id) as candidate_id from c group by canonical")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidate of each canonical url."""
    c = _t(spark, sf_dir, "candidates").select("candidate_id", urls.canonical(F.col("url")).alias("canonical"))
    return dedup.keep_first(c, ["canonical"], "candidate_id")


@query(
    """with a as (select url, 0 as part, min(candidate_id) as place from candidates group by url), b as (select trim(url) as url, 1 as part, min(id) as place from backfill_claims where url is not null group by 1),
    u as (select * from a union all select * from b), r as (select *, row_number() over (partition by url order by part, place) as n from u) select url, part, place from r where n = 1 and url is not null"""
)
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, then claims, each url once at its first place."""
    a = _t(spark, sf_dir, "candidates").select("url", F.col("candidate_id").alias("seq"))
    b = _t(spark, sf_dir, "backfill_claims").select(F.trim("url").alias("url"), F.col("id").alias("seq"))
    return dedup.union_distinct([a, b], ["url"]).select("url", F.col("seq.part").alias("part"), F.col("seq.place").alias("place"))


@query("select candidate_id, url from candidates c where not exists (select 1 from backfill_claims b where b.url = c.url)")
def not_in_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unseen rows: an anti-join."""
    return dedup.not_seen(_t(spark, sf_dir, "candidates").select("candidate_id", "url"), _t(spark, sf_dir, "backfill_claims").where("url IS NOT NULL"), ["url"])


@query(f"select numero_controle_pncp, sequencial_documento, url, {SQL_PRIORITY} as priority, {SQL_PRIORITY} < 100 as preferred from document_descriptors")
def document_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority and preference of document kinds."""
    k, t = F.col("tipo_documento_nome"), F.col("titulo")
    return _t(spark, sf_dir, "document_descriptors").select("numero_controle_pncp", "sequencial_documento", "url", text.document_priority(k, t).alias("priority"), text.is_preferred_document(k, t).alias("preferred"))


_SELECTED = f"""docs as (select *, {SQL_PRIORITY} as priority from document_descriptors where {SQL_PRIORITY} < 100 and url is not null and numero_controle_pncp is not null),
    firsts as (select * from (select *, row_number() over (partition by numero_controle_pncp, url order by seen_at nulls first, sequencial_documento nulls first, tipo_documento_nome, titulo) as n from docs) where n = 1),
    chosen as (select *, row_number() over (partition by numero_controle_pncp order by priority, seen_at nulls first, sequencial_documento nulls first) as place from firsts)"""


@query(f"with {_SELECTED} select numero_controle_pncp, url, priority, place from chosen")
def select_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's preferred documents, by priority and first seen."""
    d = _t(spark, sf_dir, "document_descriptors").withColumn("doc_order", F.struct("seen_at", "sequencial_documento"))
    return records.select_documents(d, key="numero_controle_pncp", seq="doc_order").select("numero_controle_pncp", "url", "priority", "place")


# ---------------------------------------------------------------- joins

_METADATA = ", ".join(
    [f'{"trim(ano_compra)" if c == "ano_compra" else c} as "{n}"' for n, c in records.RECORD_FIELDS.items()]
    + [f"coalesce({c}, '') as \"{n}\"" for n, c in records.BLANK_FIELDS.items()]
    + [f'{c} as "{n}"' for n, c in records.NESTED_FIELDS.items()]
    + ['sequencial_documento as "sequencialDocumento"', 'tipo_documento_nome as "tipoDocumentoNome"', "coalesce(titulo, '') as titulo", "priority"]
)


@query(
    f"""with {_SELECTED}, m as (select * from procurement_records where modalidade_id in (4, 6, 8) and trim(coalesce(numero_controle_pncp, '')) <> ''),
    latest as (select * from (select *, row_number() over (partition by numero_controle_pncp order by coalesce(data_atualizacao_global, '') desc, coalesce(data_atualizacao, '') desc, seq) as n, min(seq) over (partition by numero_controle_pncp) as first_seq from m) where n = 1),
    openr as (select * from latest where {_OPEN} and sequencial_compra is not null and ano_compra is not null),
    j as (select o.first_seq as record_seq, c.place, trim(c.url) as url, o.*, c.sequencial_documento, c.tipo_documento_nome, c.titulo, c.priority from openr o join chosen c using (numero_controle_pncp) where trim(coalesce(c.url, '')) <> ''),
    r as (select *, row_number() over (partition by url order by record_seq, place) as k from j)
    select record_seq, place, url, 'pdf' as kind, {_METADATA} from r where k = 1"""
)
def record_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open records joined with their documents, as candidates."""
    r = _t(spark, sf_dir, "procurement_records").withColumn("ano_compra", F.trim("ano_compra"))
    c = records.candidates(r, _t(spark, sf_dir, "document_descriptors"), now=_now(), least_year=LEAST_YEAR)
    return c.select("record_seq", "place", "url", "kind", "metadata.*")


@query(
    f"""with {_SELECTED}, m as (select * from procurement_records where modalidade_id in (4, 6, 8) and trim(coalesce(numero_controle_pncp, '')) <> ''),
    latest as (select * from (select *, row_number() over (partition by numero_controle_pncp order by coalesce(data_atualizacao_global, '') desc, coalesce(data_atualizacao, '') desc, seq) as n, min(seq) over (partition by numero_controle_pncp) as first_seq from m) where n = 1),
    openr as (select * from latest where {_OPEN} and sequencial_compra is not null and ano_compra is not null order by first_seq limit 100),
    lost as (select distinct numero_controle_pncp from document_descriptors where url is null and numero_controle_pncp is not null),
    t as (select o.*, l.numero_controle_pncp is not null as bad from openr o left join lost l using (numero_controle_pncp)), i as (select *, sum((not bad)::int) over (order by first_seq) as island from t),
    k as (select *, sum(bad::int) over (partition by island order by first_seq) as streak from i), e as (select min(first_seq) as stop from k where streak >= 3),
    used as (select k.* from k, e where not bad and (stop is null or first_seq <= stop)),
    j as (select o.first_seq as record_seq, c.place, trim(c.url) as url from used o join chosen c using (numero_controle_pncp) where trim(coalesce(c.url, '')) <> ''),
    r as (select *, row_number() over (partition by url order by record_seq, place) as k from j)
    select record_seq, place, url from r where k = 1 order by record_seq, place limit 50"""
)
def document_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 100 records looked up, none after three failed lookups in a row (here: records with a null url), at most 50 candidates."""
    r = _t(spark, sf_dir, "procurement_records").withColumn("ano_compra", F.trim("ano_compra"))
    d = _t(spark, sf_dir, "document_descriptors")
    c = records.candidates(r, d, now=_now(), least_year=LEAST_YEAR, lookups=100, failed=d.where("url IS NULL"), failures=3, most=50)
    return c.select("record_seq", "place", "url")


@query(
    """with scopes as (select 0 as scope_no, 'all' as scope union all select row_number() over (order by host), host from source_catalog),
    kinds as (select * from (values (0, 'proposal', cast(null as integer)), (1, 'publication', 6), (2, 'update', 6), (3, 'publication', 8), (4, 'update', 8), (5, 'publication', 4), (6, 'update', 4)) v(kind_no, endpoint, modality))
    select cast(scope_no * 7 + kind_no as bigint) as scan_no, scope, endpoint, modality from scopes, kinds"""
)
def scan_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scans of a run, scopes by endpoints and codes."""
    hosts = _t(spark, sf_dir, "source_catalog").select(F.row_number().over(Window.orderBy("host")).alias("scope_no"), F.col("host").alias("scope"))
    scopes = spark.createDataFrame([(0, "all")], "scope_no int, scope string").unionByName(hosts)
    return records.scans(scopes).withColumn("scan_no", F.col("scan_no").cast("bigint"))


@query("with w as (select candidate_id, count(*) as n from worker_results group by candidate_id) select cast(count(*) as bigint) as joined, cast(count(n) as bigint) as matched, cast(count(*) - count(n) as bigint) as unmatched from candidates left join w using (candidate_id)")
def candidate_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with and without a result, of a left join."""
    return joins.left_count(_t(spark, sf_dir, "candidates"), _t(spark, sf_dir, "worker_results").select("candidate_id", "result_id"), "candidate_id", "result_id")


# ---------------------------------------------------------------- caps

_SOURCE = "coalesce(nullif(lower(trim(metadata.source)), ''), 'unknown')"


def _sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.lower(F.trim("metadata.source"))
    return _t(spark, sf_dir, "candidates").withColumn("source", F.when(source.isNull() | (source == ""), "unknown").otherwise(source)).withColumn("listing_url", F.col("metadata.listing_url"))


@query(f"select candidate_id, source from (select candidate_id, {_SOURCE} as source, row_number() over (partition by {_SOURCE} order by candidate_id) as n from candidates) where n <= 50")
def candidate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 candidates of each source."""
    return caps.cap(_sourced(spark, sf_dir), 50, "candidate_id", ["source"]).select("candidate_id", "source")


@query(f"select {_SOURCE} as source, cast(count(*) as bigint) as rows, count(*) >= 50 as cap_reached from candidates group by 1")
def cap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a source reached its cap."""
    return caps.cap_reached(_sourced(spark, sf_dir), 50, ["source"])


@query(
    f"""with c as (select candidate_id, {_SOURCE} as source, metadata.listing_url as page from candidates), p as (select source, page, count(*) as n from c group by all),
    b as (select *, coalesce(sum(n) over (partition by source order by page nulls first rows between unbounded preceding and 1 preceding), 0) as before from p)
    select c.candidate_id, c.source from c join b on c.source = b.source and c.page is not distinct from b.page where before < 50"""
)
def page_cap_overshoot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole listing pages until a source has at least 50."""
    return caps.cap_by_page(_sourced(spark, sf_dir), 50, "listing_url", ["source"]).select("candidate_id", "source")


@query("with d as (select download_id, outcome, coalesce(sum((outcome = 'valid_pdf')::int) over (order by download_id rows between unbounded preceding and 1 preceding), 0) as before from downloads) select download_id, outcome, cast(before as bigint) as successes_before from d where before < 1000")
def success_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloads tried while fewer than 1,000 succeeded before."""
    d = _t(spark, sf_dir, "downloads")
    return caps.success_budget(d, 1000, F.col("outcome") == "valid_pdf", "download_id").select("download_id", "outcome", "successes_before")


@query(
    """with d as (select batch_no, download_id, coalesce(outcome <> 'valid_pdf', false) as bad from downloads), i as (select *, sum((not bad)::int) over (partition by batch_no order by download_id) as island from d),
    s as (select *, sum(bad::int) over (partition by batch_no, island order by download_id) as streak from i), e as (select batch_no, min(download_id) as stop from s where streak >= 3 group by batch_no)
    select s.batch_no, s.download_id, cast(s.streak as bigint) as streak from s left join e using (batch_no) where stop is null or s.download_id <= stop"""
)
def streak_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch up to its third failure in a row."""
    d = _t(spark, sf_dir, "downloads").select("batch_no", "download_id", "outcome")
    return caps.stop_after_streak(d, 3, F.col("outcome") != "valid_pdf", "download_id", ["batch_no"]).select("batch_no", "download_id", "streak")


_STALE = f"""with c as (select {_SOURCE} as source, cast(regexp_extract(metadata.listing_url, 'pagina=(\\d+)', 1) as integer) as page, metadata.detail_url as key, candidate_id from candidates where regexp_matches(metadata.listing_url, 'pagina=\\d+')),
    f as (select source, key, min(page) as page from c where key is not null group by all), n as (select source, page, count(*) as fresh from f group by all),
    p as (select source, page, count(key) as found, coalesce(max(fresh), 0) as fresh from c left join n using (source, page) group by all),
    i as (select *, sum((fresh > 0)::int) over (partition by source order by page) as island from p), s as (select *, sum((fresh = 0)::int) over (partition by source, island order by page) as streak from i),
    e as (select source, min(page) filter (where streak >= 2) as stale, min(page) filter (where found = 0) as empty from s group by source)
    select c.candidate_id, c.source, c.page from c join e using (source) where (stale is null or c.page <= stale) and (empty is null or c.page <= empty)"""


@query(_STALE)
def stale_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered listing pages until two in a row bring no new detail page, or one has none."""
    page = F.regexp_extract("metadata.listing_url", r"pagina=(\d+)", 1).try_cast("int")
    c = _sourced(spark, sf_dir).withColumn("page", page).where("page IS NOT NULL").withColumn("key", F.col("metadata.detail_url"))
    return caps.stop_at_stale_pages(c, 2, "page", "key", ["source"]).select("candidate_id", "source", "page")


@query("select candidate_id, cast(regexp_extract(metadata.listing_url, 'pagina=(\\d+)', 1) as integer) as page from candidates c join source_catalog s on s.source = lower(trim(c.metadata.source)) where regexp_matches(metadata.listing_url, 'pagina=\\d+') and cast(regexp_extract(metadata.listing_url, 'pagina=(\\d+)', 1) as integer) between 1 and least(10, greatest(coalesce(s.listing_pages, 1), 1))")
def page_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages up to 10 and to the known number of pages."""
    page = F.regexp_extract("metadata.listing_url", r"pagina=(\d+)", 1).try_cast("int")
    c = _sourced(spark, sf_dir).withColumn("page", page).where("page IS NOT NULL").join(_t(spark, sf_dir, "source_catalog").select("source", "listing_pages"), "source")
    return caps.page_cap(c, "page", 10, F.col("listing_pages")).select("candidate_id", "page")


@query("select doc_id from documents where octet_length(encode(text)) <= 2000")
def byte_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of at most 2,000 bytes."""
    return caps.byte_cap(_t(spark, sf_dir, "documents"), "text", 2000).select("doc_id")


# ---------------------------------------------------------------- submission


@query("with g as (select result_id, cast(floor((row_number() over (order by result_id) - 1) / 30) as bigint) as batch_no, (row_number() over (order by result_id) - 1) % 30 as place, ocr_markdown from worker_results where ocr_markdown is not null and coalesce(error_text, '') = '') select result_id, batch_no, place, length(ocr_markdown[1:1000000]) as chars from g")
def submit_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that may be submitted, in batches of 30."""
    w = _t(spark, sf_dir, "worker_results").where(submit.submittable(F.col("ocr_markdown"), F.col("error_text")))
    slim = w.select("result_id", F.length(text.truncate_markdown(F.col("ocr_markdown"))).cast("bigint").alias("chars"))
    return submit.batches(slim, seq="result_id").select("result_id", "batch_no", "place", "chars")


@query("select cast(count(*) as bigint) as total, count(*) filter (where not (ocr_markdown is not null and coalesce(error_text, '') = '')) as filtered_out, count(*) filter (where ocr_markdown is not null and coalesce(error_text, '') = '') as submitted, cast(ceil(count(*) filter (where ocr_markdown is not null and coalesce(error_text, '') = '') / 30) as bigint) as batches, count(*) filter (where coalesce(error_text, '') <> '') as with_error from worker_results")
def submit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the summary of a submission."""
    return submit.summary(_t(spark, sf_dir, "worker_results"), result=F.col("ocr_markdown"), error=F.col("error_text"))


@query("with b as (select batch_no, bool_and(outcome <> 'download: too large') as ok from downloads group by batch_no), s as (select min(batch_no) filter (where not ok) as stop from b) select batch_no, ok from b, s where stop is null or batch_no <= stop")
def first_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: batches up to and with the first failed one."""
    b = _t(spark, sf_dir, "downloads").groupBy("batch_no").agg(F.bool_and(F.col("outcome") != "download: too large").alias("ok"))
    return submit.up_to_first_failure(b)


@query(
    """with s as (select control, seq, min(url) as url from (select numero_controle_pncp as control, sequencial_documento as seq, url from document_descriptors where numero_controle_pncp is not null and sequencial_documento is not null and url is not null) group by all),
    c as (select control, seq, max(url) as url from (select pncp_control_number as control, pncp_document_sequence as seq, url from backfill_claims where pncp_control_number is not null and pncp_document_sequence is not null and url is not null) group by all)
    select coalesce(s.control, c.control) as control, coalesce(s.seq, c.seq) as seq, coalesce(c.url, s.url) as url, case when c.control is null then 'kept' when s.control is null then 'inserted' when s.url = c.url then 'duplicate' else 'updated' end as outcome from s full join c on s.control = c.control and s.seq = c.seq"""
)
def idempotent_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: known documents after the claims' changes, by control number and sequence."""
    s = _t(spark, sf_dir, "document_descriptors").select(F.col("numero_controle_pncp").alias("control"), F.col("sequencial_documento").alias("seq"), "url").na.drop().groupBy("control", "seq").agg(F.min("url").alias("url"))
    c = _t(spark, sf_dir, "backfill_claims").select(F.col("pncp_control_number").alias("control"), F.col("pncp_document_sequence").alias("seq"), "url").na.drop().groupBy("control", "seq").agg(F.max("url").alias("url"))
    return submit.upsert(s, c, ["control", "seq"], compare=["url"])


@query("select doc_id, sha256(text) as hash, length(text[1:1000000]) as kept from documents where text is not null")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of texts, and truncation."""
    d = _t(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", text.content_hash(F.col("text")).alias("hash"), F.length(text.truncate_markdown(F.col("text"))).cast("bigint").alias("kept"))


# ---------------------------------------------------------------- backlog

_META = "case when json_valid(candidate_metadata) then candidate_metadata end"
_DEADLINE = sql_datetime(f"json_extract_string({_META}, '$.dataEncerramentoProposta')")


@query(
    f"""with b as (select id, {_DEADLINE} as deadline, coalesce(try_cast(json_extract_string({_META}, '$.priority') as integer), 100) as priority, discovered_at from backfill_claims),
    r as (select *, row_number() over (order by case when deadline > timestamp '{NOW}' then 0 else 1 end, case when priority = 10 then 0 else 1 end, deadline nulls last, discovered_at nulls last, id) as place from b)
    select id, priority, cast(place as integer) as place, coalesce(deadline > timestamp '{NOW}', false) as active from r where place <= 100"""
)
def backlog_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 100 claims in their five-key order."""
    df, by = backlog.order(_t(spark, sf_dir, "backfill_claims"), _now())
    first = df.orderBy(*by).limit(100)
    return first.select("id", "priority", F.row_number().over(Window.orderBy(*by)).alias("place"), F.coalesce(F.col("deadline") > _now(), F.lit(False)).alias("active"))


@query(f"with b as (select {_DEADLINE} as deadline from backfill_claims) select cast(count(*) as bigint) as rows, count(*) filter (where deadline > timestamp '{NOW}') as active, count(*) filter (where deadline <= timestamp '{NOW}') as expired, count(*) filter (where deadline is null) as without_deadline from b")
def backlog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active, expired and undated claims; undated ones are in neither of the first two."""
    b = _t(spark, sf_dir, "backfill_claims").select(backlog.deadline_of(F.col("candidate_metadata")).alias("deadline"))
    return stats.counters(b, {"active": F.col("deadline") > _now(), "expired": F.col("deadline") <= _now(), "without_deadline": F.col("deadline").isNull()})


@query(f"select id, coalesce(kind, 'pdf') as kind, candidate_metadata is null or coalesce(json_type({_META}) = 'OBJECT', false) as metadata_ok, json_extract_string({_META}, '$.cnpj') as cnpj, try_cast(json_extract_string({_META}, '$.sequencialDocumento') as integer) as sequence from backfill_claims where trim(coalesce(url, '')) <> ''")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with a url; fields of their JSON metadata, broken JSON marked."""
    c = landing.claimed(_t(spark, sf_dir, "backfill_claims"))
    g = lambda p: F.get_json_object("candidate_metadata", p)
    return c.select("id", "kind", "metadata_ok", g("$.cnpj").alias("cnpj"), g("$.sequencialDocumento").try_cast("int").alias("sequence"))


@query(f"with w as (select * from backfill_claims where url is not null), done as (select distinct candidate_id from downloads) select w.id from w left join done on done.candidate_id = w.id where done.candidate_id is null order by discovered_at nulls last, id limit 20")
def lease_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 claims that no lease holds."""
    q = _t(spark, sf_dir, "backfill_claims").where("url IS NOT NULL")
    leases = _t(spark, sf_dir, "downloads").select(F.col("candidate_id").alias("id"), F.lit("t").alias("token"), _now().alias("expires_at"), F.lit("done").alias("state"))
    return joins.claim(q, leases, key="id", order=[F.asc_nulls_last("discovered_at"), F.col("id")], now=_now(), limit=20).select("id")


# ---------------------------------------------------------------- statistics


@query(f"select {_SOURCE} as source, cast(count(*) as bigint) as rows, count(*) filter (where regexp_matches(lower(url), '\\.pdf($|[?#])')) as pdfs, count(*) filter (where metadata.detail_url is not null) as with_detail, count(*) filter (where metadata.origin = 'api') as from_api from candidates group by 1")
def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A4: counters by source."""
    return stats.counters(_sourced(spark, sf_dir), {"pdfs": urls.looks_like_pdf(F.col("url")), "with_detail": F.col("metadata.detail_url").isNotNull(), "from_api": F.col("metadata.origin") == "api"}, ["source"])


@query(f"with c as (select {_SOURCE} as source, coalesce({SQL_YEAR} >= {LEAST_YEAR}, true) as y, not regexp_matches({SQL_FOLD.format(SQL_FILENAME, 'url')}, '{SQL_EXCLUDED}') as p from candidates) select source, cast(count(*) as bigint) as rows, count(*) filter (where not y) as rejected_year, count(*) filter (where y and not p) as rejected_policy, count(*) filter (where y and p) as accepted from c group by 1")
def rejection_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: rejections by year first, else by policy."""
    u = F.col("url")
    return stats.rejection_split(_sourced(spark, sf_dir), urls.passes_min_year(u, LEAST_YEAR), text.is_likely_notice(urls.filename(u), u), ["source"])


@query("select batch_no, cast(count(*) as bigint) as rows, count(*) filter (where outcome = 'valid_pdf') as ok, count(*) filter (where outcome <> 'valid_pdf') as failed from downloads group by batch_no")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: successes and failures of each batch."""
    return stats.counters(_t(spark, sf_dir, "downloads"), {"ok": F.col("outcome") == "valid_pdf", "failed": F.col("outcome") != "valid_pdf"}, ["batch_no"])


_CODE = r"(?i)\bHTTP\s+(\d{3})\b"


@query(
    f"""with d as (select download_id, case when outcome like 'download:%' then outcome end as error, try_cast(nullif(regexp_extract(outcome, '{_CODE}', 1), '') as integer) as code from downloads)
    select download_id, code, coalesce(code in (401, 403, 429), false) as blocking, coalesce(code in (408, 425, 429, 500, 502, 503, 504), false) as retryable, case when error is null then null when coalesce(code in (400, 401, 403, 404, 408, 410, 413, 414, 415, 429, 500, 502, 503, 504), false) then 'warning' else 'error' end as severity, case when error is not null then 'download_error' end as kind from d"""
)
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures by code and kind."""
    d = _t(spark, sf_dir, "downloads").select("download_id", F.when(F.col("outcome").startswith("download:"), F.col("outcome")).alias("error"))
    e, code = F.col("error"), status.status_code(F.col("error"))
    return d.select("download_id", code.alias("code"), status.is_blocking(code).alias("blocking"), status.is_retryable(code).alias("retryable"), status.severity(e).alias("severity"), status.error_kind(e).alias("kind"))


# ---------------------------------------------------------------- pages


@query(
    """with p as (select doc_id, list_filter(list_transform(string_split(text, chr(10) || '## '), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') as s from documents where text is not null)
    select doc_id, coalesce(list_aggregate(list_transform(s, lambda x, i: case when i = 1 then x else '<!-- Página ' || i || ' -->' || chr(10) || chr(10) || x end), 'string_agg', chr(10) || chr(10)), '') as paged from p"""
)
def embedded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page texts (here: sections) renumbered into paged markdown."""
    d = _t(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", markdown.from_pages(F.split("text", "\n## ")).alias("paged"))


_MARK = "'<!-- P[aá]gina (\\d+) -->'"


@query(
    f"""with w as (select result_id, ocr_markdown as t, regexp_extract_all(ocr_markdown, {_MARK}, 1) as ns, regexp_split_to_array(ocr_markdown, {_MARK}) as ps from worker_results where ocr_markdown is not null),
    s as (select result_id, i, try_cast(ns[i - 1] as integer) as n, regexp_replace(ps[i], '^\\s+|\\s+$', '', 'g') as p from w, unnest(range(1, len(ps) + 1)) r(i)),
    k as (select *, lag(n) over (partition by result_id order by i) as before from s where p <> ''),
    o as (select result_id, string_agg(case when n is null or n = 1 or n is not distinct from before then p else '<!-- Página ' || n || ' -->' || chr(10) || chr(10) || p end, chr(10) || chr(10) order by i) as paged from k group by result_id)
    select w.result_id, coalesce(o.paged, '') as paged from w left join o using (result_id)"""
)
def page_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page marks of recognised text as page comments that keep their numbers."""
    w = _t(spark, sf_dir, "worker_results").where("ocr_markdown IS NOT NULL")
    raw = F.regexp_replace("ocr_markdown", "<!-- P[aá]gina (\\d+) -->", "<!-- PAGE $1 -->")
    return w.select("result_id", markdown.with_page_counters(raw).alias("paged"))


@query("with w as (select result_id, string_split(ocr_markdown, chr(10) || chr(10)) as p from worker_results where ocr_markdown is not null) select result_id, list_aggregate(list_transform(p, lambda x, i: '<!-- PAGE ' || i || ' -->' || chr(10) || x), 'string_agg', chr(10) || chr(10)) as paged from w")
def recognised_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recognised lines by page (here: blocks) under page marks."""
    w = _t(spark, sf_dir, "worker_results").where("ocr_markdown IS NOT NULL")
    pages = F.transform(F.split("ocr_markdown", "\n\n"), lambda b, i: F.struct(i.alias("page_index"), F.split(b, "\n").alias("rec_texts")))
    return w.select("result_id", markdown.from_recognised(pages).alias("paged"))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages as they would have been landed: the candidates' links by listing, as HTML."""
    c = _sourced(spark, sf_dir).where("listing_url IS NOT NULL")
    link = F.concat(F.lit('<li><a href="'), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit('" title="edital">Edital de chamada <b>'), F.col("candidate_id").cast("string"), F.lit("</b></a></li>"))
    # a page is numbered by its first link, so that no two pages have the same number
    body = c.groupBy("source", F.col("listing_url").alias("page_url"), F.floor(F.col("candidate_id") / 200).alias("part")).agg(F.min("candidate_id").alias("page_seq"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("candidate_id", link.alias("link")))), lambda x: x["link"]), "\n").alias("links"))
    pages = body.select("source", "page_url", F.col("page_seq").cast("int").alias("page_seq"), F.concat(F.lit("<html><body><ul>"), "links", F.lit('</ul><script>var a = "<a href=x>";</script></body></html>')).alias("html"))
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        _landed[key] = materialize(pages, "landed")
    return _landed[key]


# Pages landed by this process: they are written once for each application and folder.
_landed: dict[tuple[str, str], DataFrame] = {}


_PAGE_SEQ = f"cast(min(candidate_id) over (partition by {_SOURCE}, metadata.listing_url, floor(candidate_id / 200)) as integer)"


@query(f"select metadata.listing_url as page_url, {_PAGE_SEQ} as page_seq, url as href, 'Edital de chamada ' || candidate_id as text, 'edital' as title from candidates where metadata.listing_url is not null")
def page_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anchors of landed pages with text and title."""
    return anchors(landed_pages(spark, sf_dir).select("page_url", "page_seq", "html")).select("page_url", "page_seq", "href", "text", "title")


# The catalog's hosts as one generic source.
CATALOG_SPEC = SourceSpec("catalog", (), listing_pdf=LinkRule(host="listing_bare", signal=r"(?<![\w])edital(?![\w])", query="keep"), candidate_cap=None)


@query(
    f"""with c as (select candidate_id, url, metadata.listing_url as listing_url, {_PAGE_SEQ} as page_seq from candidates where metadata.listing_url is not null),
    r as (select *, case when trim(url) = '' then listing_url else url end as u from c), k as (select candidate_id, page_seq, listing_url, {_sql_build(f"lower({_u(1, 'trim(u)')})", _u(2, 'trim(u)'), f"regexp_replace({_u(3, 'trim(u)')}, '/+$', '')", _u(4, 'trim(u)'))} as url from r
    where regexp_replace({SQL_HOST.replace('(url,', '(trim(u),')}, '^www\\.', '') = regexp_replace({SQL_HOST.replace('(url,', '(listing_url,')}, '^www\\.', '')),
    f as (select *, row_number() over (partition by url order by page_seq, candidate_id) as n from k)
    select page_seq, url, 'pdf' as kind, 'catalog' as source, listing_url, cast(null as varchar) as detail_url, '{NOW}' as discovered_at, 'listing_pdf' as origin, {SQL_YEAR} as extracted_year
    from f where coalesce({SQL_YEAR} >= 2026, true) and not regexp_matches({SQL_FOLD.format(SQL_FILENAME, 'url')}, '{SQL_EXCLUDED}') and n = 1"""
)
def candidate_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: landed pages, anchors, links by rule, canonical form, year and policy guards, keep-first, candidates (X, P2, P5, F2, F8, R3, U11)."""
    pages = landed_pages(spark, sf_dir).drop("source")
    found = discovery.discover(pages, None, CATALOG_SPEC, discovered_at=F.lit(NOW), min_year=2026)
    return found.select("seq.page_seq", "url", "kind", "metadata.*")


# The catalog's detail pages as one generic source: the first 40 detail links in order, then their files.
DETAIL_SPEC = SourceSpec("details", (), detail=LinkRule(host=None, signal="edital", query="keep"), min_year=False, policy=None, candidate_cap=None, detail_cap=40)
_CANON = _sql_build(f"lower({_u(1, 'trim(d)')})", _u(2, 'trim(d)'), f"regexp_replace({_u(3, 'trim(d)')}, '/+$', '')", _u(4, 'trim(d)'))
_SHAPED = _sql_build(f"lower({_u(1, 'trim(url)')})", _u(2, 'trim(url)'), _u(3, 'trim(url)'), _u(4, 'trim(url)'))


def _page(rows: DataFrame, page: str, link: str, order: str) -> DataFrame:
    """Pages of the links of `rows`, numbered by their first row."""
    item = F.concat(F.lit('<li><a href="'), F.replace(F.col(link), F.lit("&"), F.lit("&amp;")), F.lit('">Edital</a></li>'))
    grouped = rows.groupBy(F.col(page).alias("page_url")).agg(F.min(order).cast("int").alias("page_seq"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, item.alias("item")))), lambda x: x["item"]), "").alias("links"))
    return grouped.select("page_url", "page_seq", F.concat(F.lit("<html><body>"), "links", F.lit("</body></html>")).alias("html"))


@query(
    f"""with c as (select candidate_id, url, metadata.listing_url as l, metadata.detail_url as d from candidates where metadata.listing_url is not null and trim(metadata.detail_url) <> '' and trim(url) <> ''), k as (select *, {_CANON} as detail from c),
    p as (select l, min(candidate_id) as page_seq from k group by l), f as (select k.*, p.page_seq, row_number() over (partition by detail order by p.page_seq, candidate_id) as n from k join p using (l)),
    w as (select detail, l, row_number() over (order by page_seq, candidate_id) as place from f where n = 1), top as (select * from w where place <= 40),
    u as (select top.*, k.candidate_id, {_SHAPED} as shaped from k join top using (detail) where regexp_matches(lower(trim(k.url)), '\\.pdf($|[?#])')),
    r as (select *, row_number() over (partition by shaped order by place, candidate_id) as n from u)
    select shaped as url, l as listing_url, detail as detail_url, case when regexp_matches(lower(shaped), '\\.pdf($|[?#])') then 'listing_pdf' else 'detail_page' end as origin, coalesce({SQL_YEAR.replace('(url,', '(shaped,')}, {SQL_YEAR.replace('(url,', '(detail,')}) as extracted_year from r where n = 1"""
)
def detail_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages to detail pages, the first 40 of these to their files."""
    c = _t(spark, sf_dir, "candidates").select("candidate_id", "url", F.col("metadata.listing_url").alias("listing"), F.col("metadata.detail_url").alias("detail")).where("listing IS NOT NULL AND trim(detail) <> '' AND trim(url) <> ''")
    c = c.withColumn("detail", urls.canonical(F.trim("detail")))
    listings, details = materialize(_page(c, "listing", "detail", "candidate_id"), "listings"), materialize(_page(c, "detail", "url", "candidate_id"), "details")
    found = discovery.discover(listings, details, DETAIL_SPEC, discovered_at=F.lit(NOW))
    return found.select("url", "metadata.listing_url", "metadata.detail_url", "metadata.origin", "metadata.extracted_year")


# The registry as it must be: source, listing pages, details, caps, policy, year guard.
REGISTRY = """bndes 2 true 50 20 default true
brde 2 true 50 20 default true
fapergs 1 true 50 20 default true
funbio 1 true 50 20 default true
iis_rio 1 true 50 30 include_tdr true
sema_rs 1 true 50 40 default true
tnc 1 true 50 20 default true
wwf 1 true 50 20 default true
govbr_mma 1 true 50 20 default true
unep 1 false 50 20 default true
worldbank 1 false 50 20 default true
fao 1 false 50 20 null false
kfw 1 false 50 20 null false
fundacao_grupo_boticario 1 true 50 20 null false
msgov 1 true 50 40 null false"""


def _registry_sql() -> str:
    rows = [r.split() for r in REGISTRY.splitlines()]
    known = " union all ".join(f"select '{n}' as source, {k} as listings, {d} as has_details, {c} as candidate_cap, {e} as detail_cap, {'null' if p == 'null' else repr(p)} as policy, {y} as min_year" for n, k, d, c, e, p, y in rows)
    return f"{known} union all select source, case when origin_kind = 'html' then 1 else 0 end, null, null, null, null, null from source_catalog"


@query(_registry_sql())
def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered sources with their caps and policies, beside those of the catalog."""
    from .sources.specs import SPECS

    rows = [(n, len(SPECS[n].listings), SPECS[n].detail is not None, SPECS[n].candidate_cap, SPECS[n].detail_cap, SPECS[n].policy, SPECS[n].min_year) for n in names()]
    known = spark.createDataFrame(rows, "source string, listings int, has_details boolean, candidate_cap int, detail_cap int, policy string, min_year boolean")
    listed = _t(spark, sf_dir, "source_catalog").select("source", F.when(F.col("origin_kind") == "html", 1).otherwise(0).alias("listings"))
    return known.unionByName(listed, allowMissingColumns=True)


@query("select distinct on (content) download_id, content from (select download_id, lower(regexp_replace(content_hash, '^sha256:', '')) as content from downloads where content_hash is not null) order by content, download_id")
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloads as a stream, run once over all that is there, deduplicated and merged into a keyed state batch by batch."""
    import uuid

    from .streaming.incremental import latest_state, run_available

    base = work_dir(spark) + f"/garimpo/stream-{uuid.uuid4().hex[:12]}"
    first = _t(spark, sf_dir, "downloads")
    stream = spark.readStream.schema(first.schema).parquet(f"{sf_dir}/downloads.parque[t]")
    keyed = stream.where("content_hash IS NOT NULL").select("download_id", F.lower(F.regexp_replace("content_hash", "^sha256:", "")).alias("content"), (-F.col("download_id")).alias("order"))

    def sink(batch: DataFrame, n: int) -> None:
        # a batch that is run again writes the same state again
        latest_state(spark, f"{base}/state-{n - 1}", batch.withColumn("order", F.lpad((F.lit(10**15) + F.col("order")).cast("string"), 20, "0")), "content", ["order"]).write.mode("overwrite").parquet(f"{base}/state-{n}")

    q = run_available(keyed, sink, f"{base}/checkpoint")
    q.awaitTermination()
    last = q.lastProgress["batchId"] if q.lastProgress else 0
    return spark.read.parquet(f"{base}/state-{last}").select("download_id", "content")


def queries() -> dict[str, Query]:
    from . import job_queries, source_queries  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
