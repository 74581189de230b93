"""URL functions as native column expressions: split, join, canonical forms, years, safety of literal hosts.

All of them return null for a null url and never fail on malformed text; urls
may hold blanks, which Spark's own URL parser rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RFC = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Parameters that track a visit.
TRACKING_PREFIX = "utm_"
TRACKING_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid"]

# Host names, suffixes and address ranges that must not be fetched.
BLOCKED_HOSTS = ["localhost", "localhost.localdomain", "ip6-localhost", "ip6-loopback"]
BLOCKED_SUFFIXES = [".local", ".internal"]
BLOCKED_IPV4 = [
    "10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "169.254.0.0/16", "0.0.0.0/8", "100.64.0.0/10",
    "192.0.0.0/24", "192.0.2.0/24", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4", "255.255.255.255/32",
]
BLOCKED_IPV6 = ["::1/128", "fc00::/7", "fe80::/10", "ff00::/8", "::/128"]


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _RFC, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _RFC, 2)


def host(url: Column) -> Column:
    """The host in lower case, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":[0-9]*$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _RFC, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _RFC, 4)


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, _RFC, 5)


def filename(url: Column) -> Column:
    """The last segment of the path; empty if the path ends in a slash."""
    return F.element_at(F.split(path(url), "/"), -1)


def bare_host(url: Column) -> Column:
    """The host without one leading `www.`."""
    return F.regexp_replace(host(url), r"^www\.", "")


def is_host_or_subdomain(url: Column, domain: str) -> Column:
    return (host(url) == domain) | host(url).endswith("." + domain)


def looks_like_pdf(url: Column) -> Column:
    """`.pdf` at the end of the url, or before its query or fragment, in any case."""
    return F.lower(url).rlike(r"\.pdf($|[?#])")


def build(scheme_: Column, netloc_: Column, path_: Column, query_: Column) -> Column:
    return F.concat(
        F.when(scheme_ != "", F.concat(scheme_, F.lit(":"))).otherwise(""),
        F.when((netloc_ != "") | (scheme_ != ""), F.concat(F.when(netloc_ != "", F.lit("//")).otherwise(""), netloc_)).otherwise(""),
        path_,
        F.when(query_ != "", F.concat(F.lit("?"), query_)).otherwise(""),
    )


def strip_slashes(path_: Column) -> Column:
    return F.regexp_replace(path_, "/+$", "")


def canonical(url: Column, *, keep_query: bool = True, strip_slash: bool = True) -> Column:
    """The url without its fragment, by default without slashes at the end of the path, with or without its query."""
    p = strip_slashes(path(url)) if strip_slash else path(url)
    return build(scheme(url), netloc(url), p, query(url) if keep_query else F.lit(""))


def _resolved(segments: Column, keep_leading: bool = True) -> Column:
    """Segments of a path with `.` and `..` resolved and empty ones dropped, joined again."""
    inner = F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == F.size(segments) - 1))
    done = F.aggregate(
        inner,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.array_append(acc, s)),
    )
    done = F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(done, F.lit(""))).otherwise(done)
    joined = F.array_join(done, "/")
    return F.when(joined == "", "/").otherwise(joined)


def join(base: Column, reference: Column) -> Column:
    """The reference resolved against the base url, as browsers do (RFC 3986). A fragment is kept."""
    r_scheme, r_netloc, r_path, r_query = scheme(reference), netloc(reference), path(reference), query(reference)
    tail = F.regexp_extract(reference, r"(?s)#(.*)$", 0)
    has_query = reference.rlike(r"^[^#]*\?")
    parents = F.split(F.regexp_replace(path(base), "[^/]+$", ""), "/")
    merged = F.when(r_path.startswith("/"), F.split(r_path, "/")).otherwise(F.concat(F.slice(parents, 1, F.greatest(F.size(parents) - 1, F.lit(0))), F.split(r_path, "/")))
    with_root = F.when(~r_path.startswith("/") & (F.element_at(merged, 1) != ""), F.concat(F.array(F.lit("")), merged)).otherwise(merged)
    resolved_path = F.when(r_path == "", path(base)).otherwise(_resolved(with_root))
    new_query = F.when(has_query, r_query).when(r_path == "", query(base)).otherwise("")
    relative = F.concat(build(scheme(base), netloc(base), resolved_path, new_query), tail)
    return (
        F.when(F.trim(reference) == "", base)
        .when((r_scheme != "") & (r_scheme != scheme(base)), reference)
        .when(r_scheme != "", reference)
        .when(r_netloc != "", F.concat(scheme(base), F.lit(":"), reference))
        .otherwise(relative)
    )


def sanitize_query(query_: Column) -> Column:
    """A query without tracking parameters, pairs decoded, sorted by key and value, and encoded again; blank values stay."""
    pairs = F.transform(
        F.filter(F.split(query_, "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.coalesce(F.try_url_decode(F.element_at(F.split(p, "=", 2), 1)), p).alias("k"),
            F.coalesce(F.try_url_decode(F.get(F.split(p, "=", 2), 1)), F.lit("")).alias("v"),
        ),
    )
    kept = F.filter(pairs, lambda x: ~(F.lower(x["k"]).startswith(TRACKING_PREFIX) | F.lower(x["k"]).isin(TRACKING_KEYS)))
    return F.array_join(F.transform(F.array_sort(kept), lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")


def without_tracking(url: Column) -> Column:
    return build(scheme(url), netloc(url), path(url), sanitize_query(query(url)))


def year(url: Column) -> Column:
    """The largest year 19xx or 20xx among the digit runs of exactly four in path and query; null if none."""
    runs = F.regexp_extract_all(F.concat(path(url), F.lit(" "), query(url)), F.lit("[0-9]+"), F.lit(0))
    years = F.filter(runs, lambda r: r.rlike("^(19|20)[0-9]{2}$"))
    return F.array_max(F.transform(years, lambda y: y.cast("int")))


def passes_min_year(url: Column, least: int) -> Column:
    """Urls without a year pass."""
    return F.coalesce(year(url) >= least, F.lit(True))


def _ipv4_number(host_: Column) -> Column:
    """The number of a dotted IPv4 address (also one mapped into IPv6); null for other hosts."""
    dotted = F.regexp_extract(host_, r"^(?:\[?::ffff:)?([0-9]{1,3}(?:\.[0-9]{1,3}){3})\]?$", 1)
    parts = F.transform(F.split(dotted, r"\."), lambda p: p.cast("long"))
    valid = (dotted != "") & F.forall(parts, lambda p: p <= 255)
    return F.when(valid, F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc * 256 + p))


def _ipv4_ranges() -> list[tuple[int, int]]:
    import ipaddress

    return [(int(n.network_address), int(n.broadcast_address)) for n in map(ipaddress.ip_network, BLOCKED_IPV4)]


def is_safe_literal(url: Column) -> Column:
    """Whether a url may be fetched, as far as its text tells: http or https, a host that is neither blocked by name nor in a blocked range.

    IPv6 literals are judged by their written prefix. What a name resolves to is
    checked by the connector when it fetches.
    """
    name = F.regexp_replace(host(url), r"\.+$", "")
    number = _ipv4_number(name)
    blocked = F.lit(False)
    for low, high in _ipv4_ranges():
        blocked = blocked | number.between(low, high)
    v6 = F.regexp_replace(F.regexp_extract(netloc(url), r"\[([0-9a-fA-F:.]+)\]", 1), "^(0{1,4}:)+:?", "::")
    blocked6 = (v6 != "") & F.lower(v6).rlike(r"^(::1?|f[cd][0-9a-f]{0,2}:.*|fe[89ab][0-9a-f]?:.*|ff[0-9a-f]{0,2}:.*)$")
    named = name.isin(BLOCKED_HOSTS) | F.lit(False)
    for suffix in BLOCKED_SUFFIXES:
        named = named | name.endswith(suffix)
    return F.coalesce(scheme(url).isin("http", "https") & (name != "") & ~named & ~F.coalesce(blocked, F.lit(False)) & ~blocked6, F.lit(False))


def ensure_safe(url: Column) -> Column:
    """The url itself; a query fails at a row whose url isn't safe."""
    return F.when(is_safe_literal(url), url).otherwise(F.raise_error(F.concat(F.lit("unsafe url: "), F.coalesce(url, F.lit("null")))))


def once(df: DataFrame, beside: list[str], **columns: Column) -> DataFrame:
    """The columns `beside` and new ones, each computed once a row.

    Filters and projections above are not merged into the expressions, as they
    would be with a plain select: urls are taken apart by nested patterns, and
    every use would repeat them.
    """
    return df.select(*beside, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
