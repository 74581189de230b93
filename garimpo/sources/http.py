"""Live connectors as Python data sources: paged JSON APIs and downloads, one input partition a query.

They land raw payloads; everything after is DataFrame work. Standard library only.
"""

from __future__ import annotations

import ipaddress
import json
import socket
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlencode, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.status import PERMANENT, RETRYABLE
from ..functions.urls import BLOCKED_HOSTS, BLOCKED_IPV4, BLOCKED_IPV6, BLOCKED_SUFFIXES

MAX_REDIRECTS = 10
# Seconds to wait between the attempts of a download.
DOWNLOAD_WAITS = (5.0, 15.0, 45.0)
_NETWORKS = [ipaddress.ip_network(n) for n in BLOCKED_IPV4 + BLOCKED_IPV6]


def is_safe(url: str, resolve: Callable[[str], list[str]] | None = None) -> bool:
    """Whether a url may be fetched: scheme, host name, and every address the name resolves to."""
    parts = urlsplit(url)
    host = (parts.hostname or "").rstrip(".").lower()
    if parts.scheme not in ("http", "https") or not host or host in BLOCKED_HOSTS or any(host.endswith(s) for s in BLOCKED_SUFFIXES):
        return False
    try:
        found = [str(ipaddress.ip_address(host))]
    except ValueError:
        try:
            found = (resolve or (lambda h: [x[4][0] for x in socket.getaddrinfo(h, None)]))(host)
        except OSError:
            return False
    for text in found:
        ip = ipaddress.ip_address(text)
        ip = getattr(ip, "ipv4_mapped", None) or ip
        if any(ip.version == n.version and ip in n for n in _NETWORKS):
            return False
    return bool(found)


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_: object) -> None:
        return None


def fetch(url: str, *, attempts: int = 3, timeout: float = 30, max_bytes: int | None = None, safe: Callable[[str], bool] = is_safe, sleep: Callable[[float], None] = time.sleep, waits: tuple[float, ...] = ()) -> tuple[int, bytes, str | None]:
    """(status, body, error). Redirects are followed hop by hop, each checked, and don't use up attempts.

    The wait after a failed attempt is that of `waits`, or two seconds more each
    time; a Retry-After header overrides it, up to two minutes.
    """
    opener = urllib.request.build_opener(_NoRedirect)
    error: str | None = None
    status = 0
    for attempt in range(1, attempts + 1):
        at = url
        for _ in range(MAX_REDIRECTS + 1):
            if not safe(at):
                return 0, b"", f"unsafe url {at}"
            wait = waits[min(attempt, len(waits)) - 1] if waits else 2.0 * attempt
            try:
                with opener.open(urllib.request.Request(at, headers={"User-Agent": "garimpo"}), timeout=timeout) as r:
                    body = r.read() if max_bytes is None else r.read(max_bytes + 1)
                    if max_bytes is not None and len(body) > max_bytes:
                        return r.status, b"", "too large"
                    return r.status, body, None
            except urllib.error.HTTPError as e:
                status, error = e.code, f"HTTP {e.code}"
                if 300 <= e.code < 400 and e.headers.get("Location"):
                    at = urljoin(at, e.headers["Location"])
                    continue
                try:
                    wait = min(float(e.headers.get("Retry-After", wait)), 120.0)
                except ValueError:
                    pass
            except (OSError, ValueError) as e:
                status, error = 0, f"{type(e).__name__}: {e}"
            break
        else:
            return status, b"", "too many redirects"
        if status in PERMANENT or (status and status not in RETRYABLE) or attempt == attempts:
            break
        sleep(wait)
    return status, b"", error


class QueryPartition(InputPartition):
    def __init__(self, query: str, params: dict):
        self.query, self.params = query, params


class JsonPages(DataSource):
    """format("json_pages"): the pages of API queries.

    Options: url; queries (a JSON list of parameter objects); page_param, size_param,
    page_size, max_pages; total_path; allow_private for tests on local servers.
    """

    @classmethod
    def name(cls) -> str:
        return "json_pages"

    def schema(self) -> str:
        return "query string, page int, status int, body string, total_pages int, error string"

    def reader(self, schema: object) -> DataSourceReader:
        return _PagesReader(dict(self.options))


class _PagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        return [QueryPartition(json.dumps(q, sort_keys=True), q) for q in json.loads(self.o.get("queries", "[{}]"))]

    def read(self, partition: QueryPartition) -> Iterator[tuple]:
        safe = (lambda _: True) if self.o.get("allow_private") == "true" else is_safe
        for page in range(1, int(self.o.get("max_pages", 20)) + 1):
            params = partition.params | {self.o.get("page_param", "pagina"): page, self.o.get("size_param", "tamanhoPagina"): int(self.o.get("page_size", 50))}
            status, body, error = fetch(f"{self.o['url']}?{urlencode(params)}", attempts=int(self.o.get("attempts", 3)), timeout=float(self.o.get("timeout", 8)), safe=safe)
            total = None
            if error is None:
                try:
                    total = int(json.loads(body).get(self.o.get("total_path", "totalPaginas")))
                except (ValueError, TypeError, AttributeError):
                    total = None
            yield partition.query, page, status, body.decode("utf-8", "replace") if error is None else None, total, error
            # a failure ends the query and keeps its earlier pages
            if error is not None or total is None or page >= total:
                return


class Downloads(DataSource):
    """format("downloads"): contents of a few urls given as an option; for a table of urls see `download`. Options: urls (a JSON list), max_bytes, attempts, partitions, allow_private."""

    @classmethod
    def name(cls) -> str:
        return "downloads"

    def schema(self) -> str:
        return "url string, status int, content binary, error string"

    def reader(self, schema: object) -> DataSourceReader:
        return _DownloadsReader(dict(self.options))


class _DownloadsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        urls = json.loads(self.o.get("urls", "[]"))
        n = max(1, min(int(self.o.get("partitions", 16)), len(urls)))
        return [QueryPartition(str(k), {"urls": urls[k::n]}) for k in range(n)]

    def read(self, partition: QueryPartition) -> Iterator[tuple]:
        safe = (lambda _: True) if self.o.get("allow_private") == "true" else is_safe
        for url in partition.params["urls"]:
            status, body, error = fetch(url, attempts=int(self.o.get("attempts", 4)), max_bytes=int(self.o.get("max_bytes", 15_000_000)), safe=safe, waits=DOWNLOAD_WAITS)
            yield url, status, body if error is None else None, error


def download(df: DataFrame, *, url_col: str = "url", attempts: int = 4, max_bytes: int = 15_000_000, allow_private: bool = False) -> DataFrame:
    """(url, status, content, error) of the urls of a table: fetched in the tasks that hold them, a batch for each file. Null urls are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        safe = (lambda _: True) if allow_private else is_safe
        for b in batches:
            for url in b.column(0).to_pylist():
                status, body, error = fetch(url, attempts=attempts, max_bytes=max_bytes, safe=safe, waits=DOWNLOAD_WAITS)
                columns = [pa.array([url], pa.string()), pa.array([status], pa.int32()), pa.array([body if error is None else None], pa.binary()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["url", "status", "content", "error"])

    return df.where(df[f"`{url_col}`"].isNotNull()).select(df[f"`{url_col}`"].alias("url")).mapInArrow(run, "url string, status int, content binary, error string")


def register(spark) -> None:  # noqa: ANN001
    spark.dataSource.register(JsonPages)
    spark.dataSource.register(Downloads)
