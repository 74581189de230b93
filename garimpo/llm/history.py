"""Problem 6: new batches against all accepted history, by sharded small-world graphs.

Every row has up to two keys: its content hash and its canonical url. A key is
placed on a line by its 64-bit hash; equal keys are points at distance 0, so
"seen before" is a nearest-neighbour search with an exact comparison after it.

* The index is stored in a folder: a list of shards, and each shard's graphs. It
  is opened from the list alone. A batch reads its own rows and the graphs, never
  the rows of the history, and leaves one new shard, of its accepted rows.
* A shard is the navigable small-world graph of its keys, cut into parts by the
  leading bits of the point so that no part outgrows a task. Nodes link to their
  neighbours and, by Kleinberg's rule, to distant nodes with a probability
  inverse to the distance. Since neighbours are always linked, a greedy walk
  can't end anywhere but at the nearest point.
* A search walks all queries of a part at once, with a beam; while the shard is
  built, the beam is widened until a sample of searches agrees with exhaustive
  search. Queries go to the graphs: packed by part and sent to all tasks while
  they are few, else joined with the graphs by part.
* Found nodes are reranked exactly: 128 bits of the key must be equal, and the
  earliest accepted row of equal ones is taken.
* Shards have levels by size. When more than `fanout` shards of a level have
  gathered they are compacted into one of the next level, so a batch searches a
  logarithmic number of shards.
* Repeats within a batch, which no shard holds yet: the first open row of all
  its keys is accepted, which equals taking rows one by one. A few rounds settle
  groups of any size at once; what is left are chains, taken one by one within
  their connected components.

Groups of copies: a batch's keys are made distinct (map-side partial minima)
before the search, and a shard holds each key once, so a key shared by a third
of all rows is one query and one node.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import once
from ..session import work_dir
from .common import materialize, pick
from .near_dup import connected_groups

# Parameters that track a visit or carry a session, as patterns for the whole lower-cased name.
TRACKING = [
    "utm_.*", "fbclid", "gclid", "dclid", "gbraid", "wbraid", "msclkid", "yclid", "twclid", "ttclid", "igshid", "li_fat_id",
    "mc_cid", "mc_eid", "_ga", "_gl", "_gac", "_hsenc", "_hsmi", "mkt_tok", "vero_id", "oly_anon_id", "oly_enc_id", "_openstat", "pk_.*", "mtm_.*",
    "sid", "s_id", "sess", "sessid", "session", "sessionid", "session_id", "phpsessid", "jsessionid", "aspsessionid.*", "cfid", "cftoken", "oscsid", "zenid",
]
_TRACKED = "^(" + "|".join(TRACKING) + ")$"
LINKS = 6
PART_NODES = 50_000
# Query keys up to this number (16 MB) are sent to all tasks; beyond it they are joined with the graphs by part.
BROADCAST_KEYS = 1_000_000
# Up to so many key rows (2.4 MB) repeats within a batch are taken one by one in a task; beyond it rounds settle most of them first.
CONTESTED = 100_000
ROUNDS = 3
_GRAPH = "part long, beam int, points binary, starts binary, checks binary, ids binary, far binary"


def _unescape(text: Column, keep: str) -> Column:
    """Percent-decoded UTF-8, but for the escapes of `keep`; as it was if it doesn't decode."""
    guarded = F.regexp_replace(F.regexp_replace(text, r"\+", "%2B"), f"(?i)%({keep})", "%25$1")
    out = F.try_url_decode(guarded)
    return F.when(~text.contains("%"), text).when(out.isNull() | out.contains("�"), text).otherwise(out)


def _clean(url: Column) -> Column:
    clean = F.regexp_replace(url, r"^[\s ﻿]+|[\s ﻿]+$", "")
    return F.regexp_replace(F.regexp_replace(clean, "(?s)#.*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*:(?=//)", "")


def _host(clean: Column) -> Column:
    host = F.lower(F.regexp_extract(clean, "^//([^/?]*)", 1))
    return F.regexp_replace(F.regexp_replace(host, r"\.?(:(80|443)?)?$", ""), r"^(.*@)?www\.", "")


def _rest(clean: Column) -> Column:
    return F.regexp_replace(clean, "^//[^/?]*", "")


def _steps(rest: Column) -> Column:
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^?]*", 0), r"(?i);[^/;=]*(sess|sid)[^/;=]*=[^/;]*", "")
    return F.split(_unescape(path, "2f|25|3f|23"), "/")


def _params(rest: Column) -> Column:
    query = F.split(F.regexp_replace(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), r"\+", "%20"), "&")
    kept = F.filter(query, lambda p: (p != "") & ~F.lower(_unescape(F.regexp_extract(p, "(?s)^[^=]*", 0), "26|3d|25")).rlike(_TRACKED))
    return F.array_join(F.array_sort(F.transform(kept, lambda p: _unescape(p, "26|3d|25"))), "&")


def _spelled(url: Column, host: Column, steps: Column, params: Column) -> Column:
    walked = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s.isin("", "."), done).when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, s)),
    )
    return F.when(url.isNotNull(), F.concat(host, F.lit("/"), F.array_join(walked, "/"), F.lit("?"), params))


def file_url(url: Column) -> Column:
    """One spelling for all urls of a file; null for null.

    Dropped or unified: outer blanks, scheme, fragment, case of the host, a
    leading `www.`, default ports, a host's last dot, percent escapes, empty and
    dot segments of the path, a trailing slash, the order of parameters,
    tracking and session parameters (in the query or, after `;`, in the path).
    """
    rest = _rest(_clean(url))
    return _spelled(url, _host(_clean(url)), _steps(rest), _params(rest))


def with_file_url(df: DataFrame, url: str, name: str) -> DataFrame:
    """df with `file_url` of a column as column `name`, each step of it computed once a row."""
    beside = df.columns
    df = once(df, beside, __clean=_clean(F.col(url)))
    df = once(df, [*beside], __host=_host(F.col("__clean")), __rest=_rest(F.col("__clean")))
    df = once(df, [*beside, "__host"], __steps=_steps(F.col("__rest")), __params=_params(F.col("__rest")))
    return once(df, beside, **{name: _spelled(F.col(url), F.col("__host"), F.col("__steps"), F.col("__params"))})


def content_key(content_hash: Column, content_length: Column) -> Column:
    """The hash in one spelling (no algorithm name, no blanks, lower case); null if empty or of no content."""
    clean = F.regexp_replace(F.lower(F.regexp_replace(content_hash, r"[\s-]", "")), "^(0x|sha-?256[:=])", "")
    return F.when((clean != "") & (content_length.isNull() | (content_length != 0)), clean)


# ---------------------------------------------------------------- graphs


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(a, b) - np.minimum(a, b)


def build_links(n: int, rng: np.random.Generator, count: int = LINKS) -> np.ndarray:
    """n rows of links of sorted points: both neighbours and `count` distant ones, harmonic in rank distance."""
    at = np.arange(n)
    far = np.exp(rng.random((n, count)) * np.log(max(n, 2))).astype(np.int64)
    far = at[:, None] + far * rng.choice((-1, 1), (n, count))
    return np.concatenate([np.clip(at - 1, 0, None)[:, None], np.clip(at + 1, None, n - 1)[:, None], np.clip(far, 0, n - 1)], axis=1).astype(np.int32)


def beam_search(points: np.ndarray, links: np.ndarray, wanted: np.ndarray, beam: int) -> np.ndarray:
    """For each wanted point the nearest nodes, best first, by walks over the graph from its middle."""
    n = len(points)
    beam = min(beam, n)
    now = np.repeat(np.linspace(0, n - 1, beam + 2)[1:-1].astype(np.int64)[None, :], len(wanted), axis=0)
    result = np.empty_like(now)
    alive = np.arange(len(wanted))
    while len(alive):
        reach = np.concatenate([now, links[now].reshape(len(now), -1)], axis=1)
        if beam > 1:
            reach.sort(axis=1)
        d = _distance(points[reach], wanted[alive, None])
        if beam > 1:
            d[:, 1:][reach[:, 1:] == reach[:, :-1]] = np.iinfo(np.uint64).max
            order = np.argsort(d, axis=1, kind="stable")[:, :beam]
        else:
            order = np.argmin(d, axis=1)[:, None]
        after = np.take_along_axis(reach, order, axis=1)
        done = (after == now).all(axis=1)
        result[alive[done]] = after[done]
        alive, now = alive[~done], after[~done]
    return result


def tuned_beam(points: np.ndarray, links: np.ndarray, rng: np.random.Generator, *, sample: int = 64, recall: float = 1.0) -> int:
    """The narrowest beam (doubled from 1) that agrees with exhaustive search on stored and on random points."""
    asked = np.concatenate([rng.choice(points, min(sample, len(points))), rng.integers(points[0], points[-1], sample, dtype=np.uint64, endpoint=True)])
    best = np.array([_distance(points, q).min() for q in asked])
    beam = 1
    while beam < len(points):
        got = _distance(points[beam_search(points, links, asked, beam)[:, 0]], asked)
        if (got == best).mean() >= recall:
            break
        beam *= 2
    return beam


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False).view(np.uint64)


def _build(key: tuple, table: pa.Table) -> pa.Table:
    """The graph row of one part. A node is a distinct point; starts tells where its keys lie (one, unless hashes collide)."""
    points, checks, ids = _unsigned(table["point"]), _unsigned(table["check"]), table["id"].to_numpy()
    order = np.lexsort((ids, checks, points))
    points, checks, ids = points[order], checks[order], ids[order]
    nodes, starts = np.unique(points, return_index=True)
    rng = np.random.default_rng(len(nodes))
    links = build_links(len(nodes), rng)
    row = {"part": key[0].as_py(), "beam": tuned_beam(nodes, links, rng), "points": nodes.tobytes(), "starts": np.append(starts, len(points)).astype(np.int32).tobytes(), "checks": checks.tobytes(), "ids": ids.tobytes(), "far": links[:, 2:].tobytes()}
    return pa.Table.from_pylist([row], schema=pa.schema([("part", pa.int64()), ("beam", pa.int32()), *((k, pa.binary()) for k in ("points", "starts", "checks", "ids", "far"))]))


def _graph(g: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(points, links, starts, checks, ids) of a stored graph; links to neighbours aren't stored."""
    points = np.frombuffer(g["points"], np.uint64)
    at = np.arange(len(points), dtype=np.int32)
    far = np.frombuffer(g["far"], np.int32).reshape(len(points), -1)
    links = np.concatenate([np.maximum(at - 1, 0)[:, None], np.minimum(at + 1, len(points) - 1)[:, None], far], axis=1)
    return points, links, np.frombuffer(g["starts"], np.int32), np.frombuffer(g["checks"], np.uint64), np.frombuffer(g["ids"], np.int64)


def _search(g: dict, wanted: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, checks, ids) of the queries (wanted points, asked checks) that a graph holds."""
    points, links, starts, checks, ids = _graph(g)
    node = beam_search(points, links, wanted, g["beam"])[:, 0]
    near = np.nonzero(points[node] == wanted)[0]
    found = []
    # exact rerank of the keys of the node: the second hash must be equal too
    low, high = starts[node[near]], starts[node[near] + 1]
    for shift in range(int((high - low).max(initial=0))):
        there = low + shift < high
        entry, q = low[there] + shift, near[there]
        equal = checks[entry] == asked[q]
        found.append((q[equal], ids[entry[equal]]))
    q = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
    return wanted[q], asked[q], np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)


class HistoryIndex:
    """Stored keys in graph shards: search() them, add() a batch's accepted keys; shards are compacted on schedule.

    Keys are rows (id, point, check). The list of shards is one small file that
    is replaced as a whole, so a lost driver leaves the last complete index; a
    path that holds one is opened, and its shards are read only when searched.
    """

    def __init__(self, part_bits: int | None = None, *, fanout: int = 4, path: str | None = None, spark: SparkSession | None = None, part_nodes: int = PART_NODES):
        self.part_bits, self.fanout, self.part_nodes, self.path = part_bits, fanout, part_nodes, path
        self.shards: list[dict] = []
        self.last: int | None = None
        if path is not None and spark is not None:
            known = self._read(spark)
            if known:
                self.shards, self.last = known["shards"], known["last"]

    # the list of shards

    def _files(self, spark: SparkSession) -> tuple:
        jvm = spark.sparkContext._jvm
        where = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where, where("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, spark: SparkSession) -> dict | None:
        where, files = self._files(spark)
        if not files.exists(where("shards.json")):
            return None
        return json.loads("".join(r.value for r in spark.read.text(f"{self.path}/shards.json").collect()))

    def _write(self, spark: SparkSession) -> None:
        where, files = self._files(spark)
        out = files.create(where("shards.new"), True)
        out.write(bytearray(json.dumps({"shards": self.shards, "last": self.last}).encode()))
        out.close()
        files.delete(where("shards.json"), False)
        files.rename(where("shards.new"), where("shards.json"))

    @property
    def levels(self) -> list[list[dict]]:
        top = max((s["level"] for s in self.shards), default=-1)
        return [[s for s in self.shards if s["level"] == k] for k in range(top + 1)]

    # shards

    def _graphs(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(_GRAPH).parquet(f"{self.path}/{name}")

    def _put(self, keys: DataFrame, level: int | None) -> None:
        once_ = materialize(keys.groupBy("point", "check").agg(F.min("id").alias("id")), "shard-keys")
        n = once_.count()
        if not n:
            return
        bits = self.part_bits if self.part_bits is not None else max(0, math.ceil(math.log2(max(1, n / self.part_nodes))))
        part = F.shiftrightunsigned("point", 64 - bits) if bits else F.lit(0).cast("long")
        name = f"shard-{uuid.uuid4().hex[:12]}"
        once_.withColumn("part", part).groupBy("part").applyInArrow(_build, _GRAPH).write.parquet(f"{self.path}/{name}")
        size = max(0, int(math.log(max(1, n / self.part_nodes), self.fanout)))
        self.shards.append({"name": name, "level": size if level is None else max(level, size), "keys": n, "bits": bits})

    def add(self, keys: DataFrame, segment: int | None = None) -> None:
        """A new shard of a batch's accepted keys, then compaction where it is due."""
        spark = keys.sparkSession
        if self.path is None:
            self.path = f"{work_dir(spark)}/garimpo/history-{uuid.uuid4().hex[:12]}"
        self._put(keys, None)
        self.last = segment if segment is not None else self.last
        self._write(spark)
        for level, shards in enumerate(self.levels):
            if len(shards) > self.fanout:
                self.compact(spark, level)

    def compact(self, spark: SparkSession, level: int) -> None:
        """The shards of a level as one of the next; the old ones are deleted once the list no longer names them."""
        old = self.levels[level]

        def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for g in b.to_pylist():
                    points, _, starts, checks, ids = _graph(g)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(points, np.diff(starts)).view(np.int64)), pa.array(checks.view(np.int64)), pa.array(ids)], names=["point", "check", "id"])

        merged = self._graphs(spark, old[0]["name"])
        for other in old[1:]:
            merged = merged.unionByName(self._graphs(spark, other["name"]))
        self._put(merged.mapInArrow(nodes, "point long, check long, id long"), level + 1)
        self.shards = [s for s in self.shards if s not in old]
        self._write(spark)
        where, files = self._files(spark)
        for s in old:
            files.delete(where(s["name"]), True)

    def search(self, keys: DataFrame) -> DataFrame:
        """(point, check, accepted_id): the distinct keys that the index holds, with their first accepted row."""
        spark = keys.sparkSession
        hits = spark.createDataFrame([], "point long, check long, accepted_id long")
        asked = materialize(keys.select("point", "check").distinct(), "asked")
        few = asked.count() <= BROADCAST_KEYS

        def pack(key: tuple, table: pa.Table) -> pa.Table:
            return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "wanted": pa.array([_unsigned(table["point"]).tobytes()], pa.binary()), "asked": pa.array([_unsigned(table["check"]).tobytes()], pa.binary())})

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for g in b.to_pylist():
                    points, checks, ids = _search(g, np.frombuffer(g["wanted"], np.uint64), np.frombuffer(g["asked"], np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(points.view(np.int64)), pa.array(checks.view(np.int64)), pa.array(ids)], names=["point", "check", "accepted_id"])

        for bits in sorted({s["bits"] for s in self.shards}):
            part = F.shiftrightunsigned("point", 64 - bits) if bits else F.lit(0).cast("long")
            packed = asked.withColumn("part", part).groupBy("part").applyInArrow(pack, "part long, wanted binary, asked binary")
            graphs = None
            for s in self.shards:
                if s["bits"] == bits:
                    one = self._graphs(spark, s["name"])
                    graphs = one if graphs is None else graphs.unionByName(one)
            hits = hits.unionByName(graphs.join(F.broadcast(packed) if few else packed, "part").mapInArrow(walk, "point long, check long, accepted_id long"))
        return hits.groupBy("point", "check").agg(F.min("accepted_id").alias("accepted_id"))

    def report(self, spark: SparkSession) -> DataFrame:
        """(level, keys, parts, nodes, widest_beam) of each shard."""
        out = spark.createDataFrame([], "level int, keys long, parts long, nodes long, widest_beam int")
        for s in self.shards:
            g = self._graphs(spark, s["name"]).agg(F.count("*").alias("parts"), F.sum(F.octet_length("points") / 8).cast("long").alias("nodes"), F.max("beam").alias("widest_beam"))
            out = out.unionByName(g.select(F.lit(s["level"]).alias("level"), F.lit(s["keys"]).cast("long").alias("keys"), "parts", "nodes", "widest_beam"))
        return out


# ---------------------------------------------------------------- batches


def _first_wins(open_: DataFrame) -> DataFrame:
    """(duplicate_id, accepted_id) among rows (id, point, check) that share keys with each other.

    A row is accepted when it is the first open row for all its keys; rows that
    share a key with it are then duplicates. After ROUNDS rounds, or as soon as
    few are left, the open rows form chains, each repeating the one before. They
    are taken one by one, each connected component in a task that holds the keys
    of its accepted rows; a few rows are one component.
    """

    def one_by_one(key: tuple, table: pa.Table) -> pa.Table:
        held: dict[tuple[int, int], int] = {}
        rows: dict[int, list[tuple[int, int]]] = {}
        for id_, point, check in zip(*(table[c].to_pylist() for c in ("id", "point", "check"))):
            rows.setdefault(id_, []).append((point, check))
        pairs = []
        for id_ in sorted(rows):
            hits = [held[k] for k in rows[id_] if k in held]
            if hits:
                pairs.append((id_, min(hits)))
            else:
                held.update(dict.fromkeys(rows[id_], id_))
        return pa.table({"duplicate_id": pa.array([p[0] for p in pairs], pa.int64()), "accepted_id": pa.array([p[1] for p in pairs], pa.int64())})

    rows_ = open_
    found = open_.sparkSession.createDataFrame([], "duplicate_id long, accepted_id long")

    def settled(pairs: DataFrame) -> DataFrame:
        # a duplicate may also share a key with an earlier row that was accepted in a later round
        gone = pairs.select(F.col("duplicate_id").alias("id"))
        held = rows_.join(gone, "id", "left_anti").select("point", "check", F.col("id").alias("accepted_id"))
        return rows_.join(gone, "id", "left_semi").join(held, ["point", "check"]).where("accepted_id < id").groupBy(F.col("id").alias("duplicate_id")).agg(F.min("accepted_id").alias("accepted_id"))

    for turn in range(ROUNDS):
        if open_.count() <= CONTESTED:
            last = found.unionByName(open_.groupBy(F.lit(0).alias("group")).applyInArrow(one_by_one, "duplicate_id long, accepted_id long"))
            return settled(last) if turn else last
        first = open_.groupBy("point", "check").agg(F.min("id").alias("first"))
        winners = open_.join(first, ["point", "check"]).groupBy("id").agg(F.min((F.col("id") == F.col("first")).cast("int")).alias("wins")).where("wins = 1").select("id")
        won = open_.join(winners, "id").select("point", "check", F.col("id").alias("winner"))
        state = open_.join(won, ["point", "check"], "left").groupBy("id").agg(F.min("winner").alias("winner"))
        state = materialize(state, "state")
        pairs = state.where("id > winner").select(F.col("id").alias("duplicate_id"), F.col("winner").alias("accepted_id"))
        found = found.unionByName(pairs)
        rest = state.where("winner IS NULL").select("id")
        if not rest.head(1):
            return settled(found)
        open_ = materialize(open_.join(rest, "id", "left_semi"), "open")
    edges = open_.join(open_.groupBy("point", "check").agg(F.min("id").alias("b")), ["point", "check"]).select(F.col("id").alias("a"), "b").where("a <> b").distinct()
    groups = connected_groups(edges)

    return settled(found.unionByName(open_.join(groups, "id").groupBy("group").applyInArrow(one_by_one, "duplicate_id long, accepted_id long")))


def keyed_rows(downloads: DataFrame, candidates: DataFrame, *, after: int | None = None, id_col: str = "download_id", candidate_col: str = "candidate_id", batch_col: str = "batch_no", hash_col: str = "content_hash", length_col: str = "content_length", url_col: str = "url") -> DataFrame:
    """(id, segment, point, check), a row for each key of the rows of segments beyond `after`; see duplicates_of_history."""
    d = pick(downloads, id=id_col, candidate=candidate_col, batch=batch_col, hash=hash_col, length=length_col).where("id IS NOT NULL")
    d = d.withColumn("segment", F.greatest(F.coalesce(F.col("batch"), F.lit(0)).cast("int"), F.lit(0)))
    if after is not None:
        d = d.where(F.col("segment") > after)
    c = pick(candidates, candidate=candidate_col, url=url_col).where("url IS NOT NULL AND candidate IS NOT NULL")
    joined = d.join(c, "candidate", "left").select(F.col("id").cast("long").alias("id"), "segment", content_key(F.col("hash"), F.col("length")).alias("content"), "url")
    return (
        with_file_url(joined, "url", "file")
        .select("id", "segment", F.explode(F.array_compact(F.array(F.concat(F.lit("h:"), "content"), F.concat(F.lit("u:"), "file")))).alias("key"))
        .select("id", "segment", F.xxhash64("key").alias("point"), F.xxhash64(F.lit("second"), "key").alias("check"))
    )


def repeats_of_batch(index: HistoryIndex, batch: DataFrame, segment: int) -> DataFrame | None:
    """(accepted_id, duplicate_id) of a batch's rows (id, point, check), and the batch added to the index; None for segment 0, which is accepted as it is."""
    if segment == 0:
        index.add(batch, segment)
        return None
    known = batch.join(index.search(batch), ["point", "check"]).groupBy(F.col("id").alias("duplicate_id")).agg(F.min("accepted_id").alias("accepted_id"))
    result = known = materialize(known, "known")
    fresh = batch.join(known, F.col("id") == F.col("duplicate_id"), "left_anti")
    contested = fresh.groupBy("point", "check").agg((F.min("id") < F.max("id")).alias("several")).where("several").select("point", "check")
    involved = materialize(fresh.join(contested, ["point", "check"], "left_semi").select("id").distinct(), "involved")
    if involved.head(1):
        # all keys of the rows involved: a row that loses by one key frees its other ones
        inside = materialize(_first_wins(materialize(fresh.join(involved, "id", "left_semi").select("id", "point", "check").distinct(), "contested")), "inside")
        result = known.unionByName(inside.select(*known.columns))
        fresh = fresh.join(inside, F.col("id") == F.col("duplicate_id"), "left_anti")
    index.add(fresh, segment)
    return result.select("accepted_id", "duplicate_id")


def duplicates_of_history(
    downloads: DataFrame,
    candidates: DataFrame,
    *,
    path: str | None = None,
    part_nodes: int = PART_NODES,
    fanout: int = 4,
    index: HistoryIndex | None = None,
    **columns: str,
) -> DataFrame:
    """(accepted_id, duplicate_id): rows of batches >= 1 that repeat an earlier accepted row.

    Batches are taken in order, rows within a batch by id. Batch 0, null batch
    numbers included, is accepted history. A duplicate isn't accepted, so its
    own keys never make another row a duplicate. If several accepted rows match,
    the earliest is given. Null hashes, hashes of no content and null urls are no
    keys; a row without keys is accepted. Rows of null id are left out; a
    candidate id that isn't in `candidates` has no url.

    With path, the index stored there is opened, only batches later than its last
    one are read, and their repeats are returned; else a new index is made in the
    session's shared folder. columns: see keyed_rows.
    """
    spark = downloads.sparkSession
    index = index or HistoryIndex(fanout=fanout, path=path, spark=spark, part_nodes=part_nodes)
    folder = f"{work_dir(spark)}/garimpo/keys-{uuid.uuid4().hex[:12]}"
    # by segment, so that a batch reads its own rows only
    keyed_rows(downloads, candidates, after=index.last, **columns).write.partitionBy("segment").parquet(folder)
    keys = spark.read.schema("id long, point long, check long, segment int").parquet(folder)
    result = spark.createDataFrame([], "accepted_id long, duplicate_id long")
    for segment in [r.segment for r in keys.select("segment").distinct().orderBy("segment").collect()]:
        pairs = repeats_of_batch(index, keys.where(F.col("segment") == segment).drop("segment"), segment)
        result = result if pairs is None else result.unionByName(pairs)
    return result


def recall(index: HistoryIndex, keys: DataFrame, held: DataFrame) -> DataFrame:
    """One row: keys asked for, those held by exhaustive search (a join with the rows `held`), and those the index finds."""
    asked = keys.select("point", "check").distinct()
    exact = asked.join(held.select("point", "check").distinct(), ["point", "check"], "left_semi")
    return exact.join(index.search(keys).withColumn("hit", F.lit(True)), ["point", "check"], "left").agg(F.count("*").alias("held"), F.count_if("hit").alias("found"))
