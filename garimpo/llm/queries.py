"""The queries of the problems, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding, history, language, mixing, near_dup, ocr_noise, packing, residue, tokens, truncation

from .common import materialize

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, members = near_dup.near_duplicate_pairs(
        _table(spark, sf_dir, "worker_results"), id_col="result_id", text_col="ocr_markdown", words=3, threshold=0.6
    )
    return near_dup.expand_pairs(pairs, members)


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_dup.near_duplicate_groups(
        _table(spark, sf_dir, "worker_results"), id_col="result_id", text_col="ocr_markdown", words=3, threshold=0.6
    )
    return groups.withColumnRenamed("id", "result_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoding.garbled_records(_table(spark, sf_dir, "worker_results"), id_col="result_id", text_col="ocr_markdown")
    return found.select(F.col("id").alias("result_id"))


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = encoding.restored_records(_table(spark, sf_dir, "worker_results"), id_col="result_id", text_col="ocr_markdown")
    return restored.withColumnRenamed("id", "result_id")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text", lang_col="lang")
    return language.segment_languages(_table(spark, sf_dir, "worker_results"), model, id_col="result_id", text_col="ocr_markdown", label_col="lang_label")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = language.mislabelled(_judged(spark, sf_dir))
    return cases.select(F.col("id").alias("result_id"), F.col("segment_no").cast("bigint").alias("segment_no"), "lang")


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every looked-at segment with its language and confidence, and its record's."""
    return _judged(spark, sf_dir).withColumnRenamed("id", "result_id")


def _truncated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return truncation.truncated(_table(spark, sf_dir, "worker_results"), _table(spark, sf_dir, "candidates"), id_col="result_id", text_col="ocr_markdown")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = _truncated(spark, sf_dir)
    return records.where("truncated").select(F.col("id").alias("result_id")).distinct()


def p4_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates."""
    records, _ = _truncated(spark, sf_dir)
    return truncation.truncation_by_source(records)


def p4_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hidden storage limits of the sources."""
    _, limits = _truncated(spark, sf_dir)
    return limits.drop("at")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr_noise.noise_kinds(_table(spark, sf_dir, "worker_results"), id_col="result_id", text_col="ocr_markdown").withColumnRenamed("id", "result_id")


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr_noise.repaired(_table(spark, sf_dir, "worker_results"), id_col="result_id", text_col="ocr_markdown").withColumnRenamed("id", "result_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.duplicates_of_history(_table(spark, sf_dir, "downloads"), _table(spark, sf_dir, "candidates"))


def p6_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index after all batches: keys of the last batch held by exhaustive search, those the graphs find, shards and their widest beam."""
    downloads, candidates = _table(spark, sf_dir, "downloads"), _table(spark, sf_dir, "candidates")
    index = history.HistoryIndex()
    history.duplicates_of_history(downloads, candidates, index=index)
    shards = index.report(spark).agg(F.count("*").alias("shards"), F.max("level").alias("top_level"), F.sum("keys").alias("keys"), F.max("widest_beam").alias("widest_beam"))
    rows = materialize(history.keyed_rows(downloads, candidates), "all-keys")
    repeats = history.duplicates_of_history(downloads, candidates).select(F.col("duplicate_id").alias("id"))
    return history.recall(index, rows.where("segment = 8"), rows.join(repeats, "id", "left_anti")).crossJoin(shards)


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = tokens.token_counts(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text")
    return packing.pack(sizes, _table(spark, sf_dir, "container_sizes"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A container for every document, or piece of one, and kind of container."""
    return _packed(spark, sf_dir).withColumnRenamed("id", "doc_id")


def p7_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unused space of each kind of container."""
    return packing.packing_report(_packed(spark, sf_dir))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = tokens.token_counts(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text", more={"source": "source"})
    return mixing.mix(sizes, _table(spark, sf_dir, "source_weights"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents with their copies."""
    return _mixed(spark, sf_dir).withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixing.share_report(materialize(_mixed(spark, sf_dir), "mix"), _table(spark, sf_dir, "source_weights"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = residue.flagged(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text")
    return found.select(F.col("id").alias("doc_id")).distinct()


def p9_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.flagged(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text").withColumnRenamed("id", "doc_id")


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without the flagged documents."""
    return residue.without_residue(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text")


QUERIES = [p1_found, p1_groups, p2_found, p2_restored, p3_found, p3_segments, p4_found, p4_sources, p4_limits, p5_found, p5_repaired, p6_found, p6_recall, p7_containers, p7_unused, p8_mix, p8_shares, p9_found, p9_reasons, p9_clean]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}


P1_SQL = """
with w as (select result_id as id, regexp_extract_all(lower(ocr_markdown), '[\\p{L}\\p{N}]+') as ws from worker_results where ocr_markdown is not null),
g as (select distinct id, hash(ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) as h from w, unnest(range(1, len(ws) - 1)) r(i) where len(ws) >= 3),
n as (select id, count(*) as n from g group by id),
c as (select a.id as id_a, b.id as id_b, count(*) as common from g a join g b on a.h = b.h and a.id < b.id group by all)
select id_a, id_b from c join n x on x.id = id_a join n y on y.id = id_b where common >= 0.6 * (x.n + y.n - common)
"""


P1_GROUPS_SQL = """
with recursive w as (select result_id as id, regexp_extract_all(lower(ocr_markdown), '[\\p{L}\\p{N}]+') as ws from worker_results where ocr_markdown is not null),
g as (select distinct id, hash(ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) as h from w, unnest(range(1, len(ws) - 1)) r(i) where len(ws) >= 3),
sets as (select id, count(*) as n, list_sort(list(h)) as s from g group by id),
m as (select id, n, min(id) over (partition by s) as class_id from sets),
r as (select g.id, g.h from g join m on m.id = g.id and m.id = m.class_id),
c as (select a.id as a, b.id as b, count(*) as common from r a join r b on a.h = b.h and a.id < b.id group by all),
p as (select a, b from c join m x on x.id = a join m y on y.id = b where common >= 0.6 * (x.n + y.n - common)),
e as (select a, b from p union all select b, a from p),
t(id, grp) as (select class_id, class_id from m union select t.id, e.b from t join e on e.a = t.grp),
k as (select id, min(grp) as group_id from t group by id),
d as (select a, count(*) as links from e group by a)
select m.id as result_id, m.class_id, k.group_id, cast(coalesce(d.links, 0) as bigint) as links from m join k on k.id = m.class_id left join d on d.a = m.class_id
"""


def _decoded(text: str, keep: str) -> str:
    """SQL: percent escapes decoded but for those of keep."""
    return f"case when contains({text}, '%') then url_decode(regexp_replace(replace({text}, '+', '%2B'), '%({keep})', '%25\\1', 'gi')) else {text} end"


_PAGE = "case when x in ('', '.') then acc when x = '..' then regexp_replace(acc, '/[^/]*$', '') else acc || '/' || x end"
P6_SQL = f"""
with recursive c as (select candidate_id, regexp_replace(regexp_replace(regexp_replace(url, '^[\\s\ufeff\u00a0]+|[\\s\ufeff\u00a0]+$', '', 'g'), '#.*$', '', 's'), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '//') as url from candidates where url is not null),
p as (select candidate_id, regexp_replace(regexp_replace(lower(regexp_extract(url, '^//([^/?]*)', 1)), '[.]?(:(80|443)?)?$', ''), '^(.*@)?www[.]', '') as host, regexp_replace(url, '^//[^/?]*', '') as rest from c),
q as (select candidate_id, host, regexp_replace(regexp_extract(rest, '^[^?]*', 0, 's'), ';[^/;=]*(sess|sid)[^/;=]*=[^/;]*', '', 'gi') as path, string_split(replace(regexp_extract(rest, '[?](.*)$', 1, 's'), '+', '%20'), '&') as ps from p),
f as (select candidate_id, host || list_reduce(list_prepend('', string_split({_decoded("path", "2f|25|3f|23")}, '/')), lambda acc, x: {_PAGE}) || '?' || coalesce(list_aggregate(list_sort(list_transform(list_filter(ps, lambda x: x <> '' and not regexp_matches(lower(regexp_extract(x, '^[^=]*', 0)), '{history._TRACKED}')), lambda x: {_decoded("x", "26|3d|25")})), 'string_agg', '&'), '') as u from q),
o as (select download_id as id, greatest(coalesce(batch_no, 0), 0) as batch, 'u' || u as u,
    case when content_length is null or content_length <> 0 then 'h' || nullif(regexp_replace(lower(regexp_replace(content_hash, '[\\s-]', '', 'g')), '^(0x|sha-?256[:=])', ''), '') end as h from downloads left join f using (candidate_id)),
t as (select x from (select u as x from o union all select h from o) where x is not null group by x having count(*) > 1),
j as (select o.id, batch, tu.x as u, th.x as h from o left join t tu on tu.x = o.u left join t th on th.x = o.h where tu.x is not null or th.x is not null),
k as (select row_number() over (order by id) as n, * from j),
s(n, id, accepted_id, held) as (select cast(0 as bigint), cast(null as bigint), cast(null as bigint), cast([] as struct(k varchar, id bigint)[])
    union all select k.n, k.id, case when batch > 0 then list_min(list_transform(list_filter(held, lambda x: x.k = h or x.k = u), lambda x: x.id)) end,
    case when batch > 0 and len(list_filter(held, lambda x: x.k = h or x.k = u)) > 0 then held else held || list_filter([struct_pack(k := h, id := k.id), struct_pack(k := u, id := k.id)], lambda x: x.k is not null) end
    from s join k on k.n = s.n + 1)
select accepted_id, id as duplicate_id from s where accepted_id is not null
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p1_groups": P1_GROUPS_SQL, "p6_found": P6_SQL}
