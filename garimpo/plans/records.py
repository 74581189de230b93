"""API records with their documents to candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import caps, dedup, joins

# Names of the candidate's metadata fields and where they come from.
RECORD_FIELDS = {
    "numeroControlePNCP": "numero_controle_pncp", "anoCompra": "ano_compra", "sequencialCompra": "sequencial_compra", "numeroCompra": "numero_compra",
    "dataPublicacaoPncp": "data_publicacao_pncp", "dataAberturaProposta": "data_abertura_proposta", "dataEncerramentoProposta": "data_encerramento_proposta",
    "situacaoCompraId": "situacao_compra_id", "situacaoCompraNome": "situacao_compra_nome", "dataAtualizacaoGlobal": "data_atualizacao_global",
    "dataAtualizacao": "data_atualizacao", "modalidadeId": "modalidade_id", "modalidadeNome": "modalidade_nome", "srp": "srp",
    "linkSistemaOrigem": "link_sistema_origem", "linkProcessoEletronico": "link_processo_eletronico",
}
BLANK_FIELDS = {"objetoCompra": "objeto_compra", "processo": "processo", "informacaoComplementar": "informacao_complementar"}
NESTED_FIELDS = {"cnpj": "orgao_entidade.cnpj", "municipioNome": "unidade_orgao.municipio_nome", "ufSigla": "unidade_orgao.uf_sigla"}
# Calls for each scope, and the codes that two of the three endpoints need.
ENDPOINTS = ["proposal", "publication", "update"]
MODALITIES = [6, 8, 4]


def in_window(now: Column, *, year: Column, status: Column, opening: Column, deadline: Column, least_year: int, drop_expired: bool = True) -> Column:
    """Whether a record is open at an instant.

    Year at least least_year (null is not); status null or unreadable passes, else
    it must be 1; with drop_expired the deadline must be readable and later, and
    the opening, if readable, not later than now.
    """
    keep = F.coalesce(year.try_cast("int") >= least_year, F.lit(False)) & F.coalesce(status.try_cast("int") == 1, F.lit(True))
    if drop_expired:
        keep = keep & F.coalesce(dates.parse_datetime(deadline) > now, F.lit(False)) & F.coalesce(dates.parse_datetime(opening) <= now, F.lit(True))
    return keep


def can_look_up(control: Column, sequence: Column, year: Column) -> Column:
    return (F.trim(F.coalesce(control, F.lit(""))) != "") & sequence.isNotNull() & year.isNotNull()


def scans(scopes: DataFrame) -> DataFrame:
    """(scan_no, scope, endpoint, modality) of a run: for each scope (scope_no, scope) one proposal scan, then for each modality a publication and an update scan."""
    spark = scopes.sparkSession
    kinds = [(0, "proposal", None)] + [(1 + 2 * k + i, e, m) for k, m in enumerate(MODALITIES) for i, e in enumerate(ENDPOINTS[1:])]
    table = spark.createDataFrame(kinds, "kind_no int, endpoint string, modality int")
    return joins.parameter_product(scopes, table).select((F.col("scope_no") * len(kinds) + F.col("kind_no")).alias("scan_no"), "scope", "endpoint", "modality")


def metadata(document: dict[str, str] | None = None) -> Column:
    """The 26 metadata fields as a struct; texts of three fields default to ""."""
    d = {"sequencial_documento": "sequencial_documento", "tipo_documento_nome": "tipo_documento_nome", "titulo": "titulo"} | (document or {})
    fields = [F.col(c).alias(n) for n, c in RECORD_FIELDS.items()]
    fields += [F.coalesce(F.col(c), F.lit("")).alias(n) for n, c in BLANK_FIELDS.items()]
    fields += [F.col(c).alias(n) for n, c in NESTED_FIELDS.items()]
    fields += [
        F.col(d["sequencial_documento"]).alias("sequencialDocumento"),
        F.col(d["tipo_documento_nome"]).alias("tipoDocumentoNome"),
        F.coalesce(F.col(d["titulo"]), F.lit("")).alias("titulo"),
        text.document_priority(F.col(d["tipo_documento_nome"]), F.col(d["titulo"])).alias("priority"),
    ]
    return F.struct(*fields)


def select_documents(documents: DataFrame, *, key: str, seq: str) -> DataFrame:
    """Preferred documents, the first of each url within its record, with priority and place (1 for the first by priority, then by seq)."""
    from pyspark.sql import Window

    kept = documents.where(text.is_preferred_document(F.col("tipo_documento_nome"), F.col("titulo")))
    first = dedup.keep_first(kept, [key, "url"], seq)
    order = Window.partitionBy(key).orderBy("priority", seq)
    return first.withColumn("priority", text.document_priority(F.col("tipo_documento_nome"), F.col("titulo"))).withColumn("place", F.row_number().over(order))


def latest_records(records: DataFrame) -> DataFrame:
    return dedup.keep_latest(records, "numero_controle_pncp", ["data_atualizacao_global", "data_atualizacao"], "seq")


def candidates(records: DataFrame, documents: DataFrame, *, now: Column, least_year: int, modalities: list[int] | None = None, lookups: int | None = None, failed: DataFrame | None = None, failures: int = 10, most: int | None = None) -> DataFrame:
    """(record_seq, place, url, kind, metadata): latest records of the modalities that are open, joined with their selected documents; a url counts once.

    lookups caps the records whose documents are looked up, in order of
    discovery; records that can't be looked up don't use it up. failed holds the
    control numbers whose lookup failed: after `failures` of them in a row the
    run looks up no more. most caps the candidates.
    """
    wanted = records.where(F.col("modalidade_id").isin(modalities or MODALITIES))
    open_ = latest_records(wanted).where(
        in_window(now, year=F.col("ano_compra"), status=F.col("situacao_compra_id"), opening=F.col("data_abertura_proposta"), deadline=F.col("data_encerramento_proposta"), least_year=least_year)
        & can_look_up(F.col("numero_controle_pncp"), F.col("sequencial_compra"), F.col("ano_compra"))
    )
    open_ = caps.cap(open_, lookups, "first_seq")
    if failed is not None:
        bad = failed.select(F.col("numero_controle_pncp").alias("__control")).distinct().withColumn("__failed", F.lit(True))
        tried = open_.join(bad, F.col("numero_controle_pncp") == F.col("__control"), "left")
        open_ = caps.stop_after_streak(tried, failures, F.coalesce("__failed", F.lit(False)), "first_seq", []).where("__failed IS NULL").drop("__control", "__failed", "streak")
    docs = documents.withColumn("doc_order", F.struct("seen_at", "sequencial_documento"))
    chosen = select_documents(docs, key="numero_controle_pncp", seq="doc_order").drop("priority", "doc_order")
    both = joins.dependent(open_, chosen, {"numero_controle_pncp": "numero_controle_pncp"}).where(F.trim(F.coalesce("url", F.lit(""))) != "")
    rows = both.select(F.col("first_seq").alias("record_seq"), "place", F.trim("url").alias("url"), F.lit("pdf").alias("kind"), metadata().alias("metadata"), F.struct("first_seq", "place").alias("order"))
    return caps.cap(dedup.keep_first(rows, ["url"], "order"), most, "order").drop("order")
