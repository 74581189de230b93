"""Text predicates and scalars: accent folding, notice policy, document kinds, hashes, truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that exclude a file from being a notice.
EXCLUSIONS = [
    "relatorio", "resultado", "lista.?de", "manual", "instrucao", "modelo.?de", "formulario", "termo.?de.?referencia",
    "ata.?de", "retificacao", "errata", "credenciamento.?(de.?(fornecedor|jornalista|banco))",
]
REFERENCE_TERMS = "termo.?de.?referencia"
POLICIES = ("default", "include_tdr", "no_prefilter")
# Document kinds by token, in order of preference.
PRIORITIES = [("edital", 10), ("aviso de contratação direta", 20), ("aviso de contratacao direta", 20), ("termo de referência", 30), ("termo de referencia", 30)]
OTHER_PRIORITY = 100
MARKDOWN_LIMIT = 1_000_000


def fold_accents(text: Column) -> Column:
    """Lower case with á é í ó ú ã õ ç folded; other accents stay."""
    return F.translate(F.lower(text), "áéíóúãõç", "aeiouaoc")


def exclusion_pattern(policy: str) -> str | None:
    """The pattern of a policy, null if it excludes nothing. An unknown policy is an error before any plan is built."""
    if policy not in POLICIES:
        raise ValueError(f"unknown filter policy {policy!r}; known: {', '.join(POLICIES)}")
    if policy == "no_prefilter":
        return None
    return "|".join(p for p in EXCLUSIONS if policy == "default" or p != REFERENCE_TERMS)


def is_likely_notice(filename: Column, url: Column, policy: str = "default") -> Column:
    """Whether nothing in file name and url excludes a notice. Nulls count as empty."""
    pattern = exclusion_pattern(policy)
    if pattern is None:
        return F.lit(True)
    return ~fold_accents(F.concat(F.coalesce(filename, F.lit("")), F.lit(" "), F.coalesce(url, F.lit("")))).rlike(pattern)


def document_text(kind: Column, title: Column) -> Column:
    return F.lower(F.concat(F.coalesce(kind, F.lit("")), F.lit(" "), F.coalesce(title, F.lit(""))))


def document_priority(kind: Column, title: Column) -> Column:
    """The priority of the first token, in table order, that kind and title contain."""
    text = document_text(kind, title)
    out = None
    for token, priority in PRIORITIES:
        out = F.when(text.contains(token), priority) if out is None else out.when(text.contains(token), priority)
    return out.otherwise(OTHER_PRIORITY)


def is_preferred_document(kind: Column, title: Column) -> Column:
    return document_priority(kind, title) < OTHER_PRIORITY


def truncate_markdown(text: Column, limit: int = MARKDOWN_LIMIT) -> Column:
    """The first `limit` code points."""
    return F.substring(text, 1, limit)


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def split_list(text: Column) -> Column:
    """A comma-separated list: trimmed, blanks dropped, first occurrences kept in order."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))
