"""Problem 4: text cut off by field limits or broken transfers.

One pass measures every text as different stores would (characters, UTF-8
bytes, UTF-16 units, with CRLF line ends, HTML-escaped, JSON-escaped) and
inspects its ending. Only these features go on.

1. Hidden limits: lengths are counted by source and measure; a length that far
   more texts of a source share than its neighbourhood stands out. Only then are
   the endings of the texts at that length inspected: with mostly cut ones it is
   a storage limit of that source in that measure. A text that several measures
   explain goes to the limit with most texts, and limits that are left without
   texts of their own are dropped (a text of 1200 characters and 10 lines is at
   no limit of 1210). A limit in bytes may end up to three bytes early, where a
   character would have been split; texts of unknown source are compared with
   the limits of all sources.
2. A text at a limit was cut by it (`limit`) unless its ending is complete: an
   ending that could be either (a signature, a link, a row) counts as cut there.
3. Texts at no limit were cut in transfer (`transfer`) if they don't end as texts
   end: in a full stop (with closing marks), a table row, a link, the foot of a
   page, a running line or a signature; or if they end in the beginning of a line
   with which other texts end (`line`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, materialize, pick

# Bytes that a cut at a limit of bytes may fall short by, by place in MEASURES.
SHORT_BY = {1: 3, 4: 3}
MEASURES = ("chars", "utf8", "utf16", "crlf", "crlf_utf8", "html", "entities", "json", "json_ascii")

OMISSION = re.compile(r"[\s]*(…|\.{3,}|\[\s*(…|\.{3})\s*\]|\(\s*(…|\.{3})\s*\)|\[(cont|continua|more|cut)\.?\])+\s*$", re.I)
FULL_STOP = re.compile(r"[.!?;:؟。][\"'”’»›)\]*_~`]*$")
PAGE_NUMBER = re.compile(r"^\W*((p[aá]g(ina|e)?|seite|folha|fl|p)\b\.?)?\W*(\d{1,5}|[ivxlc]{1,7})(\s*(de|of|von|sur|/)\s*\d{1,5})?\W*$", re.I)
LINK = re.compile(r"^[-*•\s<(]*(https?://|www\.)\S+?[>)]*$|^\S+@\S+\.\w{2,}$", re.I)
COMMENT = re.compile(r"^<!--.*-->$")
WORD = re.compile(r"[^\W\d_]+")
BLANK = re.compile(r"\n[^\S\n]*\n")
# Abbreviations that may end a line without a stop of their own.
ABBREVIATIONS = {"ltda", "cia", "s/a", "eireli", "epp", "etc", "inc", "llc", "gmbh", "cf", "ss", "srl", "slp"}


def lengths(text: str) -> list[int]:
    """The text's length in each of MEASURES. JSON includes the quotes, CRLF counts lone line feeds twice."""
    chars = len(text)
    utf8 = len(text.encode("utf-8", "surrogatepass"))
    lines = text.count("\n") - text.count("\r\n")
    astral = sum(c > "￿" for c in text) if utf8 > chars and max(text) > "￿" else 0
    outside = chars - len(text.encode("ascii", "ignore"))
    html = chars + 4 * text.count("&") + 3 * (text.count("<") + text.count(">")) + 5 * text.count('"') + 5 * text.count("'")
    numeric = sum(len(str(ord(c))) + 2 for c in text if c > "\x7f") if outside else 0
    escapes = text.count("\n") + text.count("\r") + text.count("\t") + text.count('"') + text.count("\\")
    return [chars, utf8, chars + astral, chars + lines, utf8 + lines, html, html + numeric, chars + escapes + 2, chars + escapes + 2 + 5 * outside + 6 * astral]


def _same_line(line: str) -> str:
    """A line as running lines are compared: letters only, lower case."""
    return "".join(WORD.findall(line.lower()))


def ending(text: str) -> tuple[str, str]:
    """(kind, last line) of a text: stop, omitted, row, link, foot, running, signature, cut or empty.

    omitted and cut are cut endings; row, link and signature are complete
    unless something else speaks for a cut.
    """
    body = text.rstrip()
    if not body:
        return "empty", ""
    omission = OMISSION.search(body)
    if omission:
        rest = body[: omission.start()].rstrip()
        last = rest.split()[-1].strip("().,").lower() if rest else ""
        return ("stop" if not rest or FULL_STOP.search(rest) or last in ABBREVIATIONS else "omitted"), rest.rpartition("\n")[2].strip()
    line = body.rpartition("\n")[2].strip()
    if COMMENT.match(line) or PAGE_NUMBER.match(line):
        return "foot", line
    if line.startswith("|"):
        return ("row" if line.endswith("|") and len(line) > 1 else "cut"), line
    if FULL_STOP.search(line):
        return "stop", line
    if LINK.match(line):
        return "link", line
    if set(line) <= set("-–—_*=~ "):
        return "foot", line
    key = _same_line(re.sub(r"(?i)\W+(p[aá]g(ina|e)?\.?|seite|p\.)?\W*(\d{1,5}|[ivxlc]{1,7})(\s*(de|of|von|sur|/)\s*\d{1,5})?\W*$", "", line) or line)
    if len(key) >= 8:
        lines = body.split("\n")[:-1]
        if sum(_same_line(x).startswith(key) for x in lines if abs(len(x) - len(line)) <= 24) >= 1 and not _in_paragraph(lines):
            return "running", line
    words = WORD.findall(line)
    if line.split()[-1].strip("().,").lower() in ABBREVIATIONS:
        return "stop", line
    paragraph = BLANK.split(body)[-1].strip()
    long = [w for w in words if len(w) >= 4]
    titled = len(long) >= 2 and all(w[0].isupper() for w in long) and words[-1][0].isupper() and not line.startswith(("#", "-", "*", ">"))
    if titled and len(words) <= 8 and (paragraph == line or all(len(x.split()) <= 8 for x in paragraph.split("\n"))) and not re.search(r"[.,;:]\s", line):
        return "signature", line
    return "cut", line


def _in_paragraph(before: list[str]) -> bool:
    """Whether the line above runs on into the last line: the last line is then text, unless pages are wrapped."""
    return bool(before) and bool(before[-1].strip()) and len(before[-1]) > 120


def features(df: DataFrame, *, id_col: str, text_col: str, candidate_col: str) -> DataFrame:
    """id, candidate, kind, last_line, lengths of each text that isn't null."""
    src = pick(df, id=id_col, candidate=candidate_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1000):
            texts = b.column(2).to_pylist()
            ends = [ending(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1).cast(pa.int64()), pa.array([k for k, _ in ends], pa.string()), pa.array([x for _, x in ends], pa.string()), pa.array(map(lengths, texts), pa.list_(pa.int64()))],
                names=["id", "candidate", "kind", "last_line", "lengths"],
            )

    return src.mapInArrow(run, "id long, candidate long, kind string, last_line string, lengths array<long>")


def source_name(source: Column) -> Column:
    """A source in one spelling; `unknown` for null and blank."""
    clean = F.lower(F.regexp_replace(source, r"^\s+|\s+$", ""))
    return F.when(clean.isNull() | (clean == ""), "unknown").otherwise(clean)


def hidden_limits(measured: DataFrame, *, least: int = 5, factor: float = 8.0, around: int = 25) -> DataFrame:
    """(source, measure, length, texts, cut): lengths that stand out of their neighbourhood by `factor`, with mostly cut endings.

    measured: source, lengths, is_cut. Of a source, only distinct lengths are
    ordered; texts are counted with map-side sums before.
    """
    counted = (
        measured.select("source", "is_cut", F.posexplode("lengths").alias("at", "length"))
        .groupBy("source", "at", "length")
        .agg(F.count("*").alias("texts"), F.sum("is_cut").alias("cut"))
    )
    near = Window.partitionBy("source", "at").orderBy("length").rangeBetween(-around, around)
    stands = counted.withColumn("others", F.sum("texts").over(near) - F.col("texts"))
    names = F.array(*map(F.lit, MEASURES))
    return stands.where((F.col("texts") >= least) & (F.col("cut") * 2 >= F.col("texts")) & (F.col("texts") >= factor * F.col("others") / (2 * around))).select(
        "source", F.element_at(names, F.col("at") + 1).alias("measure"), "at", "length", "texts", "cut"
    )


def at_limits(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """(id, source, at, length, texts): each text at a limit, with the limit that explains most texts. limits: source, at, length, texts."""
    short = F.lit(0)
    for at, n in SHORT_BY.items():
        short = F.when(F.col("at") == at, n).otherwise(short)
    everywhere = limits.groupBy("at", "length").agg(F.max("texts").alias("texts")).select(F.lit("unknown").alias("source"), "at", "length", "texts")
    reached = limits.select("source", "at", "length", "texts").where("source <> 'unknown'").unionByName(everywhere)
    reached = reached.select("source", "at", F.col("length").alias("limit"), "texts", F.explode(F.sequence(F.col("length") - short, F.col("length"))).alias("length"))
    hits = measured.select("id", "source", F.posexplode("lengths").alias("at", "length")).join(reached, ["source", "at", "length"])
    best = hits.groupBy("id", "source").agg(F.max(F.struct("texts", (-F.col("at")).alias("first"), F.col("limit").alias("length"))).alias("best"))
    return best.select("id", "source", (-F.col("best.first")).cast("int").alias("at"), "best.length", "best.texts")


def truncated(df: DataFrame, candidates: DataFrame, *, id_col: str, text_col: str, candidate_col: str = "candidate_id", source_field: str = "metadata.source", least: int = 5) -> tuple[DataFrame, DataFrame]:
    """(records, limits): id, source, ending kind, at_limit, how (limit, transfer, line or null) and truncated of every text; the hidden limits.

    limits: source, measure, at, length, texts (at it), cut (of these), explained
    (texts that no limit of more texts explains). Null texts are left out, empty
    ones are not cut. A candidate that is null or isn't in `candidates` has the
    source `unknown`. Candidate ids must be unique; whole repeated rows of `df`
    are judged each.
    """
    sources = candidates.select(candidates[f"`{candidate_col}`"].alias("candidate"), source_name(F.col(source_field)).alias("source")).where("candidate IS NOT NULL")
    base = features(df, id_col=id_col, text_col=text_col, candidate_col=candidate_col)
    base = base.join(sources, "candidate", "left").withColumn("source", F.coalesce("source", F.lit("unknown"))).withColumn("is_cut", F.col("kind").isin("cut", "omitted").cast("long"))
    # the features are used several times: written once, a hundred bytes or so a text
    base = materialize(base, "features")
    standing = materialize(hidden_limits(base, least=least), "limits")
    open_ = base.where("kind IN ('row', 'link', 'signature', 'cut', 'omitted')")
    known = materialize(at_limits(open_, standing), "at-limits")
    explained = known.where("source <> 'unknown'").groupBy("source", "at", "length").agg(F.count_distinct("id").alias("explained"))
    limits = standing.join(explained, ["source", "at", "length"], "left").withColumn("explained", F.coalesce("explained", F.lit(0))).where((F.col("explained") >= least) | (F.col("source") == "unknown"))
    hits = known.join(limits.select("at", "length").distinct(), ["at", "length"], "left_semi").select("id", F.lit(True).alias("at_limit")).distinct()
    # beginnings of lines with which several texts end: by equality, so nothing has to be broadcast; the few such lines are bounded by how often they end a text
    ends = base.where("kind = 'signature'").groupBy("last_line").agg(F.count("*").alias("n")).where("n >= 5")
    begun = ends.select(F.explode(F.expr("transform(sequence(1, length(last_line) - 1), i -> rtrim(substring(last_line, 1, i)))")).alias("last_line")).distinct()
    begun = begun.join(ends.select("last_line"), "last_line", "left_anti")
    # only signatures are looked up, so a line shared by many other texts is no hot key
    lines = base.where("kind = 'signature'").select("id", "last_line").join(begun, "last_line", "left_semi").select("id", F.lit(True).alias("begun")).distinct()
    how = (
        F.when(F.coalesce("at_limit", F.lit(False)), "limit")
        .when(F.col("kind").isin("cut", "omitted"), "transfer")
        .when((F.col("kind") == "signature") & F.coalesce("begun", F.lit(False)), "line")
    )
    records = (
        base.join(hits, "id", "left")
        .join(lines, "id", "left")
        .select("id", "source", "kind", F.coalesce("at_limit", F.lit(False)).alias("at_limit"), how.alias("how"))
        .withColumn("truncated", F.col("how").isNotNull())
    )
    return records, limits


def truncation_by_source(records: DataFrame) -> DataFrame:
    """source, texts, truncated, share, and how: at_limit, in_transfer, in_line."""
    return records.groupBy("source").agg(
        F.count("*").alias("texts"),
        F.count_if("truncated").alias("truncated"),
        F.round(F.count_if("truncated") / F.count("*"), 6).alias("share"),
        F.count_if(F.col("how") == "limit").alias("at_limit"),
        F.count_if(F.col("how") == "transfer").alias("in_transfer"),
        F.count_if(F.col("how") == "line").alias("in_line"),
    )
