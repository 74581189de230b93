"""Problem 9: template residue, filler and error pages.

* Unfilled fields: spans that are marked as fields are (braces, brackets, percent
  or at signs, runs of X, ...) are taken out, and the words around them become
  contexts. The same contexts are counted over all texts: records of one
  template align there, and where the others have plain words the position is a
  slot. A span that retains a variable name, a default or a blank in such a slot
  is residue; a span that all records have there is the template's own text.
* Filler: blocks that repeat one phrase, run along a keyboard row, or consist of
  words that occur with the known filler words only (learned from the blocks
  around them, against the counts of the same pass).
* Error pages: texts of any length that are nothing but an error message. The
  whole-page template of every text (its words, with names, numbers and codes
  masked) is counted in the same pass. Known wording, or the form of a program's
  failure, is the seed that marks a template; every record of a marked template
  that several records share goes with it, whatever its own wording. A page whose
  template occurs once is judged by the seed alone and named so (`error_page`).

Two passes over the texts: one counts (contexts, templates, filler words), one
judges.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialize, pick

# Words that ask to fill something in.
FILL_IN = "preencher|inserir|informar|completar|insert|fill in|enter|insertar|rellenar|indicar|insérer|compléter|renseigner|einfügen|ausfüllen|eintragen"
FIELD = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}|\{%[^%\n]{1,60}%\}|[$#]\{[^{}\n]{1,60}\}|\{[^{}\n]{1,40}\}"
    r"|<<[^<>\n]{1,60}>>|&lt;[^&\n]{1,60}&gt;|<[^<>\n/!]{1,60}>|\[\[[^\[\]\n]{1,60}\]\]|\[[^\[\]\n]{1,60}\](?!\()"
    r"|@@[^@\n]{1,60}@@|«[^«»\n]{1,60}»|%[^%\s]{2,60}%|(?<!\w)__?(?=[^\W_])[^\s]{1,60}?__?(?!\w)|(?<!\w)_{3,}(?:/_+)*"
    rf"|\((?:{FILL_IN})\s[^()\n]{{1,60}}\)"
    r"|(?:(?:R?\$|€|N\.?º|Nº|No\.|Nr\.)\s)?(?<![\w.,/])X+(?:[.,/-]X+)+(?![\w])|(?<!\w)X{4,}(?!\w)",
    re.I,
)
STRONG = re.compile(rf"^(\{{\{{|\{{%|[$#]\{{|<<|&lt;|\[\[|@@|\((?:{FILL_IN})\s)|X[.,/-]X|^\[(?:{FILL_IN})\s", re.I)
IDENTIFIER = re.compile(r"^[^\W\d][\w]*(?:[ _.-][\w]+)*$|^\d$|^[●•○■□…?*-]$|^$")
MARKS = re.compile(r"^(?:\{\{|\{%|[$#]?\{|<<?|&lt;|\[\[?|@@|«|%|__?|\()\s*|\s*(?:\}\}|%\}|\}|>>?|&gt;|\]\]?|@@|»|%|__?|\))$")
BREAK = re.compile(r"\n[^\S\n]*\n\s*")
WORD = re.compile(r"[^\W\d_]+")
FLUSH = 400_000
SLOT = "\x00"

# Known filler words, with which the others are learned.
FILLER_SEEDS = frozenset({"lorem", "ipsum"})
KEYBOARD = [frozenset(row) for row in ("qwertzuiop", "asdfghjklñç", "zxcvbnm", "qwertyuiop", "yxcvbnm")]
# Wording of error messages and of notices about scripts, cookies and browser checks.
MESSAGES = re.compile(
    r"(?:page|file|document|resource|site)\b[^.]{0,30}\b(?:not found|not exist|moved|deleted|unavailable)|not found|p[áa]gina no encontrada|n[ãa]o (?:foi )?encontrad|no encontrad|introuvable|nicht gefunden|n'existe pas|n’existe pas|existiert nicht"
    r"|n[ãa]o existe ou|foi removid|no existe o|ya no existe|no longer exist|existe plus|não existe mais|já não existe|nicht mehr (?:verfügbar|vorhanden)|existiert nicht mehr|ha sido eliminad|a été (?:supprimé|déplacé)|wurde (?:gelöscht|verschoben|entfernt)|moved or deleted|has been (?:moved|deleted|removed)"
    r"|acesso negado|acceso denegado|access denied|accès refusé|zugriff verweigert|forbidden|unauthorized|n[ãa]o autorizado|permission denied"
    r"|erro interno|error interno|internal (?:server )?error|erreur interne|interner (?:server)?fehler|erro inesperado|error inesperado|unexpected error|erreur inattendue|unerwarteter fehler|ocorreu um erro|se ha producido un error|an error (?:has )?occurred|une erreur (?:est survenue|s.est produite)|ein fehler ist"
    r"|bad gateway|gateway time-?out|service unavailable|temporariamente indispon|temporalmente|no disponible|momentan[ée]ment|temporairement|indisponible|vorübergehend|nicht verfügbar|nicht erreichbar|temporarily unavailable|indispon[ií]vel"
    r"|manuten[çc][ãa]o|mantenimiento|maintenance|wartungsarbeiten|wird gewartet"
    r"|sess[ãa]o expir|sesi[óo]n (?:ha )?(?:expir|caduc)|session (?:has )?(?:expired|timed out)|session a? ?expir|sitzung (?:ist )?abgelaufen|fa[çc]a login|inicie sesi[óo]n|log in again|reconnecte|erneut an|too many requests|muitas requisi|time(?:d)? ?out|tempo (?:limite )?esgotado"
    r"|javascript|\bscripts?\b|\bskripte?\b|cookies?\b|navegador|\bbrowser\b|navigateur|n[ãa]o é um rob|no es un robot|not a robot|are (?:you )?human|pas un robot|kein roboter|captcha|cloudflare|verificando|verifying|wird geprüft",
    re.I,
)
FAILURE = re.compile(
    r"Traceback \(most recent|^\s*File \".+\", line \d+|\b[\w.]+(?:Exception|Error)\b\s*[:(]|^\s*at [\w.$<>]+\([\w.]*(?::\d+)?\)|Fatal error|^(?:PHP )?(?:Warning|Notice|Parse error|Deprecated)\s*:|Uncaught|stack trace"
    r"|^\s*\{\s*\"(?:status|error|code|message|errors|statusCode|timestamp)\"\s*:|<Error>\s*<Code>|^\s*HTTP(?:/\d\.\d)? ?[45]\d\d\b|^\s*[45]\d\d\s*[-–:—]\s|ORA-\d{5}|SQLSTATE|Segmentation fault|\bTypeError\b|\bKeyError\b",
    re.M | re.I,
)
NOSCRIPT = re.compile(r"^\s*<noscript\b", re.I)
# What error pages add to their message.
EXTRAS = re.compile(
    r"(?:tente novamente|inténtelo de nuevo|try again|réessayez|versuchen sie)[^.]*\.?|(?:volte|vuelva|go back|revenez|kehren sie)[^.]*\.?|\bray(?: id)?:? [0-9a-f]+|\bid:? ?\d+|\b(?:[\w-]+\.)+[a-z]{2,}\b|</?\w+[^>]*>|\b\d+\b|^\s*(?:observação|nota|note|aviso|hinweis|remarque|erro|error|http)\b:?",
    re.I | re.M,
)
# Longer pages than this are judged by the share of their lines or sentences, for which a cheap test of their words comes first.
SHORT_PAGE = 700
# What every line of a program's failure, and every sentence of a message, has one of.
FAILURE_KEYS = ("traceback", 'file "', "exception", "error", "warning", "notice", "deprecated", "uncaught", "stack trace", "\n\tat ", "\n    at ", "\n  at ", "ora-", "sqlstate", "segmentation", "http")
MESSAGE_KEYS = ("script", "skript", "cookie", "navegador", "browser", "navigateur", "captcha", "cloudflare", "rob", "found", "encontrad", "error", "erro", "fehler", "erreur", "404", "403", "500", "503", "session", "sess", "sitzung", "login", "manuten", "mainten", "mantenim", "wartung", "verif", "verfügbar", "dispon", "existe", "acces", "acess", "zugriff")


def _mask(token: str) -> str:
    """A word as templates are compared: numbers and codes as 9, names as Aa."""
    bare = token.strip("\"'“”‘’()*>")
    if any(c.isdigit() for c in bare):
        return "9"
    if bare[:1].isupper() and bare[1:].islower() and len(bare) > 3:
        return "Aa" + bare[-1] if bare[-1] in ".,;:" else "Aa"
    return bare


class Masks(dict):
    """Masked forms of words, each made once per task; emptied when it grows large."""

    def __missing__(self, token: str) -> str:
        if len(self) > FLUSH:
            self.clear()
        value = self[token] = SLOT if token == SLOT else _mask(token)
        return value


def aligned(text: str, masks: Masks) -> Iterator[tuple[list[str], list[str]]]:
    """Per line with words: masked words, SLOT where a marked span stood, and the spans."""
    marked = MAYBE.search(text) is not None
    for line in text.split("\n"):
        spans = FIELD.findall(line) if marked and MAYBE.search(line) else []
        if not spans:
            yield [masks[w] for w in line.split()], spans
            continue
        words = [masks[w] for w in FIELD.sub(f" {SLOT} ", line).split()]
        # a stop or comma right behind a span is part of the slot
        words = [w for i, w in enumerate(words) if not (i and words[i - 1] == SLOT and w in {".", ",", ";", ":"})]
        yield words, spans


MAYBE = re.compile(rf"[{{\[«<]|@@|__|&lt;|%[^\W\d]|X[X.,/-]|x[x.,/-]x|\((?:{FILL_IN})\s", re.I)


def contexts(words: list[str], i: int) -> list[tuple[str, str, str]]:
    """The contexts of position i: the words on both sides (kind b), the two before and the two behind (kind g)."""
    left, right = words[max(0, i - 2) : i], words[i + 1 : i + 3]
    found = []
    if left and right:
        found.append(("b", left[-1], right[0]))
    if len(left) == 2:
        found.append(("g", *left))
    if len(right) == 2:
        found.append(("g", *right))
    return [c for c in found if SLOT not in c]


def name_like(span: str) -> bool:
    """Whether a marked span holds a variable name, a default or a blank rather than text."""
    if span.strip("_/") == "" or re.search(r"X[.,/-]?X", span):
        return True
    inner = MARKS.sub("", MARKS.sub("", span)).strip()
    if span.startswith("("):
        return True
    inner = re.sub(r"^(?:if|for|unless|else|end\w*|set|%)\s+", "", inner)
    if not IDENTIFIER.match(inner) or len(inner) > 50:
        return False
    if span.startswith("«") or span.startswith("_"):
        return "_" in inner or inner.islower() or inner.isupper()
    if span.startswith("<") and not span.startswith("<<"):
        return inner.isupper() or "_" in inner
    if span.startswith("{") and inner.isdigit():
        return True
    if span.startswith("[") and not span.startswith("[["):
        return not inner.isdigit() and inner not in ("…", "?", "*", "-") and (len(inner) > 2 or not inner.isascii())
    return len(inner) > 1 or inner in "●•○■□"


def scan_templates(df: DataFrame) -> DataFrame:
    """(kind, a, b, plain, id, spot, span) rows of one pass.

    Summed contexts (kinds g and b), words of blocks with a known filler word
    (kind f), the masked text's hash as plain of every text (kind p), and the
    spans with their contexts, where plain is that hash too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        neighbours: Counter = Counter()
        around_one: Counter = Counter()
        fillers: Counter = Counter()
        masks = Masks()
        names = ["kind", "a", "b", "plain", "id", "spot", "span"]
        types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        def out() -> pa.RecordBatch:
            rows = [("g", *c, n, None, None, None) for c, n in neighbours.items()] + [("b", *c, n, None, None, None) for c, n in around_one.items()]
            rows += [("f", w, None, n, None, None, None) for w, n in fillers.items()]
            neighbours.clear()
            around_one.clear()
            fillers.clear()
            return batch(rows)

        for b in chunks(batches, 500):
            spots: list[tuple] = []
            pages: list[tuple] = []
            for id_, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spot, first = 0, len(spots)
                lines = list(aligned(text, masks))
                for words, spans in lines:
                    if len(words) < 2 and not spans:
                        continue
                    if spans:
                        places = [i for i, w in enumerate(words) if w == SLOT]
                        for i, span in zip(places, spans):
                            spot += 1
                            if name_like(span):
                                around = contexts(words, i) or [("n", "", "")]
                                spots += [(*c, None, id_, spot, span) for c in around]
                        # what touches a span is no plain context
                        for i in range(len(words) - 1):
                            if SLOT not in words[max(0, i - 1) : i + 3]:
                                neighbours[words[i], words[i + 1]] += 1
                                if i + 2 < len(words):
                                    around_one[words[i], words[i + 2]] += 1
                    else:
                        neighbours.update(zip(words, words[1:]))
                        around_one.update(zip(words, words[2:]))
                wording = xxhash.xxh64_intdigest("\n".join([" ".join(words) for words, _ in lines if words])) >> 1
                pages.append(("p", None, None, wording, id_, None, None))
                if len(spots) > first:
                    spots[first:] = [(*s[:3], wording, *s[4:]) for s in spots[first:]]
                low = text.lower()
                if any(seed in low for seed in FILLER_SEEDS):
                    blocks = (WORD.findall(block) for block in BREAK.split(low))
                    fillers.update(w for own in blocks if not FILLER_SEEDS.isdisjoint(own) for w in own)
            yield batch(spots + pages)
            if len(neighbours) + len(around_one) > FLUSH:
                yield out()
        yield out()

    return df.mapInArrow(run, "kind string, a string, b string, plain long, id long, spot int, span string")


def unfilled_fields(rows: DataFrame, *, least: int = 3, factor: float = 3.0) -> DataFrame:
    """(id, spot, span) of scanned rows: marked spans where aligned records have plain words, `factor` times as often and `least` times at least.

    Spans whose marks are used for nothing but fields need no aligned record.
    They are the template's own text where five or more records of different
    wording have the same span and none has plain words. Blanks to be filled
    by hand never count.
    """
    spots = rows.where("spot IS NOT NULL").select("kind", "a", "b", "id", "spot", "span", F.col("plain").alias("wording"))
    # copies of one text, names and numbers masked, count once
    wanted = spots.groupBy("kind", "a", "b").agg(F.count("*").alias("marked"), F.count_distinct("wording").alias("wordings"), F.count_distinct("span").alias("spans"))
    plain = rows.where("kind IN ('g', 'b') AND id IS NULL").join(wanted.select("kind", "a", "b"), ["kind", "a", "b"], "left_semi").groupBy("kind", "a", "b").agg(F.sum("plain").alias("plain"))
    judged = wanted.join(plain, ["kind", "a", "b"], "left").withColumn("plain", F.coalesce("plain", F.lit(0)))
    slot = (F.col("plain") >= least) & (F.col("plain") >= factor * F.col("wordings"))
    kept = (F.col("kind") != "n") & (F.col("plain") == 0) & (F.col("wordings") >= 5) & (F.col("spans") == 1)
    best = (
        spots.join(judged, ["kind", "a", "b"])
        .groupBy("id", "spot", "span")
        .agg(F.max(F.when(slot, 2).when(kept, 0).otherwise(1)).alias("evidence"))
    )
    strong = F.col("span").rlike(STRONG_JAVA)
    return best.where((F.col("evidence") == 2) & ~F.col("span").rlike("^_{3,}") | ((F.col("evidence") == 1) & strong)).select("id", "spot", "span")


STRONG_JAVA = f"(?i)^(\\{{\\{{|\\{{%|[$#]\\{{|<<|&lt;|\\[\\[|@@|__\\p{{L}}|%\\w+%$|\\[●|\\(({FILL_IN})\\s)|X[.,/-]X|^\\[({FILL_IN})\\s"


def repeats_phrase(words: list[str], least: int = 4) -> bool:
    """Whether the words of a block are one phrase of up to five words, said again and again."""
    for size in range(1, 6):
        if len(words) >= max(least * size, 5) and sum(words[i] == words[i - size] for i in range(size, len(words))) >= 0.9 * (len(words) - size):
            return True
    return False


def keyboard_row(words: list[str]) -> bool:
    """Whether the words of a block stay on one row of the keyboard."""
    words = [w for w in words if len(w) >= 3]
    if len(words) < 4 or not any(row.issuperset(words[0]) or row.issuperset(words[-1]) for row in KEYBOARD):
        return False
    letters = Counter("".join(words))
    total = letters.total()
    return any(sum(n for c, n in letters.items() if c in row) >= 0.95 * total for row in KEYBOARD)


def filler_words(rows: DataFrame) -> frozenset[str]:
    """Words at least half of whose uses are in blocks with a known filler word, of scanned rows.

    All uses are those of the pair counts. A word must make up a 100,000th of the
    filler blocks: so there are 100,000 at most, and rarer ones decide no block.
    """
    near = rows.where("kind = 'f'").groupBy(F.col("a").alias("word")).agg(F.sum("plain").alias("n")).where("n >= 2")
    pairs = rows.where("kind = 'g' AND id IS NULL").groupBy("a").agg(F.sum("plain").alias("n"))
    uses = pairs.select(F.lower(F.regexp_extract("a", r"\p{L}+", 0)).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("uses"))
    found = near.join(uses, "word", "left").where("2 * n >= coalesce(uses, 0)")
    total = near.agg(F.sum("n")).first()[0] or 0
    return frozenset(r.word for r in found.where(F.col("n") * 100_000 >= total).select("word").collect()) | FILLER_SEEDS


def same_in_all_sections(text: str) -> bool:
    """Whether two or more headings are each followed by the same short line and nothing else."""
    body = [x.strip().lower() for x in text.split("\n") if x.strip() and not x.startswith("#")]
    heads = sum(x.startswith("#") for x in text.split("\n"))
    return len(body) >= 2 and heads >= 2 and len(set(body)) == 1 and len(body[0].split()) <= 8


def is_filler(text: str, words: frozenset[str]) -> bool:
    if text.startswith("#") and same_in_all_sections(text):
        return True
    for block in BREAK.split(text.lower()):
        if len(block) < 20:
            continue
        own = WORD.findall(block)
        distinct = frozenset(own)
        if len(own) >= 5 and 3 * len(distinct) <= len(own) + 3 and repeats_phrase(own):
            return True
        if len(own) >= 4 and "e" not in distinct and "de" not in distinct and keyboard_row(own):
            return True
        if len(own) >= 5 and not words.isdisjoint(distinct) and sum(w in words for w in own) >= 0.6 * len(own):
            return True
    return False


def error_page(text: str) -> bool:
    """Whether a text is nothing but an error message, a program failure or a script notice.

    At any length: at least half of the lines are a failure's, or the text is one
    message with little beside it, or four fifths of its sentences, and of their
    words, are messages.
    """
    body = text.strip()
    if not body:
        return False
    short = len(body) <= SHORT_PAGE
    low = "" if short else body.lower()
    if short or any(k in low for k in FAILURE_KEYS):
        failure = FAILURE.search(body) if short else None
        if failure or not short:
            lines = [x for x in body.split("\n") if x.strip()]
            technical, rest = 0, len(lines)
            for x in lines:
                technical += bool(FAILURE.search(x)) or x.startswith((" ", "\t"))
                rest -= 1
                # the verdict is known as soon as the rest can't change it
                if technical * 2 >= len(lines) or (technical + rest) * 2 < len(lines):
                    break
            # indented lines alone are no failure
            if technical * 2 >= len(lines) and (failure or FAILURE.search(body)):
                return True
            if short and len(body) <= 250:
                return True
    if short:
        if FAILURE.search(body):
            return False
        if NOSCRIPT.match(body):
            return True
        if not MESSAGES.search(body):
            return False
        # what is left beside the message must be no content of its own
        rest_ = EXTRAS.sub(" ", body)
        others = [s for s in _sentences(rest_) if not MESSAGES.search(s)]
        return len(WORD.findall(rest_)) <= 25 and sum(len(WORD.findall(s)) for s in others) <= 8
    # a long notice says one of the words in every sentence or so
    if sum(low.count(k) for k in MESSAGE_KEYS) * 250 < len(low) or "\n## " in body:
        return False
    said = [(bool(MESSAGES.search(s)), len(WORD.findall(s))) for s in _sentences(EXTRAS.sub(" ", body))]
    hits = [n for hit, n in said if hit]
    return len(hits) >= 0.8 * len(said) and sum(hits) >= 0.8 * sum(n for _, n in said) > 0


def _sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if len(WORD.findall(s)) >= 3]


def flagged(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(id, reason) of the records to exclude: field, filler, error_template or error_page.

    A record has a row for each reason. Null and empty texts have none, and
    repeated rows are judged together.
    """
    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").select(F.col("id").cast("long").alias("id"), "text")
    rows = materialize(scan_templates(src), "contexts")
    fields = unfilled_fields(rows).select("id").distinct().select("id", F.lit("field").alias("reason"))
    words = filler_words(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 500):
            found: list[tuple] = []
            for id_, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if is_filler(text, words):
                    found.append((id_, "filler"))
                if error_page(text):
                    found.append((id_, "error"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int64(), pa.string()))], names=["id", "reason"])

    judged = materialize(src.mapInArrow(run, "id long, reason string"), "judged")
    pages = rows.where("kind = 'p'").select("id", F.col("plain").alias("template"))
    seeds = judged.where("reason = 'error'").select("id").distinct()
    # a template is an error page's if most of its records are: their wording differs in masked names and numbers only
    shared = pages.join(seeds.withColumn("seed", F.lit(1)), "id", "left").groupBy("template").agg(F.count("*").alias("n"), F.count("seed").alias("seeds")).where("n >= 2 AND 2 * seeds >= n").select("template")
    carried = pages.join(shared, "template", "left_semi").select("id").distinct()
    alone = seeds.join(carried, "id", "left_anti").select("id", F.lit("error_page").alias("reason"))
    return fields.unionByName(judged.where("reason = 'filler'")).unionByName(carried.select("id", F.lit("error_template").alias("reason"))).unionByName(alone).distinct()


def without_residue(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """The rows of df, all columns, that have no flagged text. Rows of null id or text are kept."""
    bad = flagged(df, id_col=id_col, text_col=text_col).select(F.col("id").alias("__flagged")).distinct()
    return df.join(bad, df[f"`{id_col}`"].cast("long") == bad["__flagged"], "left_anti")
