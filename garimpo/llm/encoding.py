"""Problem 2: text decoded with the wrong character encoding.

1. Every word with characters outside ASCII (or with `?`, which lossy
   conversion leaves) is counted under its key: the word with those characters
   stripped, their places kept. A word with fewer than three ASCII letters is
   keyed together with the stripped words around it. Counts are summed per
   task, so what is shuffled follows the vocabulary, not the text. Copies of
   one text, and a form's repeats in it, count once; only texts that occur again
   are shuffled for that.
2. Twins: words of one key. The form that dominates a key is its clean one,
   the rarer forms at most half as frequent are suspects. Clean and suspect
   form agree in all ASCII characters, so their alignment pairs the stripped
   runs: `Ã£` with `ã`, `‡Æ` with `çã`. Sequences of several characters, which
   only a misreading of UTF-8 gives, are also taken from forms of any frequency,
   the dominating one among them: where a third of the rows is garbled, it may
   be garbled itself.
3. The aligned pairs, summed over the vocabulary, are the learned mappings. An
   exact check follows: a mapping is kept if reading the clean character's
   bytes in another encoding, once or twice, gives the suspect sequence. Their
   number is bounded by characters times pairs of encodings, so they fit in a
   driver's hand whatever the corpus.
4. The mappings are applied to all counted forms, also those without a twin.
   A sequence that is also good text somewhere counts in a word only if the
   word's twin says so or its case is impossible there.
5. A second pass looks up each record's suspect words among the garbled forms.
"""

from __future__ import annotations

import encodings
import encodings.aliases
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, distinct_texts, materialize, pick

SPACE = re.compile(r"[ \t\r\n\f\v]+")
GAP = re.compile("[^\x00-\x3e\x40-\x7f]+")  # outside ASCII, or the question mark
EDGE = "!\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"
LOST = "?�"
# Signs of good text, which alone never show a wrong encoding.
COMMON_SIGNS = "…—–’‘“”•·ªº°§²³½¼€"
CLOSING = COMMON_SIGNS + "»«‹›„"
DIGITS = re.compile(r"[0-9]+")
FLUSH = 400_000


def _strip(word: str) -> str:
    return GAP.sub("_", word)


def word_forms(text: str, cache_: dict[str, tuple[str, str, bool] | None]) -> Iterator[tuple[str, str]]:
    """(key, form) of each word of text that has a character outside ASCII or a question mark."""
    if text.isascii() and "?" not in text:
        return
    tokens = SPACE.split(text)
    for i, token in enumerate(tokens):
        if token.isascii() and "?" not in token:
            continue
        known = cache_.get(token, 0)
        if known == 0:
            form = token.strip(EDGE)
            bare = _strip(form)
            # codes, links and lone signs are no words
            plain = not GAP.search(form) or "://" in form
            known = None if plain else (bare, form, sum(c.isalpha() for c in bare) < 3)
            if len(cache_) > FLUSH:
                cache_.clear()
            cache_[token] = known
        if known:
            bare, form, short = known
            if short:
                before = _strip(tokens[i - 1].strip(EDGE)) if i else ""
                after = _strip(tokens[i + 1].strip(EDGE)) if i + 1 < len(tokens) else ""
                bare = DIGITS.sub("9", f"{before} {bare} {after}")
            yield bare, form


def count_forms(df: DataFrame, *, text_col: str) -> DataFrame:
    """(key, form, n): the number of distinct texts with each form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_: dict = {}
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys, forms = zip(*counts) if counts else ((), ())
            batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(forms, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["key", "form", "n"])
            counts.clear()
            return batch

        for b in chunks(batches, 1000):
            for text in b.column(0).to_pylist():
                counts.update(set(word_forms(text, cache_)))
            if len(counts) > FLUSH:
                yield out()
        yield out()

    distinct = distinct_texts(pick(df, text=text_col).where("text IS NOT NULL"))
    partial = distinct.mapInArrow(run, "key string, form string, n long")
    return partial.groupBy("key", "form").agg(F.sum("n").alias("n"))


def align(suspect: str, clean: str) -> list[tuple[str, str]]:
    """Pairs (suspect run, clean run) of two words with the same key that differ; split to single clean characters where the parts are equal."""
    pairs = []
    for bad, good in zip(GAP.findall(suspect), GAP.findall(clean)):
        if bad == good:
            continue
        step, odd = divmod(len(bad), len(good))
        if odd or not step:
            pairs.append((bad, good))
        else:
            pairs += [(bad[i * step : (i + 1) * step], g) for i, g in enumerate(good)]
    return [(b, g) for b, g in pairs if b != g]


# ---------------------------------------------------------------- exact check of a mapping


@cache
def _codecs() -> tuple[str, ...]:
    """The single-byte encodings that keep ASCII, of those Python knows."""
    ascii_bytes = bytes(range(32, 127))
    found = []
    for name in sorted(set(encodings.aliases.aliases.values())):
        try:
            if ascii_bytes.decode(name) == ascii_bytes.decode("ascii") and len("é".encode(name, "ignore")) < 2 and len(bytes([0xC3, 0xA9]).decode(name, "replace")) == 2:
                found.append(name)
        except (LookupError, UnicodeError, TypeError, AssertionError):
            continue
    return tuple(found)


def _read(data: bytes, codec: str) -> str:
    """data in codec; bytes without a character become control characters of the same number, as readers do."""
    return "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in data)


@cache
def misreadings(char: str) -> frozenset[str]:
    """All that one or two wrong readings make of a character."""

    def once(text: str) -> set[str]:
        out = set()
        for source in ("utf-8", *_codecs()):
            try:
                data = text.encode(source)
            except UnicodeError:
                continue
            for target in _codecs():
                if target != source:
                    out.add(_read(data, target))
        return out

    def utf8_twice(text: str) -> set[str]:
        return {_read(first.encode("utf-8"), second) for t in ("cp1252", "latin_1", "cp850", "cp437", "mac_roman", "cp1250") for first in [_read(text.encode("utf-8"), t)] for second in ("cp1252", "latin_1", "cp850", "cp437", "mac_roman", "cp1250")}

    return frozenset((once(char) | utf8_twice(char)) - {char})


def checked(pairs: Iterable[tuple[str, str, int, int]], least_words: int = 2) -> dict[str, tuple[str, int]]:
    """Learned mappings (suspect, clean, occurrences, words) that a wrong reading explains: suspect -> (clean, occurrences)."""
    kept: dict[str, tuple[str, int]] = {}
    for bad, good, n, words in pairs:
        # a sequence of several characters that a known misreading explains needs no second word
        if len(good) != 1 or (words < least_words and len(bad) < 2) or any(c in LOST for c in bad):
            continue
        if bad in misreadings(good) and n > kept.get(bad, ("", 0))[1]:
            kept[bad] = (good, n)
    return kept


# ---------------------------------------------------------------- judging forms


class Mappings:
    """Learned mappings with the share of each sequence's uses that are garbled."""

    def __init__(self, learned: dict[str, tuple[str, int]], clean_uses: dict[str, int]):
        self.good = {bad: good for bad, (good, _) in learned.items()}
        letters = {g.lower() for g in self.good.values()}
        self.sure = {bad for bad, (_, n) in learned.items() if n >= 9 * clean_uses.get(bad, 0) and bad.lower() not in letters and bad not in COMMON_SIGNS}
        self.longest = max(map(len, self.good), default=0)
        self.alphabet = frozenset("".join(self.good)) | frozenset(LOST)

    def restore_run(self, run: str, all_: bool = True) -> tuple[str, bool] | None:
        """(restored, sure) of a stripped run by the longest mappings, of all or only the sure ones; None if nothing in it is mapped."""
        out, sure, hit, i = [], False, False, 0
        while i < len(run):
            for size in range(min(self.longest, len(run) - i), 0, -1):
                part = run[i : i + size]
                if part in self.good and (all_ or part in self.sure):
                    out.append(self.good[part])
                    sure |= part in self.sure
                    hit = True
                    i += size
                    break
            else:
                out.append(run[i])
                i += 1
        return ("".join(out), sure) if hit else None


def _impossible_case(before: str, run: str, after: str) -> bool:
    """A capital or a sign between lower-case letters."""
    inner = before[-1:].islower() and after[:1].islower()
    return inner and any(c.isupper() or not c.isalpha() for c in run) and not (run in "’'‘-–·" or run in "ªº")


def judge(form: str, mode: str, n: int, mode_n: int, m: Mappings) -> tuple[bool, str | None]:
    """(garbled, right form if it can be known) of a counted form; mode is the dominating form of its key."""
    twin = mode if form != mode and 2 * n <= mode_n else None
    pieces = GAP.split(form)
    runs = GAP.findall(form)
    if twin is not None:
        differing = [(b, g) for b, g in zip(runs, GAP.findall(twin)) if b != g]
        lost = any(c in b for b, _ in differing for c in LOST) and not all(b.startswith(g) for b, g in differing)
        explained = differing and all((r := m.restore_run(b)) is not None and (r[1] or r[0] == g) for b, g in differing)
        if lost or explained:
            return True, twin
    out, garbled, restorable = [pieces[0]], False, True
    for i, run in enumerate(runs):
        before, after = pieces[i], pieces[i + 1]
        fixed = run
        if "�" in run or ("?" in run and before[-1:].isalpha() and after[:1].islower() and "=" not in form and "/" not in form):
            garbled, restorable = True, False
        elif (r := m.restore_run(run.strip("?"), all_=False)) is not None:
            garbled, fixed = True, r[0]
        elif (form != mode or mode_n <= 2) and _impossible_case(before, run, after) and (r := m.restore_run(run.strip("?"))) is not None:
            garbled, fixed = True, r[0]
        out += [fixed, after]
    return garbled, ("".join(out) if garbled and restorable else None)


def learn(counts: DataFrame) -> tuple[DataFrame, Mappings]:
    """(counts with the dominating form of each key, the checked mappings)."""
    modes = counts.groupBy("key").agg(F.max(F.struct("n", "form")).alias("top"))
    twins = materialize(counts.join(modes.select("key", F.col("top.form").alias("mode"), F.col("top.n").alias("mode_n")), "key"), "twins")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, form, n, mode, rare in zip(*(b.column(i).to_pylist() for i in range(5))):
                out += [(bad, good, n, key) for bad, good in align(form, mode) if rare or len(bad) > 1]
                out += [(bad, good, n, key) for bad, good in align(mode, form) if len(bad) > 1]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], names=["bad", "good", "n", "key"])

    suspects = twins.where("form <> mode").select("key", "form", "n", "mode", F.expr("2 * n <= mode_n").alias("rare"))
    aligned = suspects.mapInArrow(run, "bad string, good string, n long, key string").where("length(good) = 1")
    # grouped by pairs of characters: bounded by the alphabets; the exact check then keeps those of known encodings
    pairs = aligned.groupBy("bad", "good").agg(F.sum("n").alias("n"), F.count_distinct("key").alias("words")).where("words >= 2 OR length(bad) > 1").collect()
    learned = checked((r.bad, r.good, r.n, r.words) for r in pairs)

    wanted = frozenset(learned)
    sizes = {len(w) for w in wanted}

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts_: Counter = Counter()
        for b in batches:
            for form, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for found in GAP.finditer(form):
                    run_ = found.group()
                    for size in sizes:
                        for i in range(len(run_) - size + 1):
                            part = run_[i : i + size]
                            # misread UTF-8 is no clean use, unless it may be a capital and a closing quote
                            closing = found.start() + i + size == len(form) and part[-1] in CLOSING
                            if part in wanted and (size == 1 or closing):
                                counts_[part] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(counts_), pa.string()), pa.array(list(counts_.values()), pa.int64())], names=["bad", "n"])

    clean = twins.where("form = mode AND mode_n >= 5").select("form", "n").mapInArrow(uses, "bad string, n long").groupBy("bad").agg(F.sum("n").alias("n")).collect()
    return twins, Mappings(learned, {r.bad: r.n for r in clean})


def garbled_words(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(id, key, form, right, n): each record's garbled words; right is null where the text is lost.

    Null texts and ids have none. Rows of the same id are taken together.
    """
    twins, m = learn(count_forms(df, text_col=text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, form, n, mode, mode_n in zip(*(b.column(i).to_pylist() for i in range(5))):
                if not m.alphabet.isdisjoint(form):
                    bad, right = judge(form, mode, n, mode_n, m)
                    if bad:
                        rows.append((key, form, right))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["key", "form", "right"])

    garbled = twins.select("key", "form", "n", "mode", "mode_n").mapInArrow(run, "key string, form string, right string")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_: dict = {}
        for b in chunks(batches, 1000):
            rows: list[tuple] = []
            for id_, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not m.alphabet.isdisjoint(text):
                    found = Counter(kf for kf in word_forms(text, cache_) if not m.alphabet.isdisjoint(kf[1]))
                    rows += [(id_, key, form, n) for (key, form), n in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["id", "key", "form", "n"])

    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    return src.mapInArrow(words, "id long, key string, form string, n long").join(materialize(garbled, "garbled"), ["key", "form"]).select("id", "key", "form", "right", "n")


def garbled_records(df: DataFrame, *, id_col: str, text_col: str, least_words: int = 3) -> DataFrame:
    """(id, garbled_words, lost_words) of the records with at least least_words garbled words."""
    words = garbled_words(df, id_col=id_col, text_col=text_col)
    return (
        words.groupBy("id")
        .agg(F.sum("n").alias("garbled_words"), F.sum(F.when(F.col("right").isNull(), F.col("n")).otherwise(0)).alias("lost_words"))
        .where(F.col("garbled_words") >= least_words)
    )


def restored_records(df: DataFrame, *, id_col: str, text_col: str, least_words: int = 3) -> DataFrame:
    """(id, restored, garbled_words, lost_words): the records' texts with every word restored whose right form is known."""
    words = garbled_words(df, id_col=id_col, text_col=text_col)
    fixes = (
        words.groupBy("id")
        .agg(
            F.sum("n").alias("garbled_words"),
            F.sum(F.when(F.col("right").isNull(), F.col("n")).otherwise(0)).alias("lost_words"),
            F.collect_list(F.when(F.col("right").isNotNull(), F.struct("key", "form", "right"))).alias("fixes"),
        )
        .where(F.col("garbled_words") >= least_words)
    )
    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 500):
            texts = []
            for text, known in zip(b.column(1).to_pylist(), b.column(4).to_pylist()):
                right: dict[str, set[str]] = {}
                for f in known:
                    right.setdefault(f["form"], set()).add(f["right"])
                # a form that has several right ones (short words) stays as it is
                sole = {form: next(iter(r)) for form, r in right.items() if len(r) == 1}
                parts = re.split(r"([ \t\r\n\f\v]+)", text)
                texts.append("".join(_fix(p, sole) for p in parts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), b.column(2), b.column(3)], names=["id", "restored", "garbled_words", "lost_words"])

    return src.join(fixes, "id").mapInArrow(run, "id long, restored string, garbled_words long, lost_words long")


def _fix(token: str, right: dict[str, str]) -> str:
    form = token.strip(EDGE)
    return token.replace(form, right[form], 1) if form in right else token
