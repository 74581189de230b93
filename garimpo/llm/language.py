"""Problem 3: language of records and of their segments, by word-first backoff.

A known word is scored by its log frequency in each language. For an unseen
word the model falls back to its character 5-grams, and, if none of them is
known, to shorter and shorter ones. The scores of a segment's words add up; the
softmax of the sums gives the confidence.

The model is fitted once on a bounded sample of labelled rows (`per_language`
rows of each language, those of the smallest id hashes); counting is
distributed, and the counts that reach the driver are bounded by the sample.
Everything else (segments, records) covers all rows in one pass without a
shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, pick

LANGS = ("pt", "es", "en", "fr", "de")
WORDS = re.compile(r"[^\W\d_]+")
BLANK = re.compile(r"\n[^\S\n]*\n\s*")
LONGEST = 5

# Codes of ISO 639-1 and 639-2 and the languages' names in the five languages, without accents.
NAMES = {
    "pt": ["pt", "por", "ptb", "portugues", "portuguese", "portugais", "portugiesisch", "brazilian portuguese", "portugues brasileiro", "portugues do brasil"],
    "es": ["es", "spa", "esp", "espanhol", "espanol", "castellano", "castelhano", "spanish", "espagnol", "spanisch"],
    "en": ["en", "eng", "ingles", "english", "anglais", "englisch"],
    "fr": ["fr", "fra", "fre", "frances", "french", "francais", "franzosisch", "franzoesisch"],
    "de": ["de", "deu", "ger", "alemao", "aleman", "german", "allemand", "deutsch"],
}


def label_language(label: Column) -> Column:
    """The language that a label names by code, regional code or name; null if none."""
    plain = F.translate(F.lower(F.regexp_replace(label, r"^[\s\"'(]+|[\s\"').;,]+$", "")), "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    base = F.regexp_replace(plain, r"(?<=^[a-z]{2,3})[-_](latn|latin|[a-z]{2}|[0-9]{3})([-_].*)?$", "")
    base = F.regexp_replace(base, r"\s*\(.*\)$", "")
    out = F.lit(None).cast("string")
    for lang, names in NAMES.items():
        out = F.when(base.isin(names), lang).otherwise(out)
    return out


def _grams(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


class Model:
    """Log frequencies by language of words and of character n-grams."""

    def __init__(self, words: dict[str, list[int]], grams: dict[str, list[int]]):
        self.words = self._logs(words)
        self.grams = {n: self._logs({g: c for g, c in grams.items() if len(g) == n}) for n in range(1, LONGEST + 1)}
        self.seen: dict[str, np.ndarray] = {}

    @staticmethod
    def _logs(counts: dict[str, list[int]]) -> dict[str, np.ndarray]:
        if not counts:
            return {}
        table = np.array(list(counts.values()), np.float64)
        # counts are scaled to equal totals, so that a rare language isn't smoothed away
        table = table / np.maximum(table.sum(axis=0), 1) * 1e6
        table = np.log(table + 1.0)
        return dict(zip(counts, table))

    def word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        known = self.seen.get(word)
        if known is None:
            known = np.zeros(len(LANGS))
            for size in range(LONGEST, 0, -1):
                hits = [x for g in _grams(word, size) if (x := self.grams[size].get(g)) is not None]
                if hits:
                    # an unseen word weighs half of a seen one, less the shorter the n-grams are
                    known = np.mean(hits, axis=0) * (0.5 * size / LONGEST)
                    break
            if len(self.seen) > 500_000:
                self.seen.clear()
            self.seen[word] = known
        return known

    def score(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(len(LANGS))
        return np.sum([self.word(w) for w in words], axis=0)


def confidence(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def fit(labelled: DataFrame, *, id_col: str, text_col: str, lang_col: str, per_language: int = 600, least: int = 2) -> Model:
    """A model from at most per_language rows of each language; words and n-grams of fewer than `least` rows are left out.

    Rows with null text or a label that names none of the languages are not used.
    """
    rows = pick(labelled, id=id_col, text=text_col, lang=lang_col).withColumn("lang", label_language(F.col("lang"))).where("lang IS NOT NULL AND length(text) >= 200")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = set(WORDS.findall(text.lower()))
                counts.update((lang, 0, w) for w in words)
                counts.update((lang, 1, g) for g in {g for w in words for size in range(1, LONGEST + 1) for g in _grams(w, size)})
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in counts], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))] + [pa.array(list(counts.values()), pa.int64())], names=["lang", "kind", "item", "n"])

    counted = sample.mapInArrow(run, "lang string, kind int, item string, n long").groupBy("kind", "item").pivot("lang", list(LANGS)).agg(F.sum("n"))
    counted = counted.na.fill(0).where(" + ".join(LANGS) + f" >= {least}")
    words: dict[str, list[int]] = {}
    grams: dict[str, list[int]] = {}
    for r in counted.toLocalIterator():
        (grams if r.kind else words)[r.item] = [r[lang] for lang in LANGS]
    return Model(words, grams)


def segments(text: str) -> list[str]:
    """Blocks between blank lines."""
    return [s for s in BLANK.split(text.strip()) if s]


def judge(text: str, model: Model, least_letters: int = 60, margin: float = 6.0) -> list[tuple[int, int, np.ndarray]]:
    """(segment number, letters, probabilities) of the segments with at least least_letters letters.

    A segment leaves the record's own language only if its scores do so by
    `margin`, about a factor of 400.
    """
    found = []
    for number, segment in enumerate(segments(text), 1):
        words = WORDS.findall(segment)
        letters = sum(map(len, words))
        if letters >= least_letters:
            found.append((number, letters, model.score([w.lower() for w in words])))
    if not found:
        return []
    own = int(np.argmax(sum(x[2] for x in found)))
    prior = np.zeros(len(LANGS))
    prior[own] = margin
    return [(n, letters, confidence(s + prior)) for n, letters, s in found]


def segment_languages(df: DataFrame, model: Model, *, id_col: str, text_col: str, label_col: str, least_letters: int = 60) -> DataFrame:
    """One row per looked-at segment: id, segment_no, letters, lang, confidence, and of its record main_lang, record_confidence, languages, labelled.

    main_lang holds most letters of the looked-at segments (of a tie, the first
    in the order pt, es, en, fr, de); labelled is the language that the label
    names, or null. Records with null text or without such a segment have no
    row. Repeated rows are judged one by one.
    """
    src = pick(df, id=id_col, text=text_col, label=label_col).where("text IS NOT NULL").select(F.col("id").cast("long").alias("id"), label_language(F.col("label")).alias("labelled"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 500):
            rows = []
            for id_, labelled, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                judged = judge(text, model, least_letters)
                if not judged:
                    continue
                held = np.zeros(len(LANGS))
                for _, letters, p in judged:
                    held[int(np.argmax(p))] += letters
                main = int(np.argmax(held))
                sure = float(sum(p[main] * letters for _, letters, p in judged) / held.sum())
                rows += [(id_, n, letters, LANGS[int(np.argmax(p))], float(p.max()), LANGS[main], sure, int((held > 0).sum()), labelled) for n, letters, p in judged]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.float64(), pa.int32(), pa.string())
            names = ["id", "segment_no", "letters", "lang", "confidence", "main_lang", "record_confidence", "languages", "labelled"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return src.mapInArrow(run, "id long, segment_no int, letters long, lang string, confidence double, main_lang string, record_confidence double, languages int, labelled string")


def mislabelled(judged: DataFrame) -> DataFrame:
    """The segments of records whose label is missing or another language, or that mix languages."""
    return judged.where("labelled IS NULL OR labelled <> main_lang OR languages > 1")
