"""Problem 5: noise in text from scanned pages.

1. Vocabulary: words and pairs of neighbouring words are counted (summed per
   task before the shuffle), copies of one text once. A word is in the vocabulary
   if it makes up at least one in 200,000 words, so it has 200,000 words at most
   and may be sent to all. A word that look-alikes tie to one DOUBT times as
   frequent is not in it: it may be that word misread, however often.
2. One pass over the texts finds page furniture (running lines that recur in a
   text, whatever way they were read; page numbers that count on), words split
   at line ends, and words of the body that are not in the vocabulary but look
   like one misread.
3. For each distinct such word, in whatever case, a Levenshtein automaton is
   intersected with the vocabulary's trie: all words within the distance are
   found, none is missed and no list of pairs is made. Look-alike digits and
   signs cost nothing; groups like rn for m are undone before the search.
4. Candidates are ranked by the word before (pair counts), the distance and the
   frequency; a correction must be explained by look-alike characters.
5. Repair: furniture lines go, split words are joined, misread words are
   replaced, lines are reflowed into paragraphs.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, distinct_texts, materialize, pick

ALPHA = re.compile(r"[^\W\d_]+")
FLUSH = 400_000
VOCABULARY_SHARE = 200_000
# A word must be so many times as frequent as one that may be a misreading of it.
DOUBT = 20
# Words whose candidates a task looks for.
TASK_WORDS = 5000

# Characters that scanners take for one another (read -> meant).
LOOKALIKES = {
    "0": "oóõ", "1": "ilíjt", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bé", "8": "b", "9": "gq",
    "!": "il", "@": "a", "+": "t", "$": "s", "|": "li",
    "c": "e", "e": "c", "l": "it", "i": "lj", "t": "f", "f": "t", "h": "b", "b": "h", "u": "n", "n": "u", "j": "i", "q": "g", "g": "q", "s": "5", "v": "y", "y": "v", "í": "l", "ı": "i",
}
# Groups of characters that look like others (read, meant).
GROUPS = [("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("ii", "u"), ("li", "h"), ("lc", "k"), ("nn", "m"), ("ri", "n"), ("iii", "m"), ("ln", "m"), ("fi", "n"), ("ck", "dc")]
SIGNS = "!@+$|"
HAS_SIGN = frozenset(SIGNS)
PLAIN = re.compile(r"[^\W_]+")
TOKEN = re.compile(rf"[^\W_{re.escape(SIGNS)}](?:[^\W_]|[{re.escape(SIGNS)}](?=[^\W\d_]))*")
PAGE = r"(?:(?:p[aá@][g9](?:[i1l]na|e)?|se[i1l]te|fo[l1]ha|f[l1]s?|p)\b\.?)"
NUMBER = r"(?:[0-9]{1,4}|[ivxlc]{1,7})"
PAGE_LINE = re.compile(rf"^[\W_]{{0,4}}{PAGE}?[\W_]{{0,3}}({NUMBER})(?:\s*(?:de|of|von|sur|/)\s*({NUMBER}))?[\W_]{{0,4}}$", re.I)
PAGE_TAIL = re.compile(rf"(?:\s{{2,}}|\s(?={PAGE}|[-\[]\s?[0-9]))[\W_]{{0,3}}({PAGE})?[\W_]{{0,3}}({NUMBER})(?:\s*(?:de|of|von|sur|/)\s*({NUMBER}))?[\W_]{{0,3}}$", re.I)
EXPLICIT = re.compile(rf"^[\W_]*(?:{PAGE}\W*[0-9]|[-–—]\s*[0-9]+\s*[-–—]|\[[0-9]+\])", re.I)
SENTENCE_END = re.compile(r"^\w+[.;,:]$")
COMMENT = re.compile(r"^\s*<!--.*-->\s*$")
HYPHENS = "-­‐¬"
HYPHEN = re.compile(r"([^\W\d_]+)[-­‐¬]\s*$")
MARKUP = ("#", "|", "<!--", "```", "---")
LISTED = re.compile(r"^([-*•>]\s|\d+[.)]\s)")
FOLD = str.maketrans("01235689!@+$|", "oizesbbgiatsl")


def _roman(text: str) -> int | None:
    total, last = 0, 0
    for c in reversed(text.lower()):
        value = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}.get(c)
        if value is None:
            return None
        total += value if value >= last else -value
        last = max(last, value)
    return total


def _number(text: str) -> int | None:
    return int(text) if text.isdigit() else _roman(text)


def _key(line: str) -> str:
    """A line as it is compared with others: letters only, look-alike digits as letters."""
    return "".join(ALPHA.findall(line.lower().translate(FOLD)))


def _grams(key: str) -> Counter:
    return Counter(zip(key, key[1:]))


def _alike(a: str, x: Counter, b: str, y: Counter) -> bool:
    """Whether two keys are one line read twice: at most a quarter of their bigrams differ."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 0.2 * max(len(a), len(b)):
        return False
    return 2 * sum(min(n, y[g]) for g, n in x.items() if g in y) >= 0.75 * (len(a) + len(b) - 2)


def _titled(line: str) -> bool:
    long = [w for w in ALPHA.findall(line) if len(w) >= 4]
    return bool(long) and sum(w[0].isupper() for w in long) >= 0.6 * len(long)


def _counting(values: list[int]) -> bool:
    """Whether numbers count on as page numbers do: at least two, most steps upward by a small amount."""
    steps = [b - a for a, b in zip(values, values[1:])]
    return bool(steps) and sum(1 <= s <= 3 for s in steps) >= max(1, 0.6 * len(steps))


class Furniture:
    """The running lines and page numbers of a text, by line index."""

    def __init__(self, lines: list[str]):
        self.running: set[int] = set()
        self.numbers: set[int] = set()
        tails: dict[int, int] = {}
        alone: list[tuple[int, int, bool]] = []
        keys: dict[int, str] = {}
        for i, line in enumerate(lines):
            text = line.strip()
            if not text or len(text) > 140 or text.startswith(MARKUP):
                continue
            # "2025." is the end of a wrapped sentence
            if len(text) <= 24 and not SENTENCE_END.match(text) and (m := PAGE_LINE.match(text)) and (value := _number(m.group(1))) is not None:
                alone.append((i, value, bool(EXPLICIT.match(text)) or bool(m.group(2))))
                continue
            if LISTED.match(text):
                continue
            tail = PAGE_TAIL.search(text, max(0, len(text) - 30))
            key = _key(text[: tail.start()] if tail else text)
            if len(key) >= 8:
                keys[i] = key
                if tail and (value := _number(tail.group(2))) is not None:
                    tails[i] = value
        # running lines are written as titles at least half of the time: only those found groups, the rest may join
        titled = {i for i in keys if _titled(lines[i])}
        groups: list[tuple[str, Counter, list[int]]] = []
        for i in sorted(keys, key=lambda i: i not in titled) if titled else []:
            grams = _grams(keys[i])
            for known, own, members in groups:
                if _alike(known, own, keys[i], grams):
                    members.append(i)
                    break
            else:
                if i in titled:
                    groups.append((keys[i], grams, [i]))
        for *_, members in groups:
            if len(members) >= 2 and len(titled.intersection(members)) * 2 >= len(members):
                self.running.update(members)
                members.sort()
                if _counting([tails[i] for i in members if i in tails]):
                    self.numbers.update(i for i in members if i in tails)
        if _counting([v for _, v, _ in alone]) or sum(e for *_, e in alone) >= 2:
            self.numbers.update(i for i, _, _ in alone)
        elif any(e for *_, e in alone):
            self.numbers.update(i for i, _, e in alone if e)


def split_words(lines: list[str], skip: set[int], vocabulary: dict[str, int] | set[str]) -> list[tuple[int, int, str]]:
    """(line, next line, joined word) of the words hyphenated across lines; furniture, comments and blank lines lie between."""
    found = []
    for i, line in enumerate(lines):
        if i in skip or not _hyphenated(line):
            continue
        m = HYPHEN.search(line, max(0, len(line) - 60))
        j = i + 1
        while j < len(lines) and (j in skip or not lines[j].strip() or COMMENT.match(lines[j])):
            j += 1
        rest = m and ALPHA.match(lines[j].lstrip()) if j < len(lines) else None
        if not rest or not rest.group()[0].islower():
            continue
        left, right = m.group(1), rest.group()
        joined = (left + right).lower()
        hard = line.rstrip()[-1] in "-‐"
        if joined in vocabulary or not hard or right.lower() not in vocabulary:
            found.append((i, j, left + right))
    return found


def _hyphenated(line: str) -> bool:
    end = line.rstrip()
    return len(end) > 1 and end[-1] in HYPHENS and end[-2].isalpha()


def unknown_words(lines: list[str], skip: set[int], split: list[tuple[int, int, str]], vocabulary: dict[str, int]) -> set[tuple[str, str]]:
    """(word before, word) of the body's words outside the vocabulary; parts of split words, links and comments are left out."""
    ends, starts = {i for i, *_ in split}, {j for _, j, _ in split}
    before = ""
    found: set[tuple[str, str]] = set()
    broken = False
    for i, line in enumerate(lines):
        if i in skip or not line or "://" in line or COMMENT.match(line):
            continue
        words = PLAIN.findall(line) if HAS_SIGN.isdisjoint(line) else TOKEN.findall(line)
        if i in starts or broken:
            words = words[1:]
        broken = _hyphenated(line)
        if i in ends or broken:
            words = words[:-1]
        for k, word in enumerate(words):
            if word not in vocabulary and word.lower() not in vocabulary:
                found.add((words[k - 1].lower() if k else before, word))
        if words:
            before = words[-1].lower()
    return found


def count_words(df: DataFrame, *, text_col: str) -> DataFrame:
    """(before, word, n): counts of lower-cased words (before is null) and of pairs of words with lower-case letters only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single: Counter = Counter()
        pairs: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = [(None, w, n) for w, n in single.items()] + [(a, b, n) for (a, b), n in pairs.items()]
            single.clear()
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["before", "word", "n"])

        for b in chunks(batches, 1000):
            for text in b.column(0).to_pylist():
                words = ALPHA.findall(text)
                single.update([w.lower() for w in words])
                pairs.update([(x, y) for x, y in zip(words, words[1:]) if x.islower() and y.islower()])
            if len(single) + len(pairs) > FLUSH:
                yield out()
        yield out()

    return distinct_texts(pick(df, text=text_col).where("text IS NOT NULL")).mapInArrow(run, "before string, word string, n long").groupBy("before", "word").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> dict[str, int]:
    """Words of at least a VOCABULARY_SHARE-th of all words (three at least), the doubtful ones left out: no more than VOCABULARY_SHARE words.

    Doubtful words are found by the automaton, in the tasks that hold them.
    """
    total = counts.where("before IS NULL").agg(F.sum("n")).first()[0] or 0
    least = max(3, math.ceil(total / VOCABULARY_SHARE))
    known = {r.word: r.n for r in counts.where("before IS NULL").where(F.col("n") >= least).select("word", "n").collect()}
    # only a word with a part that look-alikes give, and much rarer than the most frequent word, can be doubtful
    top = max(known.values(), default=0)
    asked = [(w,) for w, n in known.items() if len(w) >= 5 and n * DOUBT <= top]
    if not asked:
        return known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie(known)
        for b in batches:
            out = [w for w in b.column(0).to_pylist() if any(n >= DOUBT * known[w] for _, _, n in corrections(root, known, w))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["word"])

    spark = counts.sparkSession
    doubtful = spark.createDataFrame(asked, "word string").repartition(max(1, len(asked) // TASK_WORDS)).mapInArrow(run, "word string").collect()
    for r in doubtful:
        known.pop(r.word, None)
    return known


# ---------------------------------------------------------------- retrieval


def trie(words: dict[str, int]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def within(root: dict, query: str, distance: int) -> list[tuple[str, int]]:
    """All words of the trie within the edit distance of query, with the distance; look-alikes count as equal.

    The automaton's states are bit sets, one for each number of edits; a branch
    of the trie is left as soon as all of them are empty.
    """
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(query):
        masks[c] |= 1 << i
        if not c.isalpha():
            for meant in LOOKALIKES.get(c, ""):
                masks[meant] |= 1 << i
    accept = 1 << len(query)
    start = [(1 << (k + 1)) - 1 for k in range(distance + 1)]
    found: list[tuple[str, int]] = []
    stack = [(root, start)]
    while stack:
        node, states = stack.pop()
        for c, child in node.items():
            if c == "":
                for k, s in enumerate(states):
                    if s & accept:
                        found.append((child, k))
                        break
                continue
            m = masks.get(c, 0)
            now = [(states[0] & m) << 1]
            for k in range(1, distance + 1):
                now.append(((states[k] & m) << 1) | states[k - 1] | (states[k - 1] << 1) | (now[k - 1] << 1))
            if now[-1]:
                stack.append((child, now))
    return found


def _explained(read: str, meant: str) -> int | None:
    """How many misread characters turn `meant` into `read`, all of them look-alikes; None if anything else differs."""
    best: dict[tuple[int, int], int] = {(0, 0): 0}
    for i in range(len(read) + 1):
        for j in range(len(meant) + 1):
            cost = best.get((i, j))
            if cost is None:
                continue
            steps = []
            if i < len(read) and j < len(meant):
                if read[i] == meant[j]:
                    steps.append((1, 1, 0))
                elif meant[j] in LOOKALIKES.get(read[i], ""):
                    steps.append((1, 1, 1))
            steps += [(len(a), len(b), 1) for a, b in GROUPS if read.startswith(a, i) and meant.startswith(b, j)]
            for di, dj, c in steps:
                at = (i + di, j + dj)
                if best.get(at, 99) > cost + c:
                    best[at] = cost + c
    return best.get((len(read), len(meant)))


def corrections(root: dict, words: dict[str, int], form: str) -> list[tuple[str, int, int]]:
    """(candidate, misread characters, frequency) for a word outside the vocabulary."""
    read = form.lower()
    mixed = not read.isalpha()
    found = {w for w, _ in within(root, read, 1)}
    for a, b in GROUPS:
        # groups are several edits at once: the automaton runs on the word with one group undone
        at = read.find(a)
        while at >= 0:
            found.update(w for w, _ in within(root, read[:at] + b + read[at + len(a) :], 1 if mixed else 0))
            at = read.find(a, at + 1)
    out = []
    for w in found:
        errors = _explained(read, w)
        if errors and errors <= max(1, len(w) // 4) and (mixed or (len(w) >= 5 and errors == 1)):
            out.append((w, errors, words[w]))
    return out


# ---------------------------------------------------------------- operators


def _mixed(word: str) -> bool:
    """A word of letters with digits or signs inside that is no code: mostly lower-case letters, look-alikes only."""
    odd = [c for c in word if not c.isalpha()]
    letters = [c for c in word if c.isalpha()]
    return (
        bool(odd)
        and len(letters) >= 2
        and len(odd) <= max(1, len(word) // 3)
        and all(c in LOOKALIKES for c in odd)
        and sum(c.islower() for c in letters) >= len(letters) - 1
        and any(c.islower() for c in letters)
    )


def _odd_capital(word: str) -> bool:
    """A word in capitals but for an l, which is an I misread."""
    return "l" in word[1:] and word.replace("l", "I").isupper()


def _suspect(word: str, vocabulary: dict[str, int], latin: frozenset[str]) -> bool:
    if len(word) < 3 or word.lower() in vocabulary:
        return False
    if not word.isalpha():
        return _mixed(word)
    return len(word) >= 5 and (word.islower() or word.isupper() or word[1:].islower() or _odd_capital(word)) and latin.issuperset(word.lower())


def inspect(df: DataFrame, vocabulary: dict[str, int], *, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, header, pageno, hyphen, suspects array<struct<before, form>>) of the texts in which anything was found."""
    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("id").cast("long")).withColumn("digest", F.xxhash64("text"))
    uses: Counter = Counter()
    for w, n in vocabulary.items():
        uses.update(dict.fromkeys(w, n))
    top = max(uses.values(), default=0)
    latin = frozenset(c for c, n in uses.items() if n * 5000 >= top)
    pair = pa.list_(pa.struct([("before", pa.string()), ("form", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1000):
            rows = []
            for id_, text, digest in zip(*(b.column(k).to_pylist() for k in range(3))):
                lines = text.split("\n")
                f = Furniture(lines)
                skip = f.running | f.numbers
                split = split_words(lines, skip, vocabulary)
                suspects = {(before, w) for before, w in unknown_words(lines, skip, split, vocabulary) if _suspect(w, vocabulary, latin)}
                if f.running or f.numbers or split or suspects:
                    rows.append((id_, digest, bool(f.running), bool(f.numbers), bool(split), [{"before": x, "form": y} for x, y in suspects]))
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pair)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["id", "digest", "header", "pageno", "hyphen", "suspects"])

    return src.mapInArrow(run, "id long, digest long, header boolean, pageno boolean, hyphen boolean, suspects array<struct<before: string, form: string>>")


def misread_words(inspected: DataFrame, counts: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(id, form, right): the suspects that are misread words of the vocabulary, with the best candidate.

    A candidate must be DOUBT times as frequent as the form, copies of one text
    counted once, unless digits or signs give the misreading away. Words of
    letters and look-alike digits that no candidate explains (names) are misread
    as well, with right null.
    """
    seen, candidates = _candidates(inspected, vocabulary)
    pairs = counts.where("before IS NOT NULL").select("before", F.col("word").alias("right"), F.col("n").alias("pair_n"))
    ranked = seen.join(candidates, "form").join(pairs, ["before", "right"], "left")
    return ranked.groupBy("id", "form").agg(
        F.max_by("right", F.struct(F.coalesce("pair_n", F.lit(0)) > 0, -F.col("errors"), F.coalesce("pair_n", F.lit(0)), "freq", "right")).alias("right")
    )


def _candidates(inspected: DataFrame, vocabulary: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """(id, before, form) of the suspects, and (form, right, errors, freq) of what they may be."""
    seen = inspected.select("id", "digest", F.explode("suspects").alias("s")).select("id", "digest", "s.before", "s.form")
    # a form is a few bytes and a millisecond or so: tasks are cut by their number, not by their size
    forms = materialize(seen.groupBy("form").agg(F.count_distinct("digest").alias("uses")), "forms")
    forms = forms.repartition(max(1, forms.count() // TASK_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie(vocabulary)
        for b in batches:
            rows: list[tuple] = []
            for form, uses in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                mixed = not form.isalpha()
                found = [(form, w, e, n) for w, e, n in corrections(root, vocabulary, form) if mixed or n >= DOUBT * uses]
                if mixed and not found and _name_like(form):
                    found = [(form, None, 9, 0)]
                rows += found
            types = (pa.string(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["form", "right", "errors", "freq"])

    return seen.drop("digest"), materialize(forms.mapInArrow(run, "form string, right string, errors int, freq long"), "candidates")


def _name_like(form: str) -> bool:
    """A capitalised word of five or more characters with one or two look-alikes within or at its end: a misread name."""
    return form[0].isupper() and len(form) >= 5 and sum(not c.isalpha() for c in form) <= 2 and form[1:2].islower() and form.lower().strip("0123456789") != "" and not re.search(r"\d{2,}", form)


def noise_kinds(df: DataFrame, *, id_col: str, text_col: str, least_misread: int = 2) -> DataFrame:
    """(id, noise_kind) of every text: hyphen, misread, header, pageno.

    misread needs least_misread different misread words, so that one rare word
    that resembles a common one makes no scan.

    Null ids and texts, and empty texts, have no row. Rows of the same id are
    taken together.
    """
    counts = materialize(count_words(df, text_col=text_col), "words")
    vocabulary = vocabulary_of(counts)
    found = materialize(inspect(df, vocabulary, id_col=id_col, text_col=text_col), "inspected")
    kinds = F.array_compact(F.array(*[F.when(F.col(k), F.lit(k)) for k in ("header", "pageno", "hyphen")]))
    plain = found.select("id", F.explode(kinds).alias("noise_kind"))
    # which candidate is right matters to the repair only, so no pair counts here
    seen, candidates = _candidates(found, vocabulary)
    misread = seen.join(candidates.select("form").distinct(), "form", "left_semi").groupBy("id").agg(F.count_distinct("form").alias("n")).where(F.col("n") >= least_misread).select("id", F.lit("misread").alias("noise_kind"))
    return plain.unionByName(misread).distinct()


def repair_text(text: str, right: dict[str, str], vocabulary: dict[str, int] | set[str]) -> str:
    """The text without furniture and page comments, split words joined, misread words replaced, lines reflowed."""
    lines = text.split("\n")
    f = Furniture(lines)
    skip = f.running | f.numbers
    paragraphs: list[list[str]] = [[]]
    joins = {i: j for i, j, _ in split_words(lines, skip, vocabulary)}
    glue = False
    removed = False
    for i, line in enumerate(lines):
        if i in skip or COMMENT.match(line):
            removed = True
            continue
        clean = line.rstrip()
        if not clean.strip():
            # blank lines around removed furniture are a page break, not a paragraph's end
            if not glue and not (removed and paragraphs[-1] and not re.search(r"[.!?:;|\"”]$", paragraphs[-1][-1].rstrip())):
                paragraphs.append([])
            continue
        removed = False
        if right:
            clean = TOKEN.sub(lambda m: _cased(m.group(), right), clean)
        structured = clean.lstrip().startswith(MARKUP) or LISTED.match(clean.lstrip())
        if glue:
            paragraphs[-1][-1] += clean.lstrip()
        elif structured or not paragraphs[-1] or paragraphs[-1][-1].lstrip().startswith(MARKUP):
            if paragraphs[-1] and paragraphs[-1][-1].lstrip().startswith("#"):
                paragraphs.append([])
            paragraphs[-1].append(clean)
        else:
            paragraphs[-1][-1] += " " + clean.strip()
        glue = i in joins
        if glue:
            paragraphs[-1][-1] = HYPHEN.sub(lambda m: m.group(1), paragraphs[-1][-1])
    return "\n\n".join("\n".join(p) for p in paragraphs if p)


def _cased(word: str, right: dict[str, str]) -> str:
    fixed = right.get(word)
    if not fixed:
        return word
    return fixed.upper() if word.isupper() else fixed[0].upper() + fixed[1:] if word[0].isupper() else fixed


def repaired(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(id, repaired) of the texts with any noise. Null ids and texts have no row."""
    counts = materialize(count_words(df, text_col=text_col), "words")
    vocabulary = vocabulary_of(counts)
    found = materialize(inspect(df, vocabulary, id_col=id_col, text_col=text_col), "inspected")
    fixes = misread_words(found, counts, vocabulary).groupBy("id").agg(F.collect_list(F.struct("form", "right")).alias("fixes"))
    noisy = found.groupBy("id").agg(F.max(F.col("header") | F.col("pageno") | F.col("hyphen")).alias("laid_out")).join(fixes, "id", "left").where("laid_out OR fixes IS NOT NULL")
    src = pick(df, id=id_col, text=text_col).where("id IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    known = set(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 500):
            out = [repair_text(t, {f["form"]: f["right"] for f in fx or [] if f["right"]}, known) for t, fx in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["id", "repaired"])

    return src.join(noisy.select("id", "fixes"), "id").mapInArrow(run, "id long, repaired string")
