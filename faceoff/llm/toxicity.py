"""Toxicity: texts are restored by a noisy-channel decoder, then scored.

A character language model (trigrams of words, counted over all documents)
decodes lattices: digits and symbols may stand for letters, a letter repeated three
times or more for one or two, and letters set apart by spaces or marks for a word.  The
best path through each lattice is found by Viterbi search over the last two
characters.  A word whose lattice has one path is that path, so only odd words are
searched; workers keep those they have met.

The scorer learns how often words and word beginnings of restored texts stand in
toxic documents, from at most ``MAX_FIT_ROWS`` labelled rows (a documented bound).  A
document's evidence is that of its worst word and the number of bad
words, turned into a probability by logistic regression.  Words that are bad with
fewer doubled letters, without the marks between their letters, or with plain
letters for accented, full-width and look-alike ones, and neighbours that are a bad
word together, count too if their lattice's best path is that word.

Defined results: null and empty texts have no evidence and score lowest; without
labels of both kinds every score is the share of ones (0 without labels); a mark is
evidence from ``LEAST_TOXIC`` toxic rows on, or a twentieth of them where that is less (one at least);
very long words are decoded in full; an empty table gives an empty result; rows are
scored one by one; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.llm.common import sample_labelled, written

MAX_FIT_ROWS = 20_000
SUMMARY_ENTRIES = 200_000
CACHE_WORDS = 500_000
LONGEST_CACHED = 64
BEGINNINGS = (4, 5, 6)
LEAST_TOXIC = 4
PRIOR_ROWS = 4.0
SWAP_COST, SQUEEZE_COST, KEEP_COST = 1.0, 0.5, 3.0
BEGIN, END = "^", "\n"

# Letters that a digit or symbol may stand for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "(": "c", "€": "e"}
_EDGES = ".,;:!?\"'()[]{}|#%&*$-_<>/\\"
_MARKS = ".,;:?!\"'()[]{}"
_RUN = re.compile(r"([^\W\d_])\1\1", re.UNICODE)
_DOUBLE = re.compile(r"(.)\1+", re.DOTALL)
# letters set apart by marks
_APART = re.compile(r"[^\W_](?:[._\-*~|/+,:;·•=]+[^\W_]){2,}", re.UNICODE)
# Cyrillic and Greek letters that look like Latin ones
_LOOKS = str.maketrans("аеорсухіѕјԁοανι", "aeopcyxisjdoavi")
_SWAP = "".join(re.escape(c) for c in STANDS_FOR)
_ODD = re.compile(rf"[^\W\d_][{_SWAP}]+[^\W\d_]|^[{_SWAP}]+[^\W\d_]|[^\W\d_][{_SWAP}]+$", re.UNICODE)


# ------------------------------------------------------- language model
def grams(word: str) -> list[str]:
    padded = BEGIN + BEGIN + word + END
    return [padded[k : k + 3] for k in range(len(padded) - 2)]


def packed(text: str) -> int:
    """Up to three characters as a number, 21 bits each."""
    key = 0
    for c in text:
        key = key << 21 | ord(c)
    return key


class Counts:
    """Counts by packed characters, in sorted arrays of 16 bytes an entry."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, which = np.unique(keys, return_inverse=True)
        self.counts = np.zeros(len(self.keys), np.int64)
        np.add.at(self.counts, which, counts)

    def get(self, key: int) -> int:
        at = int(self.keys.searchsorted(key))
        return int(self.counts[at]) if at < len(self.keys) and self.keys[at] == key else 0


class Letters:
    """Log-probability of a character after two others, from the counts of all trigrams."""

    def __init__(self, counts: dict[str, int] | Counts):
        if not isinstance(counts, Counts):
            counts = Counts(np.array(list(map(packed, counts)), np.int64), np.array(list(counts.values()), np.int64))
        self.three = counts
        self.two = Counts(counts.keys >> 21, counts.counts)
        self.pair = Counts(counts.keys & (1 << 42) - 1, counts.counts)
        self.mid = Counts(self.pair.keys >> 21, self.pair.counts)
        self.ends = Counts(counts.keys & (1 << 21) - 1, counts.counts)
        self.total = int(self.ends.counts.sum()) + len(self.ends.keys) + 1
        self.known: dict[str, float] = {}

    def log(self, gram: str) -> float:
        p = self.known.get(gram)
        if p is None:
            key = packed(gram)
            low = (self.ends.get(key & (1 << 21) - 1) + 1) / self.total
            mid = (self.pair.get(key & (1 << 42) - 1) + 5 * low) / (self.mid.get(key >> 21 & (1 << 21) - 1) + 5)
            p = math.log((self.three.get(key) + 5 * mid) / (self.two.get(key >> 21) + 5))
            if len(self.known) < CACHE_WORDS:
                self.known[gram] = p
        return p


def _choices(piece: str, count: int) -> list[tuple[str, float]]:
    """What a character repeated ``count`` times may be, with its cost."""
    if piece in STANDS_FOR:
        return [(x, SWAP_COST) for x in STANDS_FOR[piece]] + [(piece * min(count, 3), KEEP_COST)]
    if count >= 3:
        return [(piece, SQUEEZE_COST), (piece * 2, SQUEEZE_COST), (piece * count, KEEP_COST)]
    return [(piece * count, 0.0)]


def decode(pieces: list[list[tuple[str, float]]], letters: Letters) -> str:
    """Best path through a lattice: per step the strings to choose from and their costs."""
    states = {BEGIN + BEGIN: (0.0, None)}  # last two characters -> score, (previous link, string)
    for step in [*pieces, [(END, 0.0)]]:
        after: dict[str, tuple] = {}
        for state, (score, link) in states.items():
            for text, cost in step:
                s, context = score - cost, state
                for c in text:
                    s += letters.log(context + (END if c == " " else c))
                    context = BEGIN + BEGIN if c == " " else context[1] + c  # a space ends a word
                if context not in after or s > after[context][0]:
                    after[context] = (s, (link, text))
        states = after
    link, out = max(states.values(), key=lambda x: x[0])[1], []
    while link:
        out.append(link[1])
        link = link[0]
    return "".join(reversed(out))[: -len(END)]


def _lattice(word: str) -> list[list[tuple[str, float]]]:
    return [_choices(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", word, re.DOTALL)]


def _apart_lattice(word: str) -> list[list[tuple[str, float]]]:
    """Letters set apart by marks: the marks are nothing, or what they may stand for."""
    return [
        _choices(m[0], 1) if m[0].isalnum() else [("", 0.0)] + (_choices(m[0], 1) if m[0] in STANDS_FOR else [(m[0], KEEP_COST)])
        for m in re.finditer(r"[^\W_]|(?:[\W_])+", word)
    ]


@cache
def _plain(char: str) -> str:
    """The plain letters of a character: none for marks, accents and characters without width."""
    return "".join(filter(str.isalnum, unicodedata.normalize("NFKD", char.translate(_LOOKS)))).lower()


def restore_word(word: str, letters: Letters) -> str:
    """A lower-case word as meant; itself if it is not odd."""
    if word.isalpha() and not _RUN.search(word):
        return word
    core = word.strip(_EDGES) or word
    if _APART.fullmatch(core) and any(map(str.isalpha, core)):
        return decode(_apart_lattice(core), letters)
    if _RUN.search(word) or _ODD.search(core):
        whole = decode(_lattice(core), letters)
        return whole
    if core != word and _ODD.search(word.strip(".,;:?\"'()[]{}")):
        # symbols at an edge may be letters or marks: the better reading of both
        outer = decode(_lattice(word.strip(".,;:?\"'()[]{}")), letters)
        price = lambda w: sum(map(letters.log, grams(w))) / (len(w) + 1)
        return outer if price(outer) > price(core) + SWAP_COST else core
    return core


def restore_spaced(parts: list[str], letters: Letters) -> list[str]:
    """Words meant by single characters set apart: each gap is kept or closed."""
    steps: list = []
    for k, c in enumerate(parts):
        if k:
            steps.append([("", 0.0), (" ", 0.0)])
        steps.append(_choices(c, 1))
    return decode(steps, letters).split()


def alone(word: str) -> str:
    """The character of a word that has one, whatever marks are at its edges; else nothing."""
    if len(word) == 1:
        return word
    core = word.strip(_MARKS)
    return core if len(core) == 1 else ""


class Restorer:
    """A worker's decoder with its cache."""

    def __init__(self, letters: Letters):
        self.letters, self.words = letters, {}

    def word(self, word: str) -> str:
        known = self.words.get(word)
        if known is None:
            known = restore_word(word, self.letters)
            if len(word) <= LONGEST_CACHED:
                if len(self.words) >= CACHE_WORDS:
                    self.words.clear()
                self.words[word] = known
        return known

    def spaced(self, words: list[str]) -> list[str]:
        """Words meant by every run of three or more single characters that are not all alike."""
        found = ((k, alone(w)) for k, w in enumerate(words) if len(w) == 1 or w[0] in _MARKS or w[-1] in _MARKS)
        return self.closed([(k, c) for k, c in found if c])

    def closed(self, singles: list[tuple[int, str]]) -> list[str]:
        """The same from the (place, character) of the single characters."""
        out: list[str] = []
        a = 0
        for b in range(1, len(singles) + 1):
            if b == len(singles) or singles[b][0] != singles[b - 1][0] + 1:
                run = [c for _, c in singles[a:b]]
                if b - a >= 3 and len(set(run)) > 1:
                    out += restore_spaced(run, self.letters)
                a = b
        return out

    def text(self, text: str | None) -> str:
        """The text restored: its words, and after them those that were spaced out."""
        words = (text or "").lower().split()
        return " ".join([self.word(w) for w in words] + self.spaced(words))


def _trigrams(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Packed trigrams of the words that are not odd, and how often they stand in all."""
    cores: Counter = Counter()
    for w, n in words.items():
        core = w if w.isalpha() else w.strip(_EDGES)
        if core and (core.isalpha() or not _ODD.search(core)):
            cores[core] += n
    if not cores:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    body = "".join([BEGIN + BEGIN + w + END for w in cores])
    chars = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    sizes = np.fromiter(map(len, cores), np.int64, len(cores)) + 3
    times = np.repeat(np.fromiter(cores.values(), np.int64, len(cores)), sizes)
    first = np.ones(len(chars), bool)  # no trigram begins at the last two characters of a word
    ends = np.cumsum(sizes)
    first[ends - 1] = first[ends - 2] = False
    at = np.flatnonzero(first)
    found = Counts(chars[at] << 42 | chars[at + 1] << 21 | chars[at + 2], times[at])
    return found.keys, found.counts


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()

    def summary() -> pa.RecordBatch:
        grams_, counts = _trigrams(words)
        words.clear()
        return pa.RecordBatch.from_arrays([pa.array(grams_), pa.array(counts)], names=["gram", "n"])

    for rows in batches:
        for text in rows.column(0).to_pylist():
            words.update((text or "").lower().split())
            if len(words) > SUMMARY_ENTRIES:
                yield summary()
    yield summary()


def language_model(docs: DataFrame, text_col: str = "text") -> Letters:
    """Counts of all trigrams of all documents: 16 bytes for each distinct one."""
    counts = docs.select(text_col).mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    return Letters(Counts(found["gram"].to_numpy(), found["n"].to_numpy()))


# ---------------------------------------------------------------- scoring
def marks_of(word: str) -> list[str]:
    """What of a restored word can be evidence: itself and its beginnings."""
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) >= n)] if len(word) >= 3 else []


class Scorer:
    """Evidence of words, and the probability that it makes."""

    def __init__(self, letters: Letters, evidence: dict[str, float], constant: float | None = None):
        self.letters, self.evidence, self.constant = letters, evidence, constant
        self.theta = np.array([0.0, 0.0, 0.0])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("letters", "evidence", "constant", "theta")}

    def _prepare(self) -> None:
        """What a worker keeps beside the model: its caches, and what can begin evidence."""
        self.restorer, self.known = Restorer(self.letters), {}
        self.bad = {m[1:] for m, share in self.evidence.items() if m[0] == "=" and share > 0.5}
        self.heads = {w[:n] for w in self.bad for n in range(1, len(w))}
        self.single = {_DOUBLE.sub(r"\1", w) for w in self.bad}
        self.rims = {w[0] + w[-1] for w in self.bad}  # squeezing keeps a word's first and last letter
        self.starts = {m.removeprefix("=")[:3] for m in self.evidence}  # marks are three letters or more

    def _of(self, word: str) -> float:
        if word[:3] not in self.starts:
            return 0.0
        return max((self.evidence.get(m, 0.0) for m in marks_of(word)), default=0.0)

    def _word(self, word: str) -> float:
        restored = restore_word(word, self.letters)
        found = self._of(restored)
        if not found and restored and restored[0] + restored[-1] in self.rims and _DOUBLE.sub(r"\1", restored) in self.single:
            fewer = [[(m[1] * k, SQUEEZE_COST * (k < len(m[0]))) for k in range(1, len(m[0]) + 1)] for m in re.finditer(r"(.)\1*", restored, re.DOTALL)]
            found = self._of(decode(fewer, self.letters))
        if not found and not (word.isascii() and word.isalpha()):
            found = self._hidden(word)
        return found

    def _hidden(self, word: str) -> float:
        """Evidence of a word that is bad without the marks between its letters and with plain letters."""
        core = word.strip(_EDGES)
        if not core or (rim := _plain(core[0]) + _plain(core[-1])) not in self.rims and len(rim) == 2:
            return 0.0
        steps = [(c, _plain(c)) for c in core]
        plain = "".join(p for _, p in steps)
        if plain not in self.bad:
            return 0.0
        best = decode([[(p, 0.0)] if p else [("", 0.0), (c, KEEP_COST)] for c, p in steps], self.letters)
        return self._of(plain) if best == plain else 0.0

    def _together(self, words: list[str], at: list[int]) -> list[float]:
        """Evidence of neighbours that are a bad word together; ``at`` are the places where one may begin."""
        found = []
        for k in at:
            parts, word = [words[k].strip(_EDGES)], ""
            while (word := "".join(parts)) in self.heads and k + len(parts) < len(words):
                parts.append(words[k + len(parts)].strip(_EDGES))
                if not parts[-1] or parts[-1] in self.bad:
                    break
                if (word := word + parts[-1]) in self.bad and parts[0] not in self.bad:
                    gap = [[("", 0.0), (" ", 0.0)]]
                    steps = [step for p in parts for step in [*gap, *([(c, 0.0)] for c in p)]][1:]
                    if decode(steps, self.letters) == word:
                        found.append(self._of(word))
        return found

    def _entry(self, word: str) -> tuple[float, str, bool] | int:
        """(evidence, the character if there is one alone, whether a bad word begins so); 0 for all other words."""
        value, core = self._word(word), word.strip(_EDGES)
        if not value and len(word) > 1 and core not in self.heads and (len(core) > 1 or not alone(word)):
            return 0
        return value, alone(word), core in self.heads

    def measure(self, text: str | None) -> tuple[float, float]:
        """(evidence of the worst word, log of one plus the bad words)."""
        if not hasattr(self, "known"):
            self._prepare()
        words, known = (text or "").lower().split(), self.known
        entries = list(map(known.get, words))
        if None in entries:
            for k in [k for k, entry in enumerate(entries) if entry is None]:
                word = words[k]
                if (entry := known.get(word)) is None:
                    entry = self._entry(word)
                    if len(word) <= LONGEST_CACHED:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        known[word] = entry
                entries[k] = entry
        told = [(k, *entries[k]) for k in compress(range(len(words)), entries)]
        values = [value for _, value, _, _ in told]
        values += [self._of(w) for w in self.restorer.closed([(k, c) for k, _, c, _ in told if c])]
        values += self._together(words, [k for k, _, _, head in told if head])
        bad = sum(v > 0.5 for v in values) if self.evidence else 0
        return max(values, default=0.0), math.log1p(bad)

    def probability(self, measured: np.ndarray) -> np.ndarray:
        x = np.concatenate([measured.reshape(-1, 2), np.ones((len(measured), 1))], 1)
        return 1 / (1 + np.exp(-np.clip(x @ self.theta, -30, 30)))

    def learn(self, measured: np.ndarray, y: np.ndarray) -> None:
        x = np.concatenate([measured, np.ones((len(measured), 1))], 1)
        for _ in range(50):
            p = self.probability(measured)
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
            self.theta = self.theta + np.linalg.solve(h, x.T @ (y - p) - 0.1 * self.theta)


def fit(docs: DataFrame, labels: DataFrame, letters: Letters, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_FIT_ROWS) -> Scorer:
    """The scorer of at most ``max_rows`` labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    # read three times: written once, as finding its rows takes a pass over the documents
    sample = written(sample_labelled(docs, labels, label_col, max_rows, id_col, text_col), "toxic-sample")
    shared = spark.sparkContext.broadcast(letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, found = Restorer(shared.value), {}
        for rows in batches:
            for text, label in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                words = set((text or "").lower().split())
                restored = {restorer.word(w) for w in words} | set(restorer.spaced((text or "").lower().split()))
                for m in {m for w in restored for m in marks_of(w)}:
                    found.setdefault(m, [0, 0])[label] += 1
        yield pa.RecordBatch.from_pydict(
            {"mark": list(found), "clean": [n[0] for n in found.values()], "toxic": [n[1] for n in found.values()]},
            pa.schema([("mark", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]),
        )

    kinds = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return Scorer(letters, {}, float(next(iter(kinds), 0)))
    prior = kinds[1] / (kinds[0] + kinds[1])
    share = (F.col("toxic") + PRIOR_ROWS * prior) / (F.col("toxic") + F.col("clean") + PRIOR_ROWS)
    least = min(LEAST_TOXIC, max(1, kinds[1] // 20))
    marks = (
        sample.mapInArrow(count, "mark string, clean long, toxic long")
        .groupBy("mark").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= least)
        .select("mark", share.alias("share")).filter(F.col("share") > max(2 * prior, 0.5))
    )
    scorer = Scorer(letters, {r["mark"]: r["share"] for r in marks.collect()})
    trained = spark.sparkContext.broadcast(scorer)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = np.array([trained.value.measure(t) for t in rows.column(0).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), rows.column(1)], names=["worst", "bad", "label"])

    rows = sample.mapInArrow(measure, "worst double, bad double, label int").toPandas().sort_values(["worst", "bad", "label"])
    scorer.learn(rows[["worst", "bad"]].to_numpy(float), rows["label"].to_numpy(float))
    return scorer


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for rows in batches:
            if own.constant is not None:
                found = np.full(rows.num_rows, own.constant)
            else:
                found = own.probability(np.array([own.measure(t) for t in rows.column(1).to_pylist()]).reshape(-1, 2))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.float64())], names=[id_col, "score"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
