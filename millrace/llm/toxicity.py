"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded texts, normalised by length.

The lexicon is learned from labelled documents: whole words and word beginnings that are
much more frequent in toxic ones.  Folding undoes look-alike letters, accents, digits for
letters and hidden characters, so that a disguised word meets its entry.  An exception
phrase takes back what lies inside it.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import deque
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Batches, in_slices, mapped, whole_texts
from millrace.session import materialise

# Characters written for letters they resemble.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
CYRILLIC = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h"}
GREEK = {"α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
HIDDEN = "­​‌‍⁠﻿"

LEXICON_ROWS = 20_000  # labelled rows that are learned from, at most
LEXICON_ENTRIES = 4_000  # entries with the strongest evidence that are kept
BEGINNINGS = (4, 5, 6)  # lengths of the word beginnings that are learned
LEAST_DOCS = 4  # toxic texts an entry occurs in at least
WINDOW_WORDS = 200  # words whose weights add up
LEAST_EVIDENCE = 1.0  # lower bound of its log odds ratio


def folding() -> dict[int, str]:
    """The translation table: look-alikes and digits as listed, accented and wide letters by decomposition."""
    table = {ord(c): s for c, s in (DIGITS | CYRILLIC | GREEK).items()}
    table |= {ord(c.upper()): s for c, s in (CYRILLIC | GREEK).items()}
    table |= {ord(c): "" for c in HIDDEN}
    for code in (*range(0xC0, 0x250), *range(0x300, 0x370), *range(0xFF10, 0xFF5B)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if plain != chr(code):
            table[code] = "".join(DIGITS.get(c, c) for c in plain)
    return table


def folded(text: str, table: dict[int, str], rest: re.Pattern = re.compile(r"[\W_]+")) -> str:
    """The folded words of a text, each with one space before and after."""
    return f" {rest.sub(' ', text.lower().translate(table)).strip()} "


def is_held_out(id_col: str | Column, parts: int = 5, part: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a row without an id counts as held out."""
    rest = F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col)
    return F.coalesce(rest % parts == part, F.lit(True))


@dataclass(frozen=True)
class Model:
    """Lexicon, exceptions and the curve from weight to probability."""

    weights: dict[str, float]  # " word " or " begin"
    exceptions: tuple[str, ...]  # " words of a phrase "
    slope: float
    offset: float


def _copy(text: str) -> bytes:
    """The MD5 of a whole folded text, by which copies are known."""
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def _entries(text: str) -> list[str]:
    out = set()
    for word in set(text.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in BEGINNINGS if len(word) > n)
    return sorted(out)


def labelled(docs: DataFrame, labels: DataFrame, rows: int = LEXICON_ROWS) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``rows`` labelled rows that are not held out, chosen by a hash of the id.

    A document with several labels is toxic if one of them says so; null labels do not count.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isNotNull() & ~is_held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return materialise(docs.join(F.broadcast(marks), "doc_id"), "labelled")


def learn_weights(sample: DataFrame) -> dict[str, float]:
    """Lexicon entries and the lower bound of their log odds ratio between toxic and other texts.

    Texts of one label that are equal when folded count once.  An entry that a shorter one covers as well is left out.
    """

    def run(batches: Batches) -> Batches:
        table = folding()
        for batch in in_slices(batches, most_bytes=1 << 20):  # entries take many times the bytes of their text
            texts = [folded(t, table) for t in batch.column("text").to_pylist()]
            columns = [
                batch.column("doc_id"),
                pa.array([_copy(t) for t in texts], pa.binary()),
                batch.column("toxic"),
                pa.array([_entries(t) for t in texts], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "toxic", "entries"])

    read = mapped(sample, run, "doc_id long, copy binary, toxic int, entries array<string>")
    once = read.groupBy("copy", "toxic").agg(F.min_by("entries", "doc_id").alias("entries"))
    once = materialise(once, "entries")
    total = once.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    toxic, other = total[0], total[1] - total[0]
    counts = (
        once.select("toxic", F.explode("entries").alias("entry"))
        .groupBy("entry")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .filter(F.col("t") >= LEAST_DOCS)
    )
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    ratio = F.log(t / F.lit(toxic + 1.0)) - F.log(c / F.lit(other + 1.0))
    strong = counts.withColumn("weight", ratio - 2 * F.sqrt(1 / t + 1 / c)).filter(F.col("weight") >= LEAST_EVIDENCE)
    found = strong.orderBy(F.desc("weight"), "entry").limit(LEXICON_ENTRIES).select("entry", "weight").collect()
    kept: dict[str, float] = {}
    for entry, weight in sorted(found, key=lambda r: (len(r[0].rstrip()), r[0].endswith(" "), r[0])):
        shorter = [kept[entry[:n]] for n in range(2, len(entry)) if entry[:n] in kept]
        if not shorter or max(shorter) < 0.9 * weight:
            kept[entry] = weight
    return kept


def matcher(weights: dict[str, float], exceptions: Sequence[str]) -> Callable[[str], list[tuple[int, float]]]:
    """A function from a folded text to where lexicon words begin and the weight of each, outside exceptions."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for entry, weight in weights.items():
        automaton.add_word(entry, (len(entry), weight))
    for phrase in exceptions:
        automaton.add_word(phrase, (len(phrase), None))
    if not len(automaton):
        return lambda text: []
    automaton.make_automaton()

    def match(text: str) -> list[tuple[int, float]]:
        best: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (length, weight) in automaton.iter(text):
            start = end - length + 1
            if weight is None:
                harmless.append((start, end))
            else:
                best[start] = max(weight, best.get(start, 0.0))
        return [(s, w) for s, w in best.items() if not any(a <= s < b for a, b in harmless)]

    return match


def strength(text: str, found: Sequence[tuple[int, float]], window: int = WINDOW_WORDS) -> float:
    """The largest weight within any ``window`` words of the folded text, normalised by the length of text or window in words.

    A long text is as strong as its strongest part: a constant share of weak words, however
    long it goes on, adds up over one window only.
    """
    inside: deque[tuple[int, float]] = deque()
    best = total = 0.0
    word = before = 0
    for start, weight in sorted(found):
        word += text.count(" ", before, start)
        before = start
        inside.append((word, weight))
        total += weight
        while inside[0][0] <= word - window:
            total -= inside.popleft()[1]
        best = max(best, total)
    return best / math.log2(8 + min(text.count(" ") - 1, window))


def _contexts(text: str, found: Sequence[tuple[int, float]]) -> list[str]:
    """The phrases of a found word with the word before and with the one after."""
    out = set()
    for start, _ in found:
        end = text.index(" ", start + 1)
        before = text.rfind(" ", 0, start) if start else -1
        after = text.find(" ", end + 1)
        if before >= 0:
            out.add(text[before : end + 1])
        if after > end + 1:
            out.add(text[start : after + 1])
    return sorted(out)


def learn(docs: DataFrame, labels: DataFrame, rows: int = LEXICON_ROWS, exceptions: Sequence[str] = ()) -> Model:
    """Learn lexicon, exception phrases and curve from the labelled rows that are not held out.

    ``docs`` has ``doc_id`` and ``text`` without nulls (see ``whole_texts``).  Phrases around
    lexicon words found in three or more harmless texts and in no toxic one are exceptions,
    beside the given ones.  Without a toxic row the lexicon is empty and all scores are low.
    """
    sample = labelled(docs, labels, rows)
    weights = learn_weights(sample)
    given = tuple(f" {p.strip()} " for p in exceptions)

    def contexts(batches: Batches) -> Batches:
        table, match = folding(), matcher(weights, given)
        for batch in in_slices(batches):
            texts = [folded(t, table) for t in batch.column("text").to_pylist()]
            phrases = pa.array([_contexts(t, match(t)) for t in texts], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), phrases], ["toxic", "phrases"])

    harmless = (
        mapped(sample, contexts, "toxic int, phrases array<string>")
        .select("toxic", F.explode("phrases").alias("phrase"))
        .groupBy("phrase")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .filter("t = 0 and c >= 3")
        .orderBy(F.desc("c"), "phrase")
        .limit(LEXICON_ENTRIES)
    )
    phrases = given + tuple(r["phrase"] for r in harmless.collect())
    rows_of = mapped(sample, _strengths(weights, phrases, "toxic"), "toxic int, strength double").collect()
    return Model(weights, phrases, *_curve([r[1] for r in rows_of], [r[0] for r in rows_of]))


def _strengths(weights: dict[str, float], exceptions: Sequence[str], keep: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table, match = folding(), matcher(weights, exceptions)
        for batch in in_slices(batches):
            texts = [folded(t, table) for t in batch.column("text").to_pylist()]
            values = pa.array([strength(t, match(t)) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(keep), values], [keep, "strength"])

    return run


def _curve(strengths: Sequence[float], toxic: Sequence[int], ridge: float = 0.01) -> tuple[float, float]:
    """Logistic curve through the sample's strengths by Newton's method; the slope is not negative.

    The ridge holds slope and offset near those of a curve that calls little toxic.
    """
    x = np.stack([np.asarray(strengths, float), np.ones(len(strengths))], 1).reshape(-1, 2)
    y = np.asarray(toxic, float)
    start = np.array([1.0, -2.0])
    beta = start
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * (beta - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
    return max(0.0, float(beta[0])), float(beta[1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text; a null or empty one scores as one without lexicon words.

    Every row, repeated or without an id, gives one row; an empty table gives none.
    """
    whole = mapped(
        whole_texts(docs, id_col, text_col),
        _strengths(model.weights, model.exceptions, "doc_id"),
        "doc_id long, strength double",
    )
    curve = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("strength") + F.lit(model.offset))))
    return whole.select("doc_id", curve.alias("score"))
