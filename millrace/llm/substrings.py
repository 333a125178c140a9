"""Substring deduplication by repeated-phrase automata.

A window is a number of consecutive words of one document; a word goes if a window that
covers it occurs anywhere else.  The steps:

1. Every window names an anchor: the phrase of ``ANCHOR`` words in it with the smallest
   hash.  Equal windows name equal anchors, and neighbouring windows mostly share theirs.
   Anchors are counted; a window whose anchor occurs once cannot recur.
2. The stretch of text under each recurring anchor's windows is cut out.  Equal stretches
   fold into one with a count in the task that cut them, before they meet.
3. A shard holds the stretches of its anchors.  It confirms which windows recur by their
   words, compiles these into an Aho-Corasick automaton over word symbols and streams every
   stretch through it, which locates all occurrences.
4. Each document collects what was located in its stretches.

Since a stretch visits the shard of its anchor alone, the work grows with the text, where
running all text through all automata would grow with its square.  An anchor with very many
occurrences (a line on a third of all pages) is replaced by the windows themselves, each
with a key of its own, so that no shard collects one phrase's neighbourhoods.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Batches, free_name, in_slices, mapped, numbered
from millrace.session import materialise

WINDOW = 35
ANCHOR = 8
HOT = 10_000  # occurrences above which an anchor's windows are taken one by one
SHARD_WORDS = 200_000  # words, before folding, whose stretches make up one automaton

STEP, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers (the finaliser of SplitMix64, a fixed bijection)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts, and where each text's words begin (one more at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    word = ~space
    before = np.concatenate([[False], word[:-1]])
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(space & before)
    values = _mixed(np.arange(1, 257, dtype=np.uint64))[data]
    values *= _powers(STEP, len(data))
    values[space] = 0
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    hashes = _mixed((total[ends] - total[starts]) * _powers(INVERSE, len(data))[starts])
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return hashes, np.searchsorted(starts, firsts)


def anchors(texts: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the runs of windows with one anchor: ``first << 8 | number - 1``, and the anchor's hash."""
    hashes, bounds = word_hashes(texts)
    n, span = len(hashes), window - anchor + 1
    if n < window:
        return [(np.empty(0, np.int64), np.empty(0, np.uint64)) for _ in texts]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(STEP, n), dtype=np.uint64)])
    value = _mixed((total[anchor:] - total[:-anchor]) * _powers(INVERSE, n)[: n - anchor + 1])
    grams = value
    place = np.arange(len(value))
    width = 1
    while width < span:  # leftmost least of ever wider stretches
        step = min(width, span - width)
        less = value[step:] < value[:-step]
        value = np.where(less, value[step:], value[:-step])
        place = np.where(less, place[step:], place[:-step])
        width += step
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    valid = owner[: n - window + 1] == owner[window - 1 :]
    at = np.flatnonzero(valid)
    chosen = place[at]
    fresh = np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(at) != 1)]) if len(at) else np.empty(0, bool)
    first = np.flatnonzero(fresh)
    number = np.diff(np.concatenate([first, [len(at)]]))
    start, text = at[first], owner[at[first]]
    packed = (start - bounds[text]) << 8 | (number - 1)
    split = np.searchsorted(text, np.arange(1, len(texts)))
    return list(zip(np.split(packed, split), np.split(grams[chosen[first]], split)))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (a hash of id and text), ``doc_id``, ``text``: rows equal in both share their row."""
    return docs.select(
        _row_of(id_col, text_col).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def _anchored(window: int, anchor: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches, most_bytes=2 << 20):
            found = anchors([t.encode() for t in batch.column("text").to_pylist()], window, anchor)
            offsets = np.concatenate([[0], np.cumsum([len(a) for a, _ in found])]).astype(np.int32)
            runs = np.concatenate([a for a, _ in found]).astype(np.int64)
            hashes = np.concatenate([h for _, h in found]).view(np.int64)
            columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (runs, hashes)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", "runs", "anchors"])

    return run


def recurring_runs(rows: DataFrame, window: int, anchor: int, hot: int) -> DataFrame:
    """``row, runs``: each document's runs of windows whose anchor occurs more than once, with the anchor and whether it is hot."""
    held = materialise(mapped(rows, _anchored(window, anchor), "row long, runs array<long>, anchors array<long>"), "anchors")
    counts = held.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n"))
    # Written, so that the join has a shuffle of its own on both sides and can split a hot anchor.
    again = materialise(counts.filter("n > 1").select("anchor", (F.col("n") > hot).alias("hot")), "recurring")
    pairs = held.select("row", F.explode(F.arrays_zip("runs", "anchors")).alias("x"))
    hits = pairs.select("row", F.col("x.runs").alias("run"), F.col("x.anchors").alias("anchor")).join(again, "anchor")
    return materialise(hits.groupBy("row").agg(F.collect_set(F.struct("run", "anchor", "hot")).alias("runs")), "runs")


def _cut(batches: Batches, window: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Row, first word, key and text of the stretch under each run; a hot run gives one for each window."""
    import xxhash

    for batch in in_slices(batches, most_bytes=2 << 20):
        for row, text, runs in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "runs"))):
            words = text.encode().split()
            for x in runs:
                start, number = x["run"] >> 8, (x["run"] & 255) + 1
                if start + number + window - 1 > len(words):
                    continue  # another text with this hash
                if not x["hot"]:
                    yield row, start, x["anchor"], b" ".join(words[start : start + number + window - 1])
                    continue
                for s in range(start, start + number):
                    stretch = b" ".join(words[s : s + window])
                    yield row, s, xxhash.xxh64_intdigest(stretch) - (1 << 63), stretch


def digest(stretch: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(stretch, 7) - (1 << 63)


def _placed(window: int) -> Callable[[Batches], Batches]:
    """Where each stretch lies: its row, its first word, its anchor and its digest."""

    def run(batches: Batches) -> Batches:
        stretches = _cut(batches, window)
        while part := [(r, s, a, digest(t)) for r, s, a, t in islice(stretches, 50_000)]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part)], ["row", "start", "anchor", "digest"])

    return run


def _packed(window: int, shards: int, most_bytes: int = 32 << 20) -> Callable[[Batches], Batches]:
    """A task's distinct stretches with their counts, one row for each shard of anchors."""

    def rows(held: dict[tuple[int, bytes], int]) -> pa.RecordBatch:
        by_shard: dict[int, list] = {}
        for (anchor, stretch), n in held.items():
            by_shard.setdefault(anchor % shards, []).append((anchor, stretch, n))
        columns = list(
            zip(
                *(
                    (
                        shard,
                        np.array([x[0] for x in own], "<i8").tobytes(),
                        np.array([x[2] for x in own], "<i8").tobytes(),
                        zlib.compress(b"\n".join(x[1] for x in own), 1),
                    )
                    for shard, own in by_shard.items()
                )
            )
        )
        types = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["shard", "anchors", "counts", "stretches"])

    def run(batches: Batches) -> Batches:
        held: dict[tuple[int, bytes], int] = {}
        size = 0
        for _, _, anchor, stretch in _cut(batches, window):
            key = anchor, stretch
            if key in held:
                held[key] += 1
                continue
            held[key] = 1
            size += len(stretch) + 100
            if size > most_bytes:
                yield rows(held)
                held, size = {}, 0
        if held:
            yield rows(held)

    return run


class Symbols(dict):
    """A character for each word, in the order they are first seen; surrogates are left out."""

    most = 0x10FFFF - 0x800

    def __missing__(self, word: str) -> str:
        code = len(self) + 1
        if code > self.most:
            raise OverflowError("more words than characters")
        symbol = self[word] = chr(code if code < 0xD800 else code + 0x800)
        return symbol


class PairSymbols(dict):
    """Two characters for each word, from two sets without common ones, so that words are found at their beginnings only."""

    def __missing__(self, word: str) -> str:
        high, low = divmod(len(self), 0x100000)
        symbol = self[word] = chr(1 + high) + chr(0x10000 + low)
        return symbol


def located(stretches: list[str], counts: list[int], window: int = WINDOW) -> list[list[int]]:
    """For each stretch where recurring windows start in it, in words.

    The stretches, with how often each occurs, hold every occurrence of their windows.
    Recurring windows are confirmed by their words and compiled into one automaton, which
    all stretches are streamed through.  A shard of more words than there are characters takes two for each.
    """
    try:
        return _located(stretches, counts, window, Symbols(), 1)
    except OverflowError:
        return _located(stretches, counts, window, PairSymbols(), 2)


def _located(stretches: list[str], counts: list[int], window: int, symbols: dict[str, str], width: int) -> list[list[int]]:
    import ahocorasick

    lines = ["".join(map(symbols.__getitem__, s.split(" "))) for s in stretches]
    size = window * width
    seen: Counter[str] = Counter()
    for line, count in zip(lines, counts):
        for i in range(0, len(line) - size + 1, width):
            seen[line[i : i + size]] += count
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for phrase, count in seen.items():
        if count > 1:
            automaton.add_word(phrase)
    del seen
    if not len(automaton):
        return [[] for _ in lines]
    automaton.make_automaton()
    return [[(end + 1) // width - window for end, _ in automaton.iter(line)] for line in lines]


def ranges(starts: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Words that windows from these sorted starts cover, as first and end."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + window)
        else:
            out.append([s, s + window])
    return [(a, b) for a, b in out]


def _confirmed(window: int) -> Callable[[Batches], Batches]:
    """Rows come sorted by shard; a shard's stretches are put together and searched."""

    def answer(shard: dict[tuple[int, bytes], int]) -> pa.RecordBatch:
        found = located([t.decode() for _, t in shard], list(shard.values()), window)
        hits = [
            (anchor, digest(stretch), [x for pair in ranges(starts, window) for x in pair])
            for (anchor, stretch), starts in zip(shard, found)
            if starts
        ]
        columns = zip(*hits) if hits else ((), (), ())
        types = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["anchor", "digest", "ranges"])

    def run(batches: Batches) -> Batches:
        current, shard = None, {}
        for batch in batches:
            for number, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                if number != current:
                    if shard:
                        yield answer(shard)
                    current, shard = number, {}
                anchors_, counts = (np.frombuffer(x, "<i8").tolist() for x in parts[:2])
                for key, n in zip(zip(anchors_, zlib.decompress(parts[2]).split(b"\n")), counts):
                    shard[key] = shard.get(key, 0) + n
        if shard:
            yield answer(shard)

    return run


def repeats(
    rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``row, ranges``: stretches of words (first, end, first, ...) that recurring windows cover, per row with any.

    ``rows`` comes from ``keyed``.  Ranges of one row may overlap and come in any order.
    """
    runs = recurring_runs(rows, window, anchor, hot)
    number = runs.agg(F.sum(F.size("runs").cast("long"))).first()[0] or 0
    shards = max(1, number * 2 * window // shard_words)
    # All columns of the rows stay, so that every join with them uses one shuffle of the texts.
    cut = rows.join(runs, "row").select(*rows.columns, "runs")
    packed = mapped(cut, _packed(window, shards), "shard long, anchors binary, counts binary, stretches binary")
    together = packed.repartition("shard").sortWithinPartitions("shard")
    confirmed = mapped(together, _confirmed(window), "anchor long, digest long, ranges array<int>")
    places = mapped(cut, _placed(window), "row long, start long, anchor long, digest long")
    placed = places.join(confirmed, ["anchor", "digest"])
    moved = F.transform("ranges", lambda x: x + F.col("start").cast("int"))
    return placed.groupBy("row").agg(F.flatten(F.collect_set(moved)).alias("ranges"))


def kept_words(words: list[bytes], flat: list[int]) -> list[bytes]:
    """The words outside all ranges."""
    out, at = [], 0
    for first, end in sorted(zip(flat[::2], flat[1::2])):
        out += words[at:first]
        at = max(at, end)
    return out + words[at:]


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **tuning: int) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words that stay, joined by one space) of every row.

    Words are runs of anything but space and 09-0D, unchanged.  A null or empty text has
    none; a text shorter than a window loses none.  Rows that are equal repeat each other,
    so both lose all their windows.  An empty table gives none.
    """
    rows = keyed(docs, id_col, text_col)

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            out: list[list] = [[], [], []]
            for text, flat in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                words = text.encode().split()
                kept = kept_words(words, flat) if flat else words
                for column, value in zip(out, (len(words), len(words) - len(kept), b" ".join(kept).decode())):
                    column.append(value)
            columns = [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept"])

    joined = rows.join(repeats(rows, window, **tuning), "row", "left").select("doc_id", "text", "ranges")
    return mapped(joined, run, "doc_id long, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **tuning: int) -> DataFrame:
    """The documents without their repeated passages: all columns stay, white space between kept words too.

    A text without repeated passages stays as it is, a null one null.  Columns of any other name stay as they are.
    """
    place, docs_columns = docs.columns.index(text_col), docs.columns
    row, covered = free_name(docs, "row"), free_name(docs, "ranges")

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches, f"c{place}"):
            *columns, flats = batch.columns
            texts = columns[place].to_pylist()
            clean = [_without(t, flat) if flat and t else t for t, flat in zip(texts, flats.to_pylist())]
            columns[place] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    whole = docs.withColumn(row, _row_of(id_col, text_col))
    found = repeats(keyed(docs, id_col, text_col), window, **tuning).select(F.col("row").alias(row), F.col("ranges").alias(covered))
    joined = whole.join(found, row, "left").select(*(F.col(f"`{c}`") for c in docs_columns), covered)
    return mapped(numbered(joined), run, T.StructType(docs.schema.fields))


def _row_of(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _without(text: str, flat: list[int]) -> str:
    """The text without the words in the ranges; each goes with the white space behind it."""
    import re

    words = [m.start() for m in re.finditer(r"[^\x20\x09-\x0d]+", text)] + [len(text)]
    out, at = [], 0
    for first, end in sorted(zip(flat[::2], flat[1::2])):
        out.append(text[at : max(at, words[first])])
        at = max(at, words[end])
    return "".join([*out, text[at:]])
