"""Language-model scores by a hierarchical Pitman-Yor model.

A token's restaurant is named by the endings of the two words before it; restaurants that
agree on the nearer word share a parent, and all parents share the root, whose base is
uniform over the known words and one unknown.  Seats are sampled by Gibbs: a sweep draws
the number of tables of every dish in every restaurant given all others, leaves first,
since the tables of a restaurant are the customers of its parent.  Predictive
probabilities are averaged over the samples after the burn-in.

How it runs.  Documents are read in blocks of bounded size.  A block sends each of its
distinct (word, restaurant) pairs once, with its training count, to the bucket of the word.
A bucket holds all customers of its words in all restaurants, so a sweep needs nothing but
the totals of the restaurants, a vector of fixed length, which is summed over all buckets
after every sweep.  Sweeps are not stored: they are drawn from seeds and replayed.  A bucket
answers each block with the probabilities of the pairs it sent, and the block adds them up
along its documents.  No word, however frequent, is more than one row of a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Batches, in_slices, mapped
from millrace.session import materialise

NEAR, FAR = 16, 4  # classes of the word before and of the one before it
LEAVES = NEAR * FAR
END = b" "  # no word holds a space

BLOCK_TOKENS = 1_000_000
BUCKET_BYTES = 4_000_000  # text to a bucket

MOST_LISTED = 256  # customers of a dish up to which the tables are drawn from a list of all cases
GRID = 33  # cases that are weighed beyond


@dataclass(frozen=True)
class Settings:
    """Discount and strength of leaves, parents and root; sweeps."""

    discounts: tuple[float, float, float] = (0.9, 0.9, 0.8)
    strengths: tuple[float, float, float] = (1.0, 1.0, 1.0)
    burn_in: int = 1
    samples: int = 2
    seed: int = 1


def is_held_out(id_col: str | Column, parts: int = 7, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a row without an id counts as held out."""
    rest = F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col)
    return F.coalesce(rest % parts == part, F.lit(True))


# --- blocks of documents -----------------------------------------------------------------------


class Numbers(dict):
    """A number for each word, in the order they are first seen."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class Block:
    """Distinct words by bucket, their restaurants, training counts, and each document's pairs."""

    words: list[bytes]
    buckets: np.ndarray  # of each word, ascending
    widths: np.ndarray  # restaurants of each word
    leaves: np.ndarray  # of each pair, by word
    counts: np.ndarray  # training tokens of each pair
    pairs: np.ndarray  # of each token
    ends: np.ndarray  # of each document, in tokens


def numbered(words: list[bytes], numbers: Numbers) -> np.ndarray:
    """The numbers of a text's words and of its end, 0."""
    return np.fromiter(chain(map(numbers.__getitem__, words), (0,)), np.int32, len(words) + 1)


def block_of(numbers: Numbers, texts: list[np.ndarray], train: list[bool], buckets: int) -> Block:
    tokens = np.concatenate(texts)
    ends = np.cumsum([len(t) for t in texts])
    words = list(numbers)
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    near = np.fromiter((1 + zlib.crc32(w[-3:]) % (NEAR - 1) for w in words), np.int8, len(words))
    far = np.fromiter((zlib.crc32(w[-2:]) % FAR for w in words), np.int8, len(words))
    near[0] = far[0] = 0  # what stands before the first word is an end
    one = np.concatenate([tokens[:1] * 0, tokens[:-1]])
    two = np.concatenate([tokens[:1] * 0, one[:-1]])
    two[one == 0] = 0
    code = place[tokens] * LEAVES + near[one] * FAR + far[two]
    del tokens, one, two
    distinct, pairs = np.unique(code, return_inverse=True)
    trained = np.repeat(np.array(train, bool), np.diff(np.concatenate([[0], ends])))
    return Block(
        [words[i] for i in order.tolist()],
        bucket[order],
        np.bincount(distinct // LEAVES, minlength=len(words)),
        distinct % LEAVES,
        np.bincount(pairs[trained], minlength=len(distinct)),
        pairs.astype(np.uint32),
        ends,
    )


def _blocks(batches: Batches, buckets: int, block_tokens: int) -> Iterator[tuple[int, list, list, Block]]:
    """Block number, ids, held-out marks and the block, from one partition's ``doc_id, held_out, text, part``."""
    first = None
    ids: list = []
    held: list[bool] = []
    texts: list[np.ndarray] = []
    numbers = Numbers({END: 0})
    tokens = 0
    for batch in in_slices(batches, most_bytes=1 << 20):
        first = batch.column("part")[0].as_py() << 24 if first is None else first
        for i, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
            words = text.encode().lower().split()
            if tokens and tokens + len(words) > block_tokens:
                yield first, ids, held, block_of(numbers, texts, [not h for h in held], buckets)
                first, ids, held, texts, numbers, tokens = first + 1, [], [], [], Numbers({END: 0}), 0
            ids.append(i)
            held.append(out)
            texts.append(numbered(words, numbers))
            tokens += len(words) + 1
    if ids:
        yield first, ids, held, block_of(numbers, texts, [not h for h in held], buckets)


def _sent(buckets: int, block_tokens: int) -> Callable[[Batches], Batches]:
    """Each block's words, by bucket."""

    def run(batches: Batches) -> Batches:
        for number, _, _, block in _blocks(batches, buckets, block_tokens):
            edges = np.flatnonzero(np.diff(block.buckets)) + 1
            pair_ends = np.concatenate([[0], np.cumsum(block.widths)])
            out: list[list] = [[], [], [], [], [], []]
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(block.words)]):
                x, y = pair_ends[a], pair_ends[b]
                row = (
                    int(block.buckets[a]),
                    number,
                    b"\n".join(block.words[a:b]),
                    block.widths[a:b].astype(np.uint8).tobytes(),
                    block.leaves[x:y].astype(np.uint8).tobytes(),
                    block.counts[x:y].astype("<u4").tobytes(),
                )
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], SENT.names)

    return run


SENT = pa.schema([(n, pa.int64() if n in ("bucket", "block") else pa.binary()) for n in ("bucket", "block", "words", "widths", "leaves", "counts")])


def _merged(batches: Batches) -> Batches:
    """Rows come sorted by bucket: one row for each, with its customers and what each block asks for."""

    def one(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
        numbers = Numbers()
        number = numbers.__getitem__
        asked, counts, blocks = [], [], []
        for block, words, widths, leaves, own in rows:
            word = np.fromiter(map(number, words.split(b"\n")), np.int64)
            asked.append(np.repeat(word, np.frombuffer(widths, np.uint8)) * LEAVES + np.frombuffer(leaves, np.uint8))
            counts.append(np.frombuffer(own, "<u4"))
            blocks.append((block, len(word), len(asked[-1])))
        code, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(code)).astype(np.int64)
        row = {
            "bucket": bucket,
            "n_words": len(numbers),
            "code": code.astype("<i8").tobytes(),
            "total": total.astype("<i8").tobytes(),
            "blocks": np.array(blocks, "<i8").tobytes(),
            "asked": place.astype("<u4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], MERGED)

    current, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != current:
                if rows:
                    yield one(current, rows)
                current, rows = bucket, []
            rows.append(tuple(row))
    if rows:
        yield one(current, rows)


MERGED = pa.schema([("bucket", pa.int64()), ("n_words", pa.int64()), ("code", pa.binary()), ("total", pa.binary()), ("blocks", pa.binary()), ("asked", pa.binary())])


# --- seating -----------------------------------------------------------------------------------


def stirling_logs(discount: float, most: int = MOST_LISTED) -> np.ndarray:
    """Logarithms of how many weighted ways seat c customers at t tables, sizes summed out."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(2, most + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(c - 1 - discount * t, 0.0)) + out[c - 1, 1 : c + 1]
        out[c, 1 : c + 1] = np.logaddexp(out[c - 1, 0:c], stay)
    return out


def stirling_slope(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """How ``stirling_logs`` changes with one more table, by the saddle point of the generating function.

    The numbers for t tables are c!/t! times the coefficients of ((1 - (1 - x)^d) / d)^t.
    """
    low, high = np.full(tables.shape, -690.0), np.full(tables.shape, -1e-9)  # logarithms of 1 - x
    for _ in range(45):
        middle = (low + high) / 2
        y = np.exp(middle)
        above = tables * discount * (1 - y) * np.exp((discount - 1) * middle) > customers * (1 - y**discount)
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return np.log((1 - np.exp(discount * low)) / discount) - np.log(tables + 0.5)


def draw_tables(
    customers: np.ndarray, chance: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator, logs: np.ndarray
) -> np.ndarray:
    """The number of tables of each dish, given its customers, its chance in the parent and the other dishes' tables.

    Up to ``MOST_LISTED`` customers it is drawn from its exact distribution given the rest,
    with all cases weighed.  Beyond, the distribution's slope is followed over a grid of
    cases around its peak.
    """
    tables = np.minimum(customers, 1)
    listed = len(logs) - 1
    for c in np.unique(customers[(customers > 1) & (customers <= listed)]).tolist():
        rows = np.flatnonzero(customers == c)
        for part in np.array_split(rows, -(-len(rows) * c // 2_000_000)):
            opened = np.log(chance[part])[:, None] + np.log(strength + discount * (others[part][:, None] + np.arange(c)))
            weight = logs[c, 1 : c + 1] + np.cumsum(opened, 1)
            weight = np.exp(weight - weight.max(1, keepdims=True)).cumsum(1)
            tables[part] = 1 + (weight < rng.random(len(part))[:, None] * weight[:, -1:]).sum(1)
    rows = np.flatnonzero(customers > listed)
    if len(rows):
        tables[rows] = _drawn_on_grid(customers[rows][:, None], chance[rows][:, None], others[rows][:, None], discount, strength, rng)
    return tables


def _drawn_on_grid(c: np.ndarray, chance: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    def slope(t: np.ndarray) -> np.ndarray:
        return stirling_slope(c, t, discount) + np.log(chance) + np.log(strength + discount * (others + t))

    low, high = np.zeros(c.shape), np.log(c.astype(float))
    for _ in range(25):  # the peak, in logarithms
        middle = (low + high) / 2
        rising = slope(np.exp(middle)) > 0
        low, high = np.where(rising, middle, low), np.where(rising, high, middle)
    peak = np.exp(low)
    width = np.sqrt(np.maximum(peak, 1.0) / max(1e-3, 1 - discount))
    step = np.maximum(1.0, np.ceil(8 * width / GRID))
    grid = np.maximum(1.0, np.round(peak) - step * (GRID // 2)) + step * np.arange(GRID)
    grid = np.minimum(grid, c)
    between = (grid[:, 1:] + grid[:, :-1]) / 2 - 0.5
    weight = np.cumsum(np.concatenate([np.zeros(c.shape), slope(np.maximum(between, 1.0)) * np.diff(grid, axis=1)], 1), 1)
    weight = np.exp(weight - weight.max(1, keepdims=True))
    weight[:, 1:][np.diff(grid, axis=1) == 0] = 0
    weight = weight.cumsum(1)
    at = (weight < rng.random(c.shape) * weight[:, -1:]).sum(1)
    chosen = grid[np.arange(len(c)), at] + np.floor((rng.random(len(c)) - 0.5) * step[:, 0] + 0.5)
    return np.clip(chosen, 1, c[:, 0]).astype(np.int64)


@dataclass
class Totals:
    """Customers and tables of all restaurants: leaves, parents, root."""

    customers: list[np.ndarray]
    tables: list[np.ndarray]

    def flat(self) -> np.ndarray:
        return np.concatenate([*self.customers, *self.tables])

    @staticmethod
    def of(flat: np.ndarray) -> Totals:
        parts = np.split(flat, np.cumsum([LEAVES, NEAR, 1, LEAVES, NEAR]))
        return Totals(parts[:3], parts[3:])


class Seats:
    """Customers and tables of a bucket's words on the three levels."""

    def __init__(self, code: np.ndarray, total: np.ndarray, n_words: int, settings: Settings, bucket: int):
        self.settings, self.bucket, self.n_words = settings, bucket, n_words
        trained = total > 0
        self.word, self.leaf = code[trained] // LEAVES, code[trained] % LEAVES
        parent_code, self.up = np.unique(self.word * NEAR + self.leaf // FAR, return_inverse=True)
        self.parent_word, self.parent = parent_code // NEAR, parent_code % NEAR
        self.customers = [total[trained], np.empty(0), np.empty(0)]
        self.tables = [np.ones(len(self.word), np.int64), np.ones(len(parent_code), np.int64), np.empty(0)]
        self.known = np.bincount(self.parent_word, minlength=n_words) > 0
        self.tables[2] = self.known.astype(np.int64)
        self._promote()

    def _promote(self) -> None:
        """Tables are the customers of the level above."""
        self.customers[1] = np.bincount(self.up, self.tables[0], len(self.parent)).astype(np.int64)
        self.customers[2] = np.bincount(self.parent_word, self.tables[1], self.n_words).astype(np.int64)

    def totals(self) -> Totals:
        sums = lambda x: [np.bincount(self.leaf, x[0], LEAVES), np.bincount(self.parent, x[1], NEAR), np.array([x[2].sum()])]
        return Totals(sums(self.customers), sums(self.tables))

    def chances(self, totals: Totals, base: float) -> tuple[np.ndarray, np.ndarray]:
        """Of every word in the root, and in all parents (a column each)."""
        (_, d1, d0), (_, s1, s0) = self.settings.discounts, self.settings.strengths
        root = self.customers[2] - d0 * self.tables[2] + (s0 + d0 * totals.tables[2][0]) * base
        root = root / (s0 + totals.customers[2][0])
        parents = (s1 + d1 * totals.tables[1]) * root[:, None]
        parents[self.parent_word, self.parent] += self.customers[1] - d1 * self.tables[1]
        return root, parents / (s1 + totals.customers[1])

    def predictive(self, code: np.ndarray, totals: Totals, base: float) -> np.ndarray:
        """The probability of each asked (word, leaf)."""
        d2, s2 = self.settings.discounts[0], self.settings.strengths[0]
        _, parents = self.chances(totals, base)
        word, leaf = code // LEAVES, code % LEAVES
        out = (s2 + d2 * totals.tables[0][leaf]) * parents[word, leaf // FAR]
        own = np.searchsorted(code, self.word * LEAVES + self.leaf)
        out[own] += self.customers[0] - d2 * self.tables[0]
        return out / (s2 + totals.customers[0][leaf])

    def sweep(self, number: int, totals: Totals, base: float, logs: list[np.ndarray]) -> None:
        rng = np.random.default_rng([self.settings.seed, number, self.bucket])
        root, parents = self.chances(totals, base)
        places = (self.leaf, self.parent, np.zeros(self.n_words, np.int64))
        chance = (parents[self.word, self.leaf // FAR], root[self.parent_word], np.full(self.n_words, base))
        for level in range(3):
            others = np.maximum(totals.tables[level][places[level]] - self.tables[level], 0)
            self.tables[level] = draw_tables(
                self.customers[level], chance[level], others, self.settings.discounts[level], self.settings.strengths[level], rng, logs[level]
            )
            if level < 2:
                self._promote()


def _seated(row: dict, settings: Settings, known: list[Totals], base: float) -> Iterator[Seats]:
    """The bucket's seats at the start and after each sweep, replayed with the totals known before it."""
    seats = Seats(np.frombuffer(row["code"], "<i8"), np.frombuffer(row["total"], "<i8"), row["n_words"], settings, row["bucket"])
    yield seats
    logs = [stirling_logs(d) for d in settings.discounts]
    for number, totals in enumerate(known):
        seats.sweep(number, totals, base, logs)
        yield seats


def _summed(settings: Settings, known: list[Totals], base: float) -> Callable[[Batches], Batches]:
    """Totals of a task's buckets after the last sweep that the known totals allow, its tokens and its known words."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(2 * (LEAVES + NEAR + 1) + 1)
        for batch in batches:
            for row in batch.select(["bucket", "n_words", "code", "total"]).to_pylist():
                *_, seats = _seated(row, settings, known, base)
                total += [*seats.totals().flat(), seats.known.sum()]
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    return run


def _gather(merged: DataFrame, settings: Settings, known: list[Totals], base: float) -> np.ndarray:
    """Sums over all buckets: a vector of fixed length."""
    parts = mapped(merged, _summed(settings, known, base), "sums array<double>")
    rows = parts.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(2 * (LEAVES + NEAR + 1) + 1)
    for r in rows:
        out[r["i"]] = r["x"]
    return out


@dataclass
class Fitted:
    """Totals after each sweep, training tokens and known words."""

    settings: Settings
    totals: list[Totals]
    tokens: int
    words: int

    @property
    def base(self) -> float:
        return 1 / (self.words + 1)


def fit(merged: DataFrame, settings: Settings) -> Fitted:
    """Run the sweeps; what is kept are the restaurants' totals after each."""
    first = _gather(merged, settings, [], 1.0)
    words, tokens = int(first[-1]), int(first[:LEAVES].sum())
    totals = [Totals.of(first[:-1])]
    for _ in range(settings.burn_in + settings.samples):
        totals.append(Totals.of(_gather(merged, settings, totals, 1 / (words + 1))[:-1]))
    return Fitted(settings, totals, tokens, words)


# --- answers and scores --------------------------------------------------------------------------


def averaged(row: dict, fitted: Fitted) -> np.ndarray:
    """The mean over the samples of the probability of each of the bucket's pairs."""
    code = np.frombuffer(row["code"], "<i8")
    out = np.zeros(len(code))
    for number, seats in enumerate(_seated(row, fitted.settings, fitted.totals[:-1], fitted.base)):
        if number > fitted.settings.burn_in:
            out += seats.predictive(code, fitted.totals[number], fitted.base)
    return out / fitted.settings.samples


def _answers(fitted: Fitted) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                logs = np.log10(averaged(row, fitted)).astype("<f4")
                code, total = np.frombuffer(row["code"], "<i8"), np.frombuffer(row["total"], "<i8")
                count = np.bincount(code // LEAVES, total, row["n_words"]).astype("<i8")
                asked, at, out = np.frombuffer(row["asked"], "<u4"), 0, []
                for block, n_words, n_pairs in np.frombuffer(row["blocks"], "<i8").reshape(-1, 3).tolist():
                    own = asked[at : at + n_pairs]
                    word = code[own] // LEAVES
                    fresh = np.concatenate([[True], np.diff(word) != 0])
                    at += n_pairs
                    out.append((block, 1, row["bucket"], logs[own].tobytes(), count[word[fresh]].tobytes()))
                yield _parts(out)

    return run


PARTS = "block long, kind int, place long, a binary, b binary, doc_id long, held_out boolean"


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    names = [p.split(" ")[0] for p in PARTS.split(", ")]
    columns = list(zip(*((*r, *[None] * (7 - len(r))) for r in rows)))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _read(buckets: int, block_tokens: int) -> Callable[[Batches], Batches]:
    """Each block's widths, then the pairs of its documents."""

    def run(batches: Batches) -> Batches:
        for number, ids, held, block in _blocks(batches, buckets, block_tokens):
            yield _parts([(number, 0, 0, block.widths.astype(np.uint8).tobytes())])
            starts = [0, *block.ends[:-1].tolist()]
            for a in range(0, len(ids), 1000):
                part = range(a, min(a + 1000, len(ids)))
                yield _parts(
                    [(number, 2, i, block.pairs[starts[i] : block.ends[i]].astype("<u4").tobytes(), None, ids[i], held[i]) for i in part]
                )

    return run


def _scored(tokens: int, words: int) -> Callable[[Batches], Batches]:
    """Rows come sorted by block, kind and place: widths, answers in the order of buckets, documents."""

    def run(batches: Batches) -> Batches:
        block, widths, logs, counts, model = None, None, [], [], None
        for batch in batches:
            out = []
            for number, kind, _, a, b, doc, held in zip(*(c.to_pylist() for c in batch.columns)):
                if number != block:
                    block, widths, logs, counts, model = number, None, [], [], None
                if kind == 0:
                    widths = np.frombuffer(a, np.uint8)
                elif kind == 1:
                    logs.append(np.frombuffer(a, "<f4"))
                    counts.append(np.frombuffer(b, "<i8"))
                else:
                    if model is None:
                        count = np.repeat(np.concatenate(counts), widths)
                        model = np.concatenate(logs).astype(float), count > 0, np.log10((count + 1) / (tokens + words + 1))
                        if len(model[0]) != len(count):
                            raise RuntimeError("the documents were not read twice in the same order")
                    pairs = np.frombuffer(a, "<u4")
                    out.append((doc, held, len(pairs), int(model[1][pairs].sum()), float(model[2][pairs].sum()), float(model[0][pairs].sum())))
            if out:
                types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
                )

    return run


def prepared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        is_held_out(F.col(id_col).cast("string")).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )


def merged_counts(rows: DataFrame, buckets: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each bucket of words: customers of all restaurants, and what each block asks for."""
    schema = "bucket long, block long, words binary, widths binary, leaves binary, counts binary"
    sent = mapped(rows, _sent(buckets, block_tokens), schema).repartition("bucket").sortWithinPartitions("bucket", "block")
    return materialise(
        mapped(sent, _merged, "bucket long, n_words long, code binary, total binary, blocks binary, asked binary"), "customers"
    )


def score(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    Tokens are words (runs of anything but space and 09-0D, with A-Z lower-cased) and one
    end.  ``base_score`` is the add-one unigram score of the training tokens, ``score`` the
    model's; both are log10 probabilities of the text.  A null text is empty: its end alone.
    Rows without an id are not learned from.  Repeated rows give one row each and are
    learned from as often; an empty table gives none.

    ``docs`` is read twice and must come in the same partitions and order both times, as a
    stored table does.
    """
    rows = prepared(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(16, -(-size // bucket_bytes))
    merged = merged_counts(rows, buckets, block_tokens)
    fitted = fit(merged, settings)
    answers = mapped(merged, _answers(fitted), PARTS)
    asked = mapped(rows, _read(buckets, block_tokens), PARTS)
    together = answers.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind", "place")
    found = mapped(
        together,
        _scored(fitted.tokens, fitted.words),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(fitted.tokens).cast("long").alias("train_tokens"), "base_score", "score")
