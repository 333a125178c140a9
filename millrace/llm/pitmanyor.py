"""Language-model scores by a hierarchical Pitman-Yor model over words.

Every word that stands before another, and the start of a text, is a restaurant of its own.
All restaurants share the root, whose base is uniform over the known words and one unknown.
Seats are sampled by Gibbs: a sweep draws the number of tables of every dish in every
restaurant given all others, leaves first, since their tables are the customers of the
root.  Predictive probabilities are averaged over the samples after the burn-in.  A dish with
one customer sits at one table in every sample, so only pairs seen twice or more are drawn.

How it runs.  A word's home is the bucket its hash falls into.  Documents are read in blocks of
bounded size, and a block sends each of its distinct (word, word before) pairs once, with its
training count, to the home of the word.  There lie the word's customers in all restaurants
and its seats in the root.  The tables of a restaurant lie in many buckets: after every sweep
they are sent to the home of the word it is named by, added up, and the sums sent back.  The
customers of a restaurant are the word's own count.  At the end a block gets whole numbers,
for each of its words and pairs, and works out the probabilities itself.

Words are named by hashes of 64 bits.  A home has the spelling of all its words, so two words
of one hash are noticed, and everything is then done again with another hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Batches, in_slices, mapped
from millrace.llm.hpylm import END, draw_tables, prepared, stirling_logs
from millrace.session import materialise

BLOCK_TOKENS = 1_000_000
BUCKET_BYTES = 16_000_000  # text to a bucket


@dataclass(frozen=True)
class Settings:
    """Discount and strength of leaves and root; sweeps."""

    discounts: tuple[float, float] = (0.8, 0.8)
    strengths: tuple[float, float] = (1.0, 1.0)
    burn_in: int = 1
    samples: int = 2
    seed: int = 1


# --- numbers as bytes ------------------------------------------------------------------------------


def packed(x: np.ndarray, kind: str = "<i8") -> bytes:
    """Numbers byte plane by byte plane, compressed: the planes of small numbers are nearly free."""
    planes = np.ascontiguousarray(x, kind).view(np.uint8).reshape(len(x), np.dtype(kind).itemsize).T
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, kind: str = "<i8") -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).reshape(n)


def hashes_of(words: pa.Array, salt: int) -> np.ndarray:
    return hash_array(words.to_numpy(zero_copy_only=False), hash_key=f"{salt:016d}", categorize=False)


def home(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; it grows with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of each run of equal numbers."""
    edges = [0, *(np.flatnonzero(np.diff(x)) + 1).tolist(), len(x)] if len(x) else [0]
    yield from ((int(x[a]), a, b) for a, b in zip(edges, edges[1:]))


ROWS = "bucket long, kind int, place long, a binary, b binary, c binary, d binary, e binary, f binary"


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of a schema, short ones filled up with nulls."""
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")))
    columns = zip(*((*r, *[None] * (len(names) - len(r))) for r in rows)) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names)


def _by_first(batches: Batches) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows that come sorted by their first column, group by group."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, itemgetter(0))


def _kinds(parts: dict[int, DataFrame], schema: str = ROWS) -> DataFrame:
    """Tables of some of the schema's columns as one, marked by kind."""
    out = []
    for kind, df in parts.items():
        have = {c: F.col(c) for c in df.columns} | {"kind": F.lit(kind)}
        columns = (c.split(" ") for c in schema.split(", "))
        out.append(df.select(*(have.get(n, F.lit(None)).cast("bigint" if t == "long" else t).alias(n) for n, t in columns)))
    return reduce(DataFrame.unionByName, out)


def _meet(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key, *order)


# --- blocks of documents ---------------------------------------------------------------------------


@dataclass
class Block:
    """Words in the order of their hashes, and the documents' tokens as places in that order."""

    number: int
    words: pa.Array
    hashes: np.ndarray
    tokens: np.ndarray
    start: int  # the place of the end of texts, which is also what stands before the first word
    ends: np.ndarray  # of each document, in tokens
    ids: list
    held: list[bool]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())
    found = pc.binary_length(words).to_numpy() > 0  # space at an end of a text leaves an empty word
    sizes = np.diff(np.concatenate([[0], np.cumsum(found)])[ends], prepend=0)
    return words if found.all() else words.filter(pa.array(found)), sizes


def numbered(words: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The number of each word, in the order they are first seen, and the distinct words."""
    chunks = words.dictionary_encode().unify_dictionaries().chunks
    return np.concatenate([c.indices.to_numpy() for c in chunks]), chunks[0].dictionary


def block_of(number: int, words: list[pa.Array], sizes: list[int], ids: list, held: list[bool], salt: int) -> Block:
    seen, spelled = numbered(pa.chunked_array([pa.array([END.decode()]), *words]))
    spelled = spelled.cast(pa.binary())
    words.clear()
    pa.default_memory_pool().release_unused()  # what lay between the words would stay with the worker
    hashes = hashes_of(spelled, salt)
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    ends = np.cumsum(np.array(sizes) + 1)
    tokens = np.full(ends[-1], place[0])
    inside = np.ones(len(tokens), bool)
    inside[ends - 1] = False
    tokens[inside] = place[seen[1:]]
    del seen, inside
    return Block(number, spelled.take(pa.array(order)), hashes[order], tokens, int(place[0]), ends, ids, held)


def _codes(tokens: np.ndarray, start: int, n_words: int) -> tuple[np.ndarray, int]:
    """A number for the pair of each token: the word's place, shifted, and the place of the word before."""
    bits = (n_words - 1).bit_length()
    codes = tokens.astype(np.int64) << bits
    codes[0] |= start
    codes[1:] |= tokens[:-1]
    return codes, bits


def pairs_of(tokens: np.ndarray, start: int, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, as places of the word and of the word before, and the pair of each token."""
    codes, bits = _codes(tokens, start, n_words)
    code, pair = np.unique(codes, return_inverse=True)
    return code >> bits, code & (1 << bits) - 1, pair


def counted_pairs(tokens: np.ndarray, start: int, n_words: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, as in ``pairs_of``, and how many of each pair's tokens count."""
    codes, bits = _codes(tokens, start, n_words)
    codes <<= 1
    codes |= counts
    codes.sort()
    first = np.flatnonzero(np.concatenate([[True], (codes[1:] | 1) != (codes[:-1] | 1)]))
    code = codes[first] >> 1
    return code >> bits, code & (1 << bits) - 1, np.add.reduceat(codes & 1, first)


def blocks(batches: Batches, block_tokens: int, salt: int) -> Iterator[Block]:
    """The blocks of one partition's ``doc_id, held_out, text, part``."""
    number, tokens = None, 0
    ids, held, sizes, pieces = [], [], [], []
    for batch in in_slices(batches, most_bytes=1 << 20):
        number = batch.column("part")[0].as_py() << 24 if number is None else number
        words, counts = words_of(batch.column("text"))
        start = end = 0
        for i, out, n in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), counts.tolist()):
            if tokens and tokens + n > block_tokens:
                pieces.append(words.slice(start, end - start))
                block = block_of(number, pieces, sizes, ids, held, salt)
                number, tokens, start = number + 1, 0, end
                ids, held, sizes, pieces = [], [], [], []
                yield block
                del block
            ids.append(i)
            held.append(out)
            sizes.append(n)
            end += n
            tokens += n + 1
        pieces.append(words.slice(start))
    if ids:
        block = block_of(number, pieces, sizes, ids, held, salt)
        del pieces, words
        yield block


SENT = "bucket long, block long, words binary, widths binary, before binary, counts binary"


def _sent(buckets: int, block_tokens: int, salt: int) -> Callable[[Batches], Batches]:
    """Each block's pairs, by the home of the word: spelling, pairs of each word, hashes before, training counts."""

    def run(batches: Batches) -> Batches:
        for block in blocks(batches, block_tokens, salt):
            trained = np.repeat(~np.array(block.held, bool), np.diff(block.ends, prepend=0))
            word, before, counts = counted_pairs(block.tokens, block.start, len(block.words), trained)
            widths = np.bincount(word, minlength=len(block.words))
            pair_ends = np.concatenate([[0], np.cumsum(widths)])
            out, parts = [], list(runs(home(block.hashes, buckets)))
            lists = pa.ListArray.from_arrays(pa.array([0, *(b for *_, b in parts)], pa.int32()), block.words)
            for (bucket, a, b), spelled in zip(parts, pc.binary_join(lists, b"\n").to_pylist()):
                x, y = pair_ends[a], pair_ends[b]
                before_hashes = block.hashes[before[x:y]].tobytes()
                out.append((bucket, block.number, spelled, packed(widths[a:b], "<u4"), before_hashes, packed(counts[x:y], "<u4")))
            yield _rows(SENT, out)

    return run


# --- homes of words --------------------------------------------------------------------------------

MERGED = (
    "bucket long, n_tokens long, n_known long, n_tables long, n_lost long, hashes binary, word binary, total binary, "
    "blocks binary, asked binary, tables binary, drawn binary, at binary, shared binary, shared_seen binary, alone binary, alone_seen binary"
)


def _merged(salt: int) -> Callable[[Batches], Batches]:
    """One row for each bucket of words.

    ``hashes`` has its words, ``word`` and ``total`` are the word (as steps) and the training count of each
    pair, ``asked`` the pairs of each block (as steps).  ``tables`` are the root's customers of each word while every
    pair sits at one table.  Pairs seen twice or more are listed in ``drawn`` (word) and ``at`` (place in ``shared``,
    the hashes before them); ``alone`` are the other hashes before words.  Beside both stands how many
    of the bucket's words were seen after them.
    """

    def one(bucket: int, rows: Iterator[tuple]) -> tuple:
        spelled, asked, befores, counts, sizes = [], [], [], [], []
        for _, block, words, widths, before, own in rows:
            spelled.append(words)
            asked.append(unpacked(widths, "<u4"))
            befores.append(np.frombuffer(before, "<u8"))
            counts.append(unpacked(own, "<u4"))
            sizes.append((block, len(asked[-1]), len(befores[-1])))
        listed = pc.split_pattern(pa.array(spelled, pa.large_binary()), b"\n").flatten()
        seen, distinct = numbered(pa.chunked_array([listed]))
        hashes = hashes_of(distinct, salt)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rooms, room = np.unique(np.concatenate(befores), return_inverse=True)
        code, pair = np.unique(np.repeat(place[seen], np.concatenate(asked)) * len(rooms) + room, return_inverse=True)
        total = np.bincount(pair, np.concatenate(counts), len(code)).astype(np.int64)
        word, room = code // len(rooms), code % len(rooms)
        tables = np.bincount(word[total > 0], minlength=len(hashes))
        seen = np.bincount(room[total > 0], minlength=len(rooms))
        shared, at = np.unique(room[total > 1], return_inverse=True)
        alone = seen > 0
        alone[shared] = False
        return (
            bucket, int(total.sum()), int((tables > 0).sum()), int(tables.sum()), len(hashes) - len(np.unique(hashes)), hashes[order].tobytes(),
            packed(np.diff(word, prepend=0), "<u4"), packed(total), packed(np.array(sizes).ravel()), packed(np.diff(pair, prepend=0), "<i4"),
            packed(tables), packed(word[total > 1], "<u4"), packed(at, "<u4"), rooms[shared].tobytes(), packed(seen[shared]),
            rooms[alone].tobytes(), packed(seen[alone]),
        )

    def run(batches: Batches) -> Batches:
        for bucket, rows in _by_first(batches):
            yield _rows(MERGED, [one(bucket, rows)])

    return run


# --- tables of a restaurant ------------------------------------------------------------------------

DEALT = "home long, bucket long, asks int, keys binary, values binary"
ADDED = "bucket long, home long, keys binary, sums binary"


def _dealt(buckets: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for bucket, asks, keys, values in zip(*(c.to_pylist() for c in batch.columns)):
                hashes, numbers = np.frombuffer(keys, "<u8"), unpacked(values)
                rows = [(h, bucket, asks, hashes[a:b].tobytes(), packed(numbers[a:b])) for h, a, b in runs(home(hashes, buckets))]
                yield _rows(DEALT, rows)

    return run


def _added(batches: Batches) -> Batches:
    """Sums at home (a row without ``home``), and those of its keys to each bucket that asks."""
    for place, group in _by_first(batches):
        rows = list(group)
        hashes = [np.frombuffer(keys, "<u8") for *_, keys, _ in rows]
        keys, at = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(at, np.concatenate([unpacked(r[-1]) for r in rows])).astype(np.int64)
        ends = np.cumsum([len(h) for h in hashes]).tolist()
        out = [(place, None, keys.tobytes(), packed(sums))]
        out += [(r[1], place, None, packed(sums[at[end - len(h) : end]])) for r, h, end in zip(rows, hashes, ends) if r[2]]
        yield _rows(ADDED, out)


def added(numbers: DataFrame, buckets: int) -> DataFrame:
    """Sums over all buckets of ``bucket, asks, keys, values``, keys ascending; read them by ``home``, which follows the keys."""
    dealt = mapped(numbers.select("bucket", F.col("asks").cast("int"), "keys", "values"), _dealt(buckets), DEALT)
    return materialise(mapped(_meet(dealt, "home", "bucket", "asks"), _added, ADDED), "tables")


# --- sweeps ----------------------------------------------------------------------------------------


@dataclass
class Root:
    """What is known of the root and of all words."""

    customers: int
    tables: int
    words: int

    @property
    def base(self) -> float:
        return 1 / (self.words + 1)

    def chance(self, customers: np.ndarray, tables: np.ndarray, settings: Settings) -> np.ndarray:
        (_, d), (_, s) = settings.discounts, settings.strengths
        return (customers - d * tables + (s + d * self.tables) * self.base) / (s + self.customers)


SWEPT = "bucket long, customers long, tables long, seats binary, roots binary, keys binary, values binary"


def _swept(number: int, root: Root, settings: Settings) -> Callable[[Batches], Batches]:
    """Kinds: 0 a bucket's pairs, 1 its seats after the sweep before, 2 tables of its restaurants at first, 3 those added since.

    ``seats`` are the tables of pairs seen twice or more, ``roots`` those of words in the root.
    """
    (d1, d0), (s1, s0) = settings.discounts, settings.strengths

    def one(bucket: int, rows: Iterator[tuple], logs: list[np.ndarray]) -> tuple:
        parts: dict[int, list] = {0: [], 1: [], 2: [], 3: []}
        for _, kind, _, *values in rows:
            parts[kind].append(values)
        ((tables, drawn, at, count, shared, _),) = parts[0]
        tables, drawn, at, count = unpacked(tables), unpacked(drawn, "<u4"), unpacked(at, "<u4"), unpacked(count)
        n_rooms = len(shared) // 8
        others = sum((np.concatenate([unpacked(v[0]) for v in parts[k]]) for k in (2, 3) if parts[k]), np.zeros(n_rooms, np.int64))
        seats, roots = (unpacked(x) for x in parts[1][0][:2]) if parts[1] else (np.ones(len(count), np.int64), np.minimum(tables, 1))
        rng = np.random.default_rng([settings.seed, number, bucket])
        more = lambda: np.bincount(drawn, seats - 1, len(tables)).astype(np.int64)
        chance = root.chance(tables + more(), roots, settings)
        seats = draw_tables(count, chance[drawn], np.maximum(others[at] - seats, 0), d1, s1, rng, logs[0])
        customers = tables + more()
        base = np.full(len(roots), root.base)
        roots = draw_tables(customers, base, np.maximum(root.tables - roots, 0), d0, s0, rng, logs[1])
        opened = np.bincount(at, seats - 1, n_rooms).astype(np.int64)
        return bucket, int(customers.sum()), int(roots.sum()), packed(seats), packed(roots), shared, packed(opened)

    def run(batches: Batches) -> Batches:
        logs = [stirling_logs(d) for d in settings.discounts]
        for bucket, rows in _by_first(batches):
            yield _rows(SWEPT, [one(bucket, rows, logs)])

    return run


@dataclass
class Fitted:
    """Tables of restaurants at first; of each sample the root, the seats and the tables opened since."""

    settings: Settings
    tokens: int
    words: int
    first: DataFrame
    samples: list[tuple[Root, DataFrame, DataFrame]]


def _many(total: bytes) -> bytes:
    counts = unpacked(total)
    return packed(counts[counts > 1])


def _pairs(batches: Batches) -> Batches:
    for batch in batches:
        for bucket, tables, drawn, at, total, shared in zip(*(c.to_pylist() for c in batch.columns)):
            yield _rows(ROWS, [(bucket, 0, 0, tables, drawn, at, _many(total), shared)])


def fit(merged: DataFrame, buckets: int, settings: Settings) -> Fitted:
    """Run the sweeps."""
    tokens, words, tables = merged.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "n_known", "n_tables"))).first()
    shared = merged.select("bucket", F.lit(1).alias("asks"), F.col("shared").alias("keys"), F.col("shared_seen").alias("values"))
    alone = merged.select("bucket", F.lit(0).alias("asks"), F.col("alone").alias("keys"), F.col("alone_seen").alias("values"))
    first = added(shared.unionByName(alone), buckets)
    pairs = mapped(merged.select("bucket", "tables", "drawn", "at", "total", "shared"), _pairs, ROWS)
    root, out, state = Root(tables, words, words), [], {}
    for number in range(settings.burn_in + settings.samples):
        down = first.filter("home IS NOT NULL").select("bucket", F.col("home").alias("place"), F.col("sums").alias("a"))
        rows = pairs.unionByName(_kinds({2: down} | state))
        swept = materialise(mapped(_meet(rows, "bucket", "kind", "place"), _swept(number, root, settings), SWEPT), "seats")
        root = Root(*swept.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("customers", "tables"))).first(), words)
        opened = added(swept.select("bucket", F.lit(1).alias("asks"), "keys", "values"), buckets)
        seats = swept.select("bucket", F.col("seats").alias("a"), F.col("roots").alias("b"))
        down = opened.filter("home IS NOT NULL").select("bucket", F.col("home").alias("place"), F.col("sums").alias("a"))
        state = {1: seats, 3: down}
        if number >= settings.burn_in:
            out.append((root, seats, opened))
    return Fitted(settings, tokens, words, first, out)


# --- answers and scores ----------------------------------------------------------------------------


def _answers(n_samples: int) -> Callable[[Batches], Batches]:
    """Kinds: 0 a bucket's pairs, 1 its restaurants' tables at first, 2 its seats and 3 its restaurants' tables opened, by sample.

    A block gets, for each of its words, the count and of each sample the root's customers and tables and the
    restaurant's tables; for each of its pairs the count and of each sample the tables.
    """

    def one(bucket: int, rows: Iterator[tuple]) -> Iterator[tuple]:
        parts = {(kind, place): values for _, kind, place, *values in rows}
        hashes, word, total, blocks, asked, tables = parts[0, 0]
        hashes, total, tables = np.frombuffer(hashes, "<u8"), unpacked(total), unpacked(tables)
        word = np.cumsum(unpacked(word, "<u4"), dtype=np.int64)
        asked = np.cumsum(unpacked(asked, "<i4"), dtype=np.int64)
        many = total > 1
        of_words = [np.bincount(word, total, len(hashes)).astype(np.int64)]
        of_pairs = [total]

        def at_home(kind: int, place: int) -> np.ndarray:
            out = np.zeros(len(hashes), np.int64)
            if (kind, place) in parts:
                keys, sums, *_ = parts[kind, place]
                out[np.searchsorted(hashes, np.frombuffer(keys, "<u8"))] = unpacked(sums)
            return out

        first = at_home(1, 0)
        for sample in range(n_samples):
            seats, roots, *_ = parts[2, sample]
            pair_tables = np.minimum(total, 1)
            pair_tables[many] = unpacked(seats)
            of_words += [np.bincount(word, pair_tables, len(hashes)).astype(np.int64), unpacked(roots), first + at_home(3, sample)]
            of_pairs.append(pair_tables)
        at = 0
        for block, _, n_pairs in unpacked(blocks).reshape(-1, 3).tolist():
            own = asked[at : at + n_pairs]
            own_words = word[own][np.diff(word[own], prepend=-1) != 0]
            at += n_pairs
            yield (block, 1, bucket, packed(np.concatenate([x[own_words] for x in of_words])), packed(np.concatenate([x[own] for x in of_pairs])))

    def run(batches: Batches) -> Batches:
        for bucket, rows in _by_first(batches):
            yield _rows(PARTS, list(one(bucket, rows)))

    return run


PARTS = "block long, kind int, place long, a binary, b binary, doc_id long, held_out boolean"


def _read(block_tokens: int, salt: int) -> Callable[[Batches], Batches]:
    """Each block's documents: where the end of texts stands among its words, then the places of their tokens."""

    def run(batches: Batches) -> Batches:
        for block in blocks(batches, block_tokens, salt):
            yield _rows(PARTS, [(block.number, 0, block.start)])
            starts = [0, *block.ends[:-1].tolist()]
            for a in range(0, len(block.ids), 1000):
                part = range(a, min(a + 1000, len(block.ids)))
                token = lambda i: packed(block.tokens[starts[i] : block.ends[i]], "<u4")
                yield _rows(PARTS, [(block.number, 2, i, token(i), None, block.ids[i], block.held[i]) for i in part])

    return run


def probabilities(words: np.ndarray, pairs: np.ndarray, word: np.ndarray, before: np.ndarray, roots: list[Root], settings: Settings) -> np.ndarray:
    """The mean over the samples of each pair's probability, from the whole numbers of ``_answers``."""
    d, s = settings.discounts[0], settings.strengths[0]
    out = np.zeros(len(word))
    for k, root in enumerate(roots):
        customers, root_tables, tables = words[1 + 3 * k : 4 + 3 * k]
        chance = root.chance(customers, root_tables, settings)
        out += pairs[0] - d * pairs[1 + k] + (s + d * tables[before]) * chance[word]
    return out / (s + words[0][before]) / len(roots)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(tokens: int, words: int, roots: list[Root], settings: Settings) -> Callable[[Batches], Batches]:
    """Rows come sorted by block, kind and place."""

    def one(rows: Iterator[tuple]) -> list[tuple]:
        start, of_words, of_pairs, docs = 0, [], [], []
        for _, kind, place, a, b, doc, held in rows:
            if kind == 0:
                start = place
            elif kind == 1:
                of_words.append(unpacked(a).reshape(1 + 3 * len(roots), -1))
                of_pairs.append(unpacked(b).reshape(1 + len(roots), -1))
            else:
                docs.append((doc, held, unpacked(a, "<u4").astype(np.int32)))
        asked, known = np.concatenate(of_words, 1), np.concatenate(of_pairs, 1)
        token = np.concatenate([t for *_, t in docs])
        word, before, pair = pairs_of(token, start, asked.shape[1])
        if len(word) != known.shape[1]:
            raise RuntimeError("the documents were not read twice in the same order")
        model = np.log10(probabilities(asked, known, word, before, roots, settings))
        base = np.log10((asked[0] + 1) / (tokens + words + 1))
        starts = np.cumsum([0, *(len(t) for *_, t in docs[:-1])])
        sums = [np.add.reduceat(x, starts).tolist() for x in ((asked[0] > 0)[token].astype(np.int64), base[token], model[pair])]
        return [(doc, held, len(t), *values) for (doc, held, t), *values in zip(docs, *sums)]

    def run(batches: Batches) -> Batches:
        for _, rows in _by_first(batches):
            yield _rows(SCORED, one(rows))

    return run


def merged_counts(rows: DataFrame, buckets: int, block_tokens: int = BLOCK_TOKENS, salt: int = 0) -> DataFrame:
    """One row for each bucket of words: their customers in all restaurants, and what each block asks for."""
    sent = _meet(mapped(rows, _sent(buckets, block_tokens, salt), SENT), "bucket", "block")
    return materialise(mapped(sent, _merged(salt), MERGED), "customers")


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
    salt, merged = 0, merged_counts(rows, buckets, block_tokens, 0)
    while merged.agg(F.sum("n_lost")).first()[0]:
        salt += 1
        merged = merged_counts(rows, buckets, block_tokens, salt)
    fitted = fit(merged, buckets, settings)

    def home_sums(added_up: DataFrame) -> DataFrame:
        return added_up.filter("home IS NULL").select("bucket", F.col("keys").alias("a"), F.col("sums").alias("b"))

    pairs = merged.select("bucket", *(F.col(c).alias(n) for n, c in zip("abcdef", ("hashes", "word", "total", "blocks", "asked", "tables"))))
    parts = _kinds({0: pairs.withColumn("place", F.lit(0)), 1: home_sums(fitted.first).withColumn("place", F.lit(0))})
    for k, (_, seats, opened) in enumerate(fitted.samples):
        parts = parts.unionByName(_kinds({2: seats.withColumn("place", F.lit(k)), 3: home_sums(opened).withColumn("place", F.lit(k))}))
    answers = mapped(_meet(parts, "bucket", "kind", "place"), _answers(len(fitted.samples)), PARTS)
    asked = mapped(rows, _read(block_tokens, salt), PARTS)
    together = _meet(answers.unionByName(asked), "block", "kind", "place")
    found = mapped(together, _scored(fitted.tokens, fitted.words, [r for r, *_ in fitted.samples], settings), SCORED)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(fitted.tokens).cast("long").alias("train_tokens"), "base_score", "score")
