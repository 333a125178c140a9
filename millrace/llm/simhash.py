"""SimHash near-duplicates: Golay-code fuzzy hashing of fingerprints, verified links, components.

A fingerprint of 64 bits is cut into three segments.  When two fingerprints differ in at
most two bits, some segment is equal and the one after it (in a circle) differs in one bit
at most: two errors cannot spoil all three such pairs.  The equal segment is a key as it
is.  The next one is decoded by the binary Golay code of length 23: its key is the index
of a codeword at distance 4 or less, and two words at distance 2 or less always have such
a codeword in common, since every word lies within 3 of one.  That gives one or six keys.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Batches, free_name, in_slices, mapped, numbered, whole_texts
from millrace.llm.components import connected
from millrace.session import materialise

MOST_BITS = 2  # what the three segments and the codeword radius are made for

# First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))

# Generator polynomial of the binary Golay code.
GOLAY = 0b101011100011

# Keys shared by more fingerprints than this are refined by the third segment.
GROUP_ROWS = 4096


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included.

    Words are runs of anything but space and 09-0D, with A-Z lower-cased.  A text of fewer
    words is one shingle; one without words has fingerprint 0.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    n = len(words) - shingle_words + 1
    ones = np.zeros(64, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, n)
    for part in range(0, n, 1 << 16):  # 4 MB of bits at a time
        bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed 64-bit number) of every whole text; a null text is empty."""

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            prints = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"])

    return mapped(whole_texts(docs, id_col, text_col), run, "doc_id long, fp long")


# --- Golay keys ------------------------------------------------------------------------------


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial: zero for codewords."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


def error_table() -> np.ndarray:
    """For each syndrome the error patterns of weight 4 or less that leave it: one, or one and five of weight 4."""
    patterns = [sum(1 << b for b in bits) for w in range(5) for bits in combinations(range(23), w)]
    table = np.full((1 << 11, 6), -1, np.int64)
    filled = np.zeros(1 << 11, np.int64)
    for pattern, syndrome in zip(patterns, syndromes(np.array(patterns)).tolist()):
        table[syndrome, filled[syndrome]] = pattern
        filled[syndrome] += 1
    return table


def codeword_keys(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """12-bit indices of all codewords at distance 4 or less of each word: six columns, -1 where there are fewer."""
    errors = table[syndromes(words)]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def segment(prints: np.ndarray, number: int) -> np.ndarray:
    first, width = SEGMENTS[number]
    return (prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)


def pair_keys(prints: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the row each belongs to: segment number, that segment, a codeword index of the next."""
    keys, rows = [], []
    for i in range(3):
        index = codeword_keys(segment(prints, (i + 1) % 3), table)
        whole = (np.int64(i) << 34 | segment(prints, i) << 12)[:, None] | index
        used = index >= 0
        keys.append(whole[used])
        rows.append(np.nonzero(used)[0])
    return np.concatenate(keys), np.concatenate(rows)


def refined_keys(prints: np.ndarray, table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key with the codeword indices of the segment it does not hold, which differs in two bits at most."""
    third = np.empty((len(keys), 6), np.int64)
    for i in range(3):
        here = keys >> 34 == i
        third[here] = codeword_keys(segment(prints[here], (i + 2) % 3), table)
    used = third >= 0
    return (np.int64(1) << 62 | keys[:, None] << 12 | third)[used], np.nonzero(used)[0]


def _keyed(make: Callable[..., tuple[np.ndarray, np.ndarray]], *columns: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        table = error_table()
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 14):
                signed, *more = (
                    batch.slice(start, 1 << 14).column(c).to_numpy(zero_copy_only=False) for c in ("fp", *columns)
                )
                keys, rows = make(signed.view(np.uint64), table, *more)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(signed[rows])], ["key", "fp"])

    return run


def verified(prints: np.ndarray, most_bits: int = MOST_BITS, block: int = 512) -> np.ndarray:
    """For each of a group's distinct fingerprints the position of the first one in its component.

    Compares block by block and keeps only the pairs that are near enough.
    """
    left, right = [], []
    for a in range(0, len(prints), block):
        for b in range(a, len(prints), block * 16):
            near = np.bitwise_count(prints[a : a + block, None] ^ prints[None, b : b + block * 16]) <= most_bits
            i, j = np.nonzero(near)
            left.append(i + a)
            right.append(j + b)
    left, right = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(prints))
    while True:
        fresh = label.copy()
        np.minimum.at(fresh, left, label[right])
        np.minimum.at(fresh, right, label[left])
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def _linked(batches: Batches) -> Batches:
    """Rows come sorted by key: links of each key's fingerprints to the first of their component."""
    kept_keys, kept = np.empty(0, np.int64), np.empty(0, np.int64)

    def links(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
        out = [np.empty((0, 2), np.int64)]
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            own = np.unique(prints[a:b])
            first = verified(own.view(np.uint64))
            other = first != np.arange(len(own))
            out.append(np.stack([own[other], own[first[other]]], 1))
        pairs = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        keys = np.concatenate([kept_keys, batch.column("key").to_numpy(zero_copy_only=False)])
        prints = np.concatenate([kept, batch.column("fp").to_numpy(zero_copy_only=False)])
        last = np.searchsorted(keys, keys[-1])  # the last key may go on in the next batch
        if last:
            yield links(keys[:last], prints[:last])
        kept_keys, kept = keys[last:], prints[last:]
    if len(kept_keys):
        yield links(kept_keys, kept)


def near_links(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect exactly those within two bits.

    Not every near pair is a link of its own: within the fingerprints of one key each is
    linked to the first of its component.  Keys with more than ``group_rows`` fingerprints
    are refined by the codewords of the third segment, with the same result.
    """
    keys = materialise(
        mapped(prints.select("fp").distinct(), _keyed(pair_keys), "key long, fp long"), "keys"
    )
    large = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > group_rows).select("key")
    refined = mapped(
        keys.join(large, "key", "left_semi"),
        _keyed(refined_keys, "key"),
        "key long, fp long",
    )
    grouped = keys.join(large, "key", "left_anti").unionByName(refined)
    shared = grouped.repartition("key").sortWithinPartitions("key")
    return mapped(shared, _linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id reachable over fingerprints within two bits.

    Rows without words share fingerprint 0 and are linked like any others.  Rows without an
    id belong to their component and do not name it; a component of such rows alone has a
    null id.  Repeated rows give one row each; an empty table gives none.
    """
    stored = materialise(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    least = materialise(stored.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    return in_components(stored, least, near_links(least))


def in_components(stored: DataFrame, least: DataFrame, links: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of the rows of ``stored`` from links between the ``fp`` of ``least``."""
    roots = connected(links).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored.join(rooted.join(names, "root").select("fp", "component_id"), "fp", "left").select(
        "doc_id", "fp", "component_id"
    )


def one_of_each(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near-duplicates by fingerprint: of each component the one with the smallest id stays.

    For corpora whose copies differ in a few words of thousands; the pipeline's stage, which must find
    copies at a similarity of 0.8, is ``shingles.one_of_each``.

    All columns stay.  Rows with one id stand and fall together, but of rows equal in id
    and text one is kept; rows without an id stay if no row of their component has one.
    """
    found = near_duplicates(docs, shingle_words, id_col, text_col)
    signed = lambda text: int(np.uint64(fingerprint(text, shingle_words)).view(np.int64))
    return one_of_component(docs, found, signed, id_col, text_col)


def one_of_component(
    docs: DataFrame, found: DataFrame, name: Callable[[str], int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``one_of_each`` from ``doc_id, fp, component_id`` of every row and the function that gives a text's ``fp``."""
    found = materialise(found, "components")
    own, fp = free_name(docs, "doc_id_of"), free_name(docs, "fp_of")
    named = docs.withColumn(own, F.col(id_col).cast("long"))
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    gone = found.filter("doc_id != component_id").select("doc_id").distinct().join(kept, "doc_id", "left_anti")
    left = named.join(gone.withColumnRenamed("doc_id", own), own, "left_anti")
    repeated = found.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = materialise(repeated.select(F.col("doc_id").alias(own)), "repeated")
    if not repeated.isEmpty():
        once = left.join(repeated, own, "left_semi").dropDuplicates([own, text_col])
        left = left.join(repeated, own, "left_anti").unionByName(once)
    nameless = found.filter("doc_id is null and component_id is not null").select(F.col("fp").alias(fp)).distinct()
    if not nameless.isEmpty():  # rows without an id are known by their fingerprint
        lost = _with_name(left.filter(F.col(own).isNull()), name, text_col, fp)
        stay = lost.join(nameless, fp, "left_anti").drop(fp)
        left = left.filter(F.col(own).isNotNull()).unionByName(stay)
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def _with_name(docs: DataFrame, name: Callable[[str], int], text_col: str, into: str) -> DataFrame:
    """The rows with the name of their text as the new column ``into``."""

    text = f"c{docs.columns.index(text_col)}"
    columns = [*docs.columns, into]

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches, text):
            names = [name(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.int64())], columns)

    return mapped(numbered(docs), run, T.StructType([*docs.schema.fields, T.StructField(into, T.LongType())]))
