"""Prefix trie of conversations, from their sorted sequences.

Distinct sequences of turns are sorted as a whole and cut into shards of neighbours.  The
trie's nodes are the prefixes; the members of one are an interval of the order, in which
no two neighbours have less in common than its depth.  Each prefix finds the two ends of
its interval by itself: binary searches over range minima of the common lengths, which a
sparse table answers.  Prefixes that reach over the end of a shard are few, and what the
shards know of them is added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Batches, mapped
from millrace.session import materialise

KEY_BYTES = 16  # of a turn's role and text, and of a prefix
SHARD_TURNS = 1 << 19
CHUNK_BYTES = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()

HEADS, GROUP = 6, 100


def turns_of(
    table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turns``: every conversation's turns in order, as ``key`` of role and text and ``chars`` of the text.

    Turns are ordered by number, null first; equal ones by role, by the first 64 characters
    of the text and by key.  A null role or text counts as empty.  Rows without a
    conversation take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY_BYTES)
    each = table.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).cast("long").alias("turn"),
            role.alias("role"),
            F.substring(text, 1, 64).alias("start"),
            key.alias("key"),
            F.length(text).cast("long").alias("chars"),
        ).alias("t"),
    )
    in_order = F.sort_array(F.collect_list("t"))
    return each.groupBy("conv_id").agg(in_order.alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["key"], t["chars"])).alias("turns"))


def rebuilt(conversations: DataFrame, heads: int = HEADS, group: int = GROUP) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % ``group``, h = crc32(c) % ``heads``.

    h turns, or as many as there are, none where that conversation is absent; then c's own
    turns after its first h.  Only the first ``heads`` - 1 turns of one conversation in ``group``
    are shuffled, and each meets ``group`` conversations at most (twice as many around 0).
    """
    first = conversations.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, max(heads - 1, 1)).alias("head")
    )
    asked = conversations.select(
        "conv_id",
        "turns",
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h"),
    )
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return asked.join(first, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _path(turns: Column) -> Column:
    """The turns' keys one after the other: sorted as bytes, sequences are sorted turn by turn, the shorter first."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["key"]), ""))


def _hashes_of_copies(rows: DataFrame) -> DataFrame:
    """``path, ends``: SHA-256 of the ascending ids of the conversations with one path, comma-joined.

    A hash must read its ids in order, but no task holds them: ids are range-sorted, so that
    a path that very many share lies in many tasks, each joins its part into chunks of bounded
    size, and the chunks of a path are streamed through its hash.
    """

    def joined(batches: Batches) -> Batches:
        path, first, parts, held = None, 0, [], 0

        def chunk():
            data = ",".join(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([path], pa.binary()), pa.array([first], pa.int64()), pa.array([data])], ["path", "first", "ids"]
            )

        for batch in batches:
            for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
                if p != path or held > CHUNK_BYTES:
                    if parts:
                        yield chunk()
                    path, first, parts, held = p, c, [], 0
                parts.append(str(c))
                held += len(parts[-1]) + 1
        if parts:
            yield chunk()

    def hashed(batches: Batches) -> Batches:
        path, state = None, None

        def result():
            return pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([state.hexdigest()])], ["path", "ends"])

        for batch in batches:
            for p, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
                if p != path or state is None:
                    if state is not None:
                        yield result()
                    path, state = p, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state is not None:
            yield result()

    sorted_ids = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    chunks = mapped(sorted_ids, joined, "path binary, first long, ids string")
    return mapped(chunks.repartition("path").sortWithinPartitions("path", "first"), hashed, "path binary, ends string")


def distinct_paths(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence: ``path, chars`` (of each turn), ``n`` conversations, least ``conv``, ``ends``."""
    stored = materialise(
        conversations.select("conv_id", _path(F.col("turns")).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars")),
        "sequences",
    )
    folded = stored.groupBy("path").agg(
        F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv")
    )
    folded = materialise(folded, "paths")
    shared = folded.filter("n > 1").select("path")
    ends = _hashes_of_copies(stored.select("path", "conv_id").join(shared, "path", "left_semi"))
    own = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
    return folded.join(ends, "path", "left").select("path", "chars", "n", "conv", F.coalesce("ends", own).alias("ends"))


def common_turns(a: bytes, b: bytes) -> int:
    """The number of turns that two paths start with in common."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // KEY_BYTES
    low, high = 0, size // KEY_BYTES  # that many are equal; that many are not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * KEY_BYTES : middle * KEY_BYTES] == b[low * KEY_BYTES : middle * KEY_BYTES]:
            low = middle
        else:
            high = middle
    return low


class RangeMinimum:
    """Sparse table: row k holds the least of the 2^k values from each place on."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            last, half = self.rows[-1], 2 ** (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least value from ``first`` to before ``end``; the ranges are not empty."""
        level = np.frexp((end - first).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[first[at]], row[end[at] - 2**k])
        return out

    def _reach(self, at: np.ndarray, depth: np.ndarray, step: int) -> np.ndarray:
        """The number of values from ``at`` on (to the left: before it) that are at least ``depth``, by binary search."""
        n = len(self.rows[0])
        count = np.zeros(len(at), np.int64)
        for k in range(len(self.rows) - 1, -1, -1):
            first = at + count if step > 0 else at - count - 2**k
            inside = (first >= 0) & (first + 2**k <= n)
            row = self.rows[k]
            held = np.zeros(len(at), bool)
            held[inside] = row[first[inside]] >= depth[inside]
            count += held * 2**k
        return count

    def interval(self, place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the interval around each place whose neighbours share at least ``depth``.

        Value i is what place i has in common with place i - 1.  Each search looks at this
        table alone, whatever the other prefixes found.
        """
        return place - self._reach(place + 1, depth, -1), place + self._reach(place + 1, depth, 1)


NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
NODE_TYPES = [pa.int64()] * 6 + [pa.string()]


class _Shard:
    """Neighbouring distinct sequences, with what the first and the one after the last have in common with their neighbours."""

    def __init__(self, table: pa.Table, before: int, after: int) -> None:
        self.paths = table.column("path").to_pylist()
        m = len(self.paths)
        self.length = np.array([len(p) // KEY_BYTES for p in self.paths], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        chars = table.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.running = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
        self.n, self.conv = (table.column(c).to_numpy() for c in ("n", "conv"))
        self.ends = table.column("ends").to_pylist()
        self.common = np.array([before, *(common_turns(a, b) for a, b in zip(self.paths, self.paths[1:]))], np.int64)
        self.after = after
        self.table = RangeMinimum(np.where(np.arange(m) == 0, -2, self.common))  # no interval leaves the shard
        self.least_conv = RangeMinimum(self.conv)
        self.all_chars = self.chars_to(np.arange(m), self.length)
        following = np.append(self.common[1:], after)
        leaf = following < self.length
        starts = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        self.n_before, self.leaf_before = starts(self.n), starts(leaf)
        self.weighted_before = starts(self.n * self.all_chars)
        # Characters of the nodes that first occur in each sequence: those deeper than what it shares with the one before.
        self.new_before = starts(self.all_chars - self.chars_to(np.arange(m), np.maximum(self.common, 0)))
        order = np.lexsort((np.arange(m), self.common))
        self.by_common = (self.common[order] + 2) * (m + 1) + order

    def chars_to(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Characters of the first ``depth`` turns of a sequence."""
        start = self.offset[place]
        return self.running[start + depth] - self.running[start]

    def starting(self, depth: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of places from ``first`` to before ``end`` that share exactly ``depth`` turns with the one before."""
        base = (depth + 2) * (len(self.paths) + 1)
        return np.searchsorted(self.by_common, base + end) - np.searchsorted(self.by_common, base + first)

    def sums(self, place: np.ndarray, depth: np.ndarray, new: bool) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """What this shard holds of the prefixes given by a place and a depth, and the last place of their intervals.

        ``new``: the prefixes first occur at their place, else before this shard.  Saved
        characters are the turns from the node on of all members, less those of its subtree's nodes.
        """
        first, last = self.table.interval(place, depth)
        n = self.n_before[last + 1] - self.n_before[first]
        above = self.chars_to(place, np.maximum(depth - 1, 0))
        saved = self.weighted_before[last + 1] - self.weighted_before[first] - n * above
        nodes = self.new_before[last + 1] - self.new_before[first]
        children = self.starting(depth, first + new, last + 1)
        if new:
            nodes -= above - self.chars_to(place, np.maximum(self.common[place], 0))
            children += self.length[place] > depth
        return (
            self.least_conv.least(first, last + 1),
            depth,
            n,
            children,
            self.leaf_before[last + 1] - self.leaf_before[first],
            saved - nodes,
        ), last

    def key(self, place: int, depth: int) -> bytes:
        return hashlib.sha256(self.paths[place][: depth * KEY_BYTES]).digest()[:KEY_BYTES] + int(depth).to_bytes(8, "big")

    def batches(self, most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        """Nodes: whole ones with the id of their parent if that is whole, and ``own`` keys for those to be added up."""
        last_place = len(self.paths) - 1
        # Prefixes that began in an earlier shard: those that the first sequence shares with the one before.
        depth = np.arange(self.common[0] + 1, dtype=np.int64)
        if len(depth):
            place = np.zeros(len(depth), np.int64)
            values, _ = self.sums(place, depth, False)
            yield self._batch(values, [None] * len(depth), [None] * len(depth), [self.key(0, d) for d in depth], [None] * len(depth))
        count = self.length - self.common
        ends = np.cumsum(count)
        for start in range(0, int(ends[-1]), most):
            number = np.arange(start, min(start + most, int(ends[-1])))
            place = np.searchsorted(ends, number, "right")
            depth = self.common[place] + 1 + number - (ends[place] - count[place])
            values, last = self.sums(place, depth, True)
            open_end = (last == last_place) & (depth <= self.after)
            above = np.maximum(depth - 1, 0)
            first_above, last_above = self.table.interval(place, above)
            known = (depth > 0) & ~((last_above == last_place) & (above <= self.after)) & ~((first_above == 0) & (above <= self.common[0]))
            parent = np.where(known, self.least_conv.least(first_above, last_above + 1), 0)
            ends_here = [self.ends[p] if self.length[p] == d else None for p, d in zip(place.tolist(), depth.tolist())]
            yield self._batch(
                values,
                [p if k else None for p, k in zip(parent.tolist(), known)],
                [None if k or d == 0 else self.key(p, d - 1) for p, d, k in zip(place.tolist(), depth.tolist(), known)],
                [self.key(p, d) if o else None for p, d, o in zip(place.tolist(), depth.tolist(), open_end)],
                ends_here,
            )

    @staticmethod
    def _batch(values, parent, parent_key, own_key, ends) -> pa.RecordBatch:
        columns = [*(pa.array(v, pa.int64()) for v in values), pa.array(ends, pa.string())]
        columns += [pa.array(parent, pa.int64()), pa.array(parent_key, pa.binary()), pa.array(own_key, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [*(f.split()[0] for f in NODE.split(", ")), "parent_conv_id", "parent_key", "own_key"])


def _neighbours(stored: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard what its first sequence shares with the one before, and its last with the one after (-1: there is none).

    Two numbers a shard reach the driver; the sequences at the borders are compared in tasks.
    """
    borders = materialise(stored.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")), "borders")
    shards = [r["shard"] for r in borders.select("shard").orderBy("shard").collect()]
    follows = dict(zip(shards, shards[1:]))
    if not follows:
        return {s: (-1, -1) for s in shards}
    pairs = stored.sparkSession.createDataFrame(list(follows.items()), "shard long, following long")
    low = borders.select(F.col("shard").alias("following"), "low")

    def compare(batches: Batches) -> Batches:
        for batch in batches:
            low, high = (batch.column(c).to_pylist() for c in ("low", "high"))
            shared = pa.array([common_turns(a, b) for a, b in zip(high, low)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("following"), shared], ["following", "shared"])

    both = borders.select("shard", "high").join(pairs, "shard").join(low, "following").select("following", "low", "high")
    before = {r["following"]: r["shared"] for r in mapped(both, compare, "following long, shared long").collect()}
    return {s: (before.get(s, -1), before.get(follows.get(s), -1)) for s in shards}


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of ``conversations`` (``conv_id``, ``turns`` as in ``turns_of``), the root included.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``
    (childless nodes of the subtree, its top included), ``saved_tokens`` (characters that the subtree's nodes hold once
    instead of once a member), ``ends_sha256`` (of the ids of the members that end here).

    Conversations without turns are members of the root alone.  Equal conversations are folded
    first.  An empty table gives an empty one.  A task holds one shard of about ``shard_turns``
    turns, keys only, and at least one sequence.
    """
    paths = materialise(distinct_paths(conversations), "distinct")
    size = paths.agg(F.count("*").alias("n"), F.sum(F.size("chars") + 1).alias("turns")).first()
    shards = max(1, -(-(size["turns"] or 0) // shard_turns))
    in_order = paths.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id().cast("long"))
    stored = materialise(in_order, "sorted")
    around = _neighbours(stored)
    number = max(around, default=0) + 1
    schema = f"{NODE}, parent_conv_id long, parent_key binary, own_key binary"

    def run(batches: Batches) -> Batches:
        shard, held = None, []

        def nodes():
            return _Shard(pa.Table.from_batches(held), *around[shard]).batches()

        for batch in batches:
            names = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(names)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if names[a] != shard:
                    if held:
                        yield from nodes()
                    shard, held = int(names[a]), []
                held.append(batch.slice(a, b - a))
        if held:
            yield from nodes()

    together = stored.repartitionById(number, F.col("shard").cast("int")).sortWithinPartitions("shard", "path")
    found = materialise(mapped(together, run, schema), "nodes")
    whole = found.filter("own_key IS NULL")
    # Prefixes over the end of a shard, added up; the key of the parent is the same in all parts but those that lack it.
    added = (
        found.filter("own_key IS NOT NULL")
        .groupBy("own_key")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            F.max("ends").alias("ends"),
            F.max("parent_conv_id").alias("parent_conv_id"),
            F.max("parent_key").alias("parent_key"),
        )
    )
    added = materialise(added, "added")
    parents = added.select(F.col("own_key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    orphans = whole.filter("parent_key IS NOT NULL").drop("own_key").unionByName(added.drop("own_key"))
    named = orphans.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("_parent", "parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    result = whole.filter("parent_key IS NULL").select(*columns, "ends").unionByName(named.select(*columns, "ends"))
    return result.select(*columns, F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
