"""Near-duplicates by shingle similarity: Golay and min-hash keys, candidate trees, exact verification, components.

The similarity of two texts is the share of common ones among all their distinct shingles.
A text gets ``BANDS`` keys of ``ROWS`` min-hashes each; two texts of similarity 0.8 miss all
of them with probability (1 - 0.8^5)^20 = 0.0004.  Texts that share a key are compared by the
share of equal min-hashes, which names candidates only; a link is made after comparing the
shingles themselves.  Texts whose fingerprints differ in two bits at most are candidates too: they are found
by Golay keys, as in ``simhash``.

A group of texts with one key gives a tree of its most similar pairs, a few nearest ones of
each text and, for texts whose nearest one is no sure link, the best connected texts of the group;
never all pairs.  Large groups are dealt to parts.  A component of a part sends its best
connected texts to the next round, and every text without a sure link goes there too.  Before
they are dealt anew, all of them meet the best connected texts of their whole group, so that the
many variants of one text find it whatever part it is in.  Texts that stay apart are grouped
once more by further min-hashes, in parts of bounded size.

That names few pairs, not all.  So when they are verified and linked, all texts of a large group that
are still in different components meet, part by part (``rest_links``): no pair of similar estimates
with a key in common is left uncompared, but those that other links join already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import simhash
from millrace.llm.common import Batches, in_slices, mapped, whole_texts
from millrace.llm.components import connected
from millrace.session import materialise

# Production parameters of a near-duplicate stage.
SHINGLE_WORDS = 5
SIMILARITY = 0.8

BANDS, ROWS = 20, 5
HASHES = BANDS * ROWS
SLACK = 0.18  # that the estimate of a candidate may lie below the similarity: more than four deviations
PART_ROWS = 128  # texts of a key that are compared at once
ALL_PAIRS = 8  # texts of a key of which every pair may be a candidate
NEIGHBOURS = 2  # candidates of a text beside the tree, in a larger group
SENT_ON = 4  # texts of a component that meet those of other parts
HUBS = 8  # best connected texts of a group, candidates of all that have no sure link
SURE = SLACK / 2  # above the similarity, an estimate is a sure link: the pair's own is hardly below it
LIKELY = SLACK / 3  # below the similarity, an estimate with a best connected text still settles a text: the pair is verified
FINER_ROWS = 512  # texts of a further key that are compared at once
REST_ROWS = 512  # texts of a part that meet those of another, where a group is in several components

_rng = np.random.default_rng(20)
FLIPS = _rng.integers(0, 1 << 63, HASHES, np.uint64)
FACTORS = _rng.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1) | np.uint64(1)


def shingle_hashes(text: str, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct XXH64 of all word shingles; words as in ``simhash.fingerprint``.

    A text of fewer words is one shingle; one without words has none.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle_words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(words) - shingle_words + 1))


def content(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set of shingles: equal sets, equal names."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 7)).view(np.int64))


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The smallest of each of ``HASHES`` mixes of the shingles; all ones for an empty set."""
    least = np.full(HASHES, ~np.uint64(0))
    for start in range(0, len(hashes), 1 << 13):
        mixed = (hashes[start : start + (1 << 13), None] ^ FLIPS) * FACTORS
        np.minimum(least, (mixed ^ mixed >> np.uint64(32)).min(0), out=least)
    return least


def _keys(least: np.ndarray) -> np.ndarray:
    """A key for each band, which holds the number of the band."""
    import xxhash

    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], np.uint64).view(np.int64)


def signatures(docs: DataFrame, shingle_words: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fp`` (the name of the shingle set), ``print`` (``simhash.fingerprint``), ``keys`` and ``sig`` (one byte of each min-hash) of every row."""

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            texts = batch.column("text").to_pylist()
            sets = [shingle_hashes(t, shingle_words) for t in texts]
            least = [min_hashes(s) for s in sets]
            columns = [
                batch.column("doc_id"),
                pa.array([content(s) for s in sets], pa.int64()),
                pa.array(np.array([simhash.fingerprint(t) for t in texts], np.uint64).view(np.int64)),
                pa.array([_keys(x) for x in least], pa.list_(pa.int64())),
                pa.array([(x >> np.uint64(8)).astype(np.uint8).tobytes() for x in least], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "print", "keys", "sig"])

    return mapped(whole_texts(docs, id_col, text_col), run, "doc_id long, fp long, print long, keys array<long>, sig binary")


def _agreeing(sigs: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The number of equal min-hashes of every row and one."""
    return (sigs == one).sum(1)


def candidate_pairs(sigs: np.ndarray, similarity: float) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Positions of candidate pairs in a group, positions of what is sent on, and how many each position seems similar to.

    A tree of the largest estimates (Prim's, a row at a time), each text's nearest ones, and
    the best connected texts for those without a sure link; all pairs of a group of ``ALL_PAIRS`` or less.  In a
    larger one a wrong estimate may hide a link: ``rest_links`` compares what this leaves apart.
    """
    n, width = sigs.shape
    least = (similarity - SLACK) * width
    pairs: list[tuple[int, int]] = []
    best, origin = np.full(n, -1), np.zeros(n, np.int64)
    left = np.ones(n, bool)
    order, part = np.empty(n, np.int64), np.empty(n, np.int64)
    degree, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
    here = label = 0
    for step in range(n):
        left[here] = False
        near = _agreeing(sigs, sigs[here])
        near[here] = -1
        order[step], part[step] = here, label
        degree[here], top[here] = (near >= similarity * width).sum(), near.max()
        if n <= ALL_PAIRS:
            found = np.flatnonzero(near >= least)
        else:
            found = np.argpartition(-near, NEIGHBOURS)[:NEIGHBOURS]
            found = found[near[found] >= least]
        pairs += ((here, j) for j in found.tolist())
        better = left & (near > best)
        best[better], origin[better] = near[better], here
        if step + 1 < n:
            here = int(np.where(left, best, -2).argmax())
            label += int(best[here] < similarity * width)
            if best[here] >= least:
                pairs.append((int(origin[here]), here))
    unsure = top < (similarity + SURE) * width
    if n > ALL_PAIRS and unsure.any():
        for hub in np.argsort(-degree, kind="stable")[:HUBS]:
            near = _agreeing(sigs, sigs[hub])
            near[hub] = -1
            pairs += ((int(hub), j) for j in np.flatnonzero(unsure & (near >= least)).tolist())
    rank = np.lexsort((order, -degree[order], part))
    first = np.searchsorted(part[rank], part[rank])
    sent = unsure.copy()
    sent[order[rank][np.arange(n) - first < SENT_ON]] = True
    return pairs, np.flatnonzero(sent), degree


COMPARED = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
        T.StructField("key", T.LongType()),
        T.StructField("sig", T.BinaryType()),
        T.StructField("degree", T.LongType()),
    ]
)

# A group's candidate pairs by node, and its rows that are sent on: (node, key, sig, degree).
Found = tuple[np.ndarray, list[tuple[int, int, bytes, int]]]


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)


def _together(rows: pa.Table, similarity: float) -> Found:
    """All texts of a part against each other; those of keys with more parts are sent on."""
    nodes, more = rows.column("node").to_numpy(), rows.column("parts")[0].as_py() > 1
    if len(nodes) < 2 and not more:
        return np.empty((0, 2), np.int64), []
    raw = rows.column("sig").to_pylist()
    pairs, sent, degree = candidate_pairs(_matrix(raw), similarity)
    ends = nodes[np.array(pairs, np.int64).reshape(-1, 2)]
    key = rows.column("key")[0].as_py()
    return np.sort(ends, 1), [(int(nodes[i]), key, raw[i], int(degree[i])) for i in sent.tolist()] if more else []


def _with_hubs(rows: pa.Table, similarity: float) -> Found:
    """The texts of a part against the best connected ones of their key, which come first; those without a likely link are sent on."""
    n = rows.column("is_text").combine_chunks().false_count
    nodes, raw = rows.column("node").to_numpy(), rows.column("sig").to_pylist()
    sigs, degree = _matrix(raw), rows.column("degree").to_numpy()
    width = sigs.shape[1]
    pairs, unsure = [np.empty((0, 2), np.int64)], np.ones(len(nodes) - n, bool)
    for hub in range(n):
        near = _agreeing(sigs[n:], sigs[hub])
        other = nodes[n:] != nodes[hub]
        found = nodes[n:][other & (near >= (similarity - SLACK) * width)]
        pairs.append(np.stack([np.full(len(found), nodes[hub]), found], 1))
        unsure &= ~(other & (near >= (similarity - LIKELY) * width))
    key = rows.column("key")[0].as_py()
    sent = [(int(nodes[i]), key, raw[i], int(degree[i])) for i in (np.flatnonzero(unsure) + n).tolist()]
    return np.sort(np.concatenate(pairs), 1), sent


def _whole_groups(batches: Batches, *columns: str) -> Iterator[pa.Table]:
    """Rows that come sorted by the columns, in tables that end where a group does."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        places = np.stack([batch.column(c).to_numpy() for c in columns])
        last = np.flatnonzero((places != places[:, -1:]).any(axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
        goes_on = kept and [kept[0].column(c)[0].as_py() for c in columns] == places[:, -1].tolist()
        if not cut and (goes_on or not kept):
            kept.append(batch)
            continue
        yield pa.Table.from_batches([*kept, batch.slice(0, cut)]).combine_chunks()
        kept = [batch.slice(cut)]
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _groups(rows: pa.Table, *columns: str) -> list[pa.Table]:
    places = np.stack([rows.column(c).to_numpy() for c in columns])
    edges = (np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1).tolist()
    return [rows.slice(a, b - a) for a, b in zip([0, *edges], [*edges, rows.num_rows])]


def _compared(similarity: float, compare: Callable[[pa.Table, float], Found]):
    """Rows come sorted by key and part: candidate pairs ``a, b`` of each part, and what is sent on."""

    def out(rows: pa.Table) -> pa.RecordBatch:
        found = [compare(group, similarity) for group in _groups(rows, "key", "part")]
        pairs = np.unique(np.concatenate([p for p, _ in found]), axis=0)
        sent = [s for _, more in found for s in more]
        none, empty = [None] * len(sent), [None] * len(pairs)
        columns = [
            pa.array(pairs[:, 0].tolist() + [s[0] for s in sent], pa.int64()),
            pa.array(pairs[:, 1].tolist() + none, pa.int64()),
            pa.array(empty + [s[1] for s in sent], pa.int64()),
            pa.array(empty + [s[2] for s in sent], pa.binary()),
            pa.array(empty + [s[3] for s in sent], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "sig", "degree"])

    return lambda batches: map(out, _whole_groups(batches, "key", "part"))


def _parts(rows: DataFrame, part_rows: int) -> DataFrame:
    """``key, parts`` of every key that several rows have: a power of two, so that a part has about ``part_rows`` rows."""
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.col("n") / part_rows)), F.lit(0)))
    return shared.select("key", parts.cast("int").alias("parts"))


def _dealt(rows: DataFrame, part_rows: int) -> DataFrame:
    """The rows whose key has others, with the number of its parts and their own."""
    return rows.join(_parts(rows, part_rows), "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _of_parts(dealt: DataFrame, similarity: float, compare: Callable, *first: str) -> DataFrame:
    ordered = dealt.repartition("key", "part").sortWithinPartitions("key", "part", *first, "node")
    return materialise(mapped(ordered, _compared(similarity, compare), COMPARED), "compared")


def _sent(done: DataFrame) -> DataFrame:
    return done.filter("b is null").select("key", F.col("a").alias("node"), "sig", "degree")


def _meet_hubs(rest: DataFrame, similarity: float, part_rows: int) -> DataFrame:
    """Every text with the ``HUBS`` best connected ones of its key, which are copied to all its parts."""
    order = Window.partitionBy("key").orderBy(F.desc("degree"), "node")
    hubs = rest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= HUBS).drop("place")
    columns = ["key", "part", "node", "sig", "degree"]
    copied = hubs.join(_parts(rest, part_rows), "key").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    texts = _dealt(rest, part_rows).select(*columns, F.lit(True).alias("is_text"))
    both = copied.select(*columns, F.lit(False).alias("is_text")).unionByName(texts)
    return _of_parts(both, similarity, _with_hubs, "is_text")


def candidates(signed: DataFrame, similarity: float = SIMILARITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Distinct candidate pairs ``a < b`` of the distinct ``fp``, which ``signed`` holds with ``keys`` and ``sig``."""
    sigs = signed.select(F.col("fp").alias("node"), "sig")
    keys = materialise(signed.select(F.explode("keys").alias("key"), F.col("fp").alias("node")), "keys")
    pairs_of = lambda done: done.filter("b is not null").select("a", "b")

    columns = ["key", "node", "sig", "parts", "part"]
    done = _of_parts(_dealt(keys, part_rows).join(sigs, "node").select(*columns), similarity, _together)
    pairs, before, last = pairs_of(done), None, False
    while True:
        rest = _sent(done)
        if rest.isEmpty():
            break
        met = _meet_hubs(rest, similarity, part_rows)
        pairs = pairs.unionByName(pairs_of(met))
        rest = _sent(met)
        n = rest.count()
        if last or not n:
            break
        last = before is not None and 2 * n > before  # mostly unlike texts: group by other min-hashes, once
        if last:
            places = F.explode(F.sequence(F.lit(0), F.lit(15)))
            finer = rest.select("node", "sig", "key").withColumn("place", places).select(
                F.xxhash64("key", "place", F.expr("substring(sig, 1 + 6 * place, 4)")).alias("key"), "node", "sig"
            )
            done = _of_parts(_dealt(finer, FINER_ROWS).select(*columns), similarity, _together)
        else:
            again = rest.withColumn("key", F.xxhash64("key")).select("key", "node", "sig")
            done = _of_parts(_dealt(again, part_rows).select(*columns), similarity, _together)
        before = n
        pairs = pairs.unionByName(pairs_of(done))
    return materialise(pairs.distinct(), "candidates")


CELL = ["key", "one", "other"]


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the two parts that meet in a cell: twice the same ones where a part meets itself."""
    part = cell.column("part").to_numpy()
    return np.flatnonzero(part == cell.column("one")[0].as_py()), np.flatnonzero(part == cell.column("other")[0].as_py())


def _apart(similarity: float) -> Callable[[Batches], Batches]:
    """The rows of each cell that seem similar to one of the other side that is in another component."""

    def of(cell: pa.Table) -> np.ndarray:
        sigs, root = _matrix(cell.column("sig").to_pylist()), cell.column("root").to_numpy()
        left, right = _sides(cell)
        hit, others, roots = np.zeros(len(root), bool), sigs[right], root[right]
        for i in left.tolist():
            if (roots != root[i]).any():
                near = (_agreeing(others, sigs[i]) >= (similarity - SLACK) * sigs.shape[1]) & (roots != root[i])
                hit[i] |= near.any()
                hit[right[near]] = True
        return hit

    def run(batches: Batches) -> Batches:
        for rows in _whole_groups(batches, *CELL):
            hit = np.concatenate([of(cell) for cell in _groups(rows, *CELL)])
            yield from rows.drop_columns("sig").filter(pa.array(hit)).to_batches()

    return run


def _linked(similarity: float) -> Callable[[Batches], Batches]:
    """Links ``a, b`` of similar texts of the two sides of each cell that join components, by their shingles."""

    def of(cell: pa.Table) -> list[tuple[int, int]]:
        node, root = cell.column("node").to_numpy(), cell.column("root").to_numpy().copy()
        left, right = _sides(cell)
        sets = [np.frombuffer(x, np.uint32) for x in cell.column("shingles").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        values, own = np.unique(np.concatenate(sets), return_inverse=True)
        mark, links = np.zeros(len(values), bool), []
        for i in left.tolist():
            if (root[right] == root[i]).all():
                continue
            mine = own[starts[i] : starts[i + 1]]
            mark[mine] = True
            common = np.diff(np.concatenate([[0], np.cumsum(mark[own])])[starts])
            mark[mine] = False
            alike = common >= similarity * (sizes[i] + sizes - common) - 1e-9
            near = right[alike[right] & (root[right] != root[i])]
            joined, first = np.unique(root[near], return_index=True)
            links += ((int(node[i]), int(node[j])) for j in near[first])
            root[np.isin(root, joined)] = root[i]
        return links

    def run(batches: Batches) -> Batches:
        for rows in _whole_groups(batches, *CELL):
            pairs = np.array([pair for cell in _groups(rows, *CELL) for pair in of(cell)], np.int64).reshape(-1, 2)
            pairs.sort(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def rest_links(
    signed: DataFrame, links: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: float = SIMILARITY, part_rows: int = PART_ROWS
) -> DataFrame:
    """Links ``a, b`` that all pairs of one key add to ``links``; ``sets`` gives ``fp, shingles`` of a table of ``fp``.

    Groups of which ``candidate_pairs`` names all pairs, and those in one component, have none.  The texts of another are
    dealt to parts and every part meets every part in a cell of its own; a cell keeps a link for each two components it joins.  Pairs
    of different components are compared by their estimates, and by their shingles where one is high enough.
    """
    named = connected(links).withColumnRenamed("node", "fp")
    keys = signed.select(F.explode("keys").alias("key"), F.col("fp").alias("node"))
    large = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > min(ALL_PAIRS, part_rows))
    members = materialise(
        keys.join(large, "key").join(named.withColumnRenamed("fp", "node"), "node", "left").select("key", "n", "node", F.coalesce("root", "node").alias("root")),
        "members",
    )
    mixed = members.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("key")
    parts = F.ceil(F.col("n") / REST_ROWS).cast("int")
    dealt = members.join(mixed, "key", "left_semi").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("key", F.least("part", "with").alias("one"), F.greatest("part", "with").alias("other"), "part", "node", "root")
    in_cells = lambda rows: rows.repartition(*CELL).sortWithinPartitions(*CELL)
    kinds = "key long, one int, other int, part int, node long, root long"
    rows = in_cells(met.join(signed.select(F.col("fp").alias("node"), "sig"), "node").select(*CELL, "part", "node", "root", "sig"))
    open_ = materialise(mapped(rows, _apart(similarity), kinds), "apart")
    if open_.isEmpty():
        return links.limit(0)
    shingles = sets(open_.select(F.col("node").alias("fp")).distinct()).withColumnRenamed("fp", "node")
    return materialise(mapped(in_cells(open_.join(shingles, "node").select(*CELL, "part", "node", "root", "shingles")), _linked(similarity), "a long, b long"), "rest")


def golay_candidates(prints: DataFrame) -> DataFrame:
    """Candidate pairs ``a < b`` of the distinct ``fp`` by their ``print``: a path over all whose fingerprints are within two bits.

    Texts of one fingerprint meet the first of them, and the first ones meet as ``simhash.near_links`` says.
    """
    first = materialise(prints.groupBy("print").agg(F.min("fp").alias("first")), "prints")
    links = simhash.near_links(first.select(F.col("print").alias("fp")))
    named = lambda end: first.select(F.col("print").alias(end), F.col("first").alias(f"{end}_first"))
    apart = links.join(named("a"), "a").join(named("b"), "b").select(F.col("a_first").alias("x"), F.col("b_first").alias("y"))
    same = prints.join(first, "print").select(F.col("first").alias("x"), F.col("fp").alias("y"))
    both = apart.unionByName(same.filter("x != y"))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose shingle sets (``fp, shingles``) are similar enough."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                u, v = (np.frombuffer(s.as_buffer(), np.uint32) for s in (x, y))
                common = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(common >= similarity * (len(u) + len(v) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("left")), "a")
    both = both.join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("right")), "b")
    return mapped(both.select("a", "b", "left", "right"), run, "a long, b long")


def _sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    """``fp, shingles`` of texts: the distinct shingles as sorted 32-bit hashes."""

    def run(batches: Batches) -> Batches:
        for batch in in_slices(batches):
            sets = [shingle_hashes(t, shingle_words) for t in batch.column("text").to_pylist()]
            short = [np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets]
            names = pa.array([content(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([names, pa.array(short, pa.binary())], ["fp", "shingles"])

    return mapped(texts, run, "fp long, shingles binary").groupBy("fp").agg(F.first("shingles").alias("shingles"))


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle_words: int = SHINGLE_WORDS,
    part_rows: int = PART_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id reachable over similar texts.

    A null text counts as empty; texts without words are equal to each other, one of fewer
    words than a shingle is one shingle.  Repeated rows give one row each, in one component.  Rows
    without an id belong to their text's component and never name it (a component of such rows alone
    has a null id).  Of ties the smallest id names the component.  An empty table gives an empty one.
    """
    signed = materialise(signatures(docs, shingle_words, id_col, text_col), "signatures")
    # Texts of one shingle set may differ in repeats and so in their prints: the least one stands for them.
    least, one = F.min("doc_id").alias("least"), F.min("print").alias("print")
    once = signed.groupBy("fp").agg(least, one, F.first("keys").alias("keys"), F.first("sig").alias("sig"))
    once = materialise(once, "distinct")
    near = golay_candidates(once.select("fp", "print"))
    pairs = materialise(candidates(once, similarity, part_rows).unionByName(near).distinct(), "pairs")
    texts = whole_texts(docs, id_col, text_col)

    def sets(named: DataFrame) -> DataFrame:
        ids = materialise(once.join(named, "fp", "left_semi").select(F.col("least").alias("doc_id")).distinct(), "ends")
        needed = texts.join(ids, "doc_id", "left_semi").unionByName(texts.filter("doc_id is null"))
        return materialise(_sets(needed, shingle_words), "sets")

    ends = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    links = materialise(verified(pairs, sets(ends), similarity), "verified")
    links = links.unionByName(rest_links(once, links, sets, similarity, part_rows))
    return simhash.in_components(signed.select("doc_id", "fp"), once.select("fp", "least"), links)


def one_of_each(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle_words: int = SHINGLE_WORDS,
    part_rows: int = PART_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents without near-duplicates; which rows stay follows ``simhash.one_of_each``."""
    found = near_duplicates(docs, similarity, shingle_words, part_rows, id_col, text_col)
    name = lambda text: content(shingle_hashes(text, shingle_words))
    return simhash.one_of_component(docs, found, name, id_col, text_col)
