"""Exact top-k search by inner product: one KD-tree per shard, searched best box first.

Vectors are dealt to shards by region: the leaves of a small tree that splits a sample at its
medians.  A shard's tree splits at medians and keeps the tight bounding box of every node.
A query visits nodes in the order of the best score their box allows and stops when no box
can beat its kth score.  It searches its home shard first; the kth score found there travels
with it to those other shards whose box can beat it, and to no others.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Batches, mapped, usual_length
from millrace.session import materialise

SHARD_ROWS = 16_384
LEAF_ROWS = 256
QUERY_BLOCK = 256  # queries whose box bounds are computed together
SAMPLE_ROWS = 16_384  # vectors that shape the regions; the result does not depend on them
BOX_BYTES = 64_000_000  # of the boxes of all shards, which are sent to the tasks; beyond it shards get larger

LOWEST = -(2**63)


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` = floor(scale * x), x as double, of every usable vector.

    A null vector, one that holds a null, NaN or infinite component, and a row without an
    id take no part.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
        .filter(F.col("x").isNotNull() & F.col("vec_id").isNotNull() & usable)
        .select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))
    )


@dataclass
class Tree:
    """Nodes in one array each; a leaf's rows are ``start`` to ``end`` of the reordered matrix."""

    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray  # first of two adjacent children, or -1
    start: np.ndarray
    end: np.ndarray
    least_id: np.ndarray


def build(ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Median splits along the widest side; equal values may lie on both sides of a split."""
    order = np.arange(len(rows))
    child, start, end = [-1], [0], [len(rows)]
    low, high, least = [], [], []
    node = 0
    while node < len(child):
        a, b = start[node], end[node]
        part = rows[order[a:b]]
        low.append(part.min(0))
        high.append(part.max(0))
        least.append(ids[order[a:b]].min())
        side = int(np.argmax(high[-1] - low[-1])) if part.shape[1] else 0
        if b - a > leaf_rows and part.shape[1] and high[-1][side] > low[-1][side]:
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, side], middle)]
            child[node] = len(child)
            for x, y in ((a, a + middle), (a + middle, b)):
                child.append(-1)
                start.append(x)
                end.append(y)
        node += 1
    as_array = lambda x: np.array(x, np.int64)
    return Tree(
        ids[order], rows[order], np.array(low), np.array(high), as_array(child), as_array(start), as_array(end), as_array(least)
    )


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer product of matrices: by doubles where every sum stays below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[-1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def search(
    tree: Tree, queries: np.ndarray, own: np.ndarray, k: int, bounds: np.ndarray, bound_ids: np.ndarray
) -> Iterator[list[tuple[int, int]]]:
    """For each query its k best ``(score, id)`` in the tree that can be among its k best of all.

    ``bounds`` and ``bound_ids`` are the kth score known so far and the id that holds it:
    what is worse, or equal with a larger id, is left out.  ``own`` is the query's own id.
    """
    ceiling = _product(np.maximum(queries, 0), tree.high.T) + _product(np.minimum(queries, 0), tree.low.T)
    for i, query in enumerate(queries):
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst first
        limit = (int(bounds[i]), -int(bound_ids[i]))
        waiting = [(-int(ceiling[i, 0]), 0)]
        while waiting:
            top, node = heapq.heappop(waiting)
            if -top < limit[0]:
                break
            if (-top, -int(tree.least_id[node])) < limit:
                continue  # a tie that only larger ids could hold
            if tree.child[node] >= 0:
                for c in (int(tree.child[node]), int(tree.child[node]) + 1):
                    if ceiling[i, c] >= limit[0]:
                        heapq.heappush(waiting, (-int(ceiling[i, c]), c))
                continue
            a, b = tree.start[node], tree.end[node]
            score = _product(tree.rows[a:b], query)
            near = np.flatnonzero(score >= limit[0])
            if len(near) > k + 1:  # keep the k + 1 best by score, then id: one may be the query itself
                near = near[np.lexsort((tree.ids[a:b][near], -score[near]))[: k + 1]]
            for j in near:
                item = (int(score[j]), -int(tree.ids[a + j]))
                if -item[1] == own[i] or item < limit:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                else:
                    heapq.heappushpop(best, item)
                if len(best) == k:
                    limit = max(limit, best[0])
        yield sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))


def _visits(k: int, leaf_rows: int) -> Callable[[Batches], Batches]:
    """Each shard's rows arrive together: first its vectors, then queries, which are streamed."""

    def run(batches: Batches) -> Batches:
        shard, tree, ids, rows = None, None, [], []
        for batch in batches:
            table = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("shard", "vec_id", "bound", "bound_id")}
            query = batch.column("is_query").to_numpy(zero_copy_only=False)
            width = len(batch.column("v")[0])
            values = batch.column("v").flatten().to_numpy().reshape(-1, width)
            change = np.flatnonzero(np.diff(table["shard"]) | (np.diff(query.astype(int)) != 0)) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows]):
                if table["shard"][a] != shard:
                    shard, tree, ids, rows = table["shard"][a], None, [], []
                if not query[a]:
                    ids.append(table["vec_id"][a:b])
                    rows.append(values[a:b])
                    continue
                if tree is None and ids:
                    tree = build(np.concatenate(ids), np.concatenate(rows), leaf_rows)
                if tree is None:
                    continue
                for x in range(a, b, QUERY_BLOCK):
                    y = min(b, x + QUERY_BLOCK)
                    found = search(
                        tree, values[x:y], table["vec_id"][x:y], k, table["bound"][x:y], table["bound_id"][x:y]
                    )
                    out = [(q, d, s) for q, hits in zip(table["vec_id"][x:y].tolist(), found) for s, d in hits]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"]
                        )

    return run


def _in_shards(vectors: DataFrame, queries: DataFrame, shards: int, k: int, leaf_rows: int) -> DataFrame:
    """Search every query in the shard it names, with the bound it carries."""
    own = vectors.select(
        "shard", F.lit(False).alias("is_query"), "vec_id", "v", F.lit(LOWEST).alias("bound"), F.lit(LOWEST).alias("bound_id")
    )
    rows = own.unionByName(queries.select("shard", F.lit(True).alias("is_query"), "vec_id", "v", "bound", "bound_id"))
    together = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "is_query")
    return mapped(together, _visits(k, leaf_rows), "query_id long, vec_id long, score long")


@dataclass(frozen=True)
class Regions:
    """A tree over all vectors: node n splits at ``value[n]`` of ``side[n]``; a leaf has side -1 and its region's number as value."""

    side: list[int]
    value: list[int]
    child: list[int]

    def of(self, rows: np.ndarray) -> np.ndarray:
        """The region of every row."""
        out = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, at = waiting.pop()
            if self.side[node] < 0:
                out[at] = self.value[node]
                continue
            low = rows[at, self.side[node]] <= self.value[node]
            waiting += [(self.child[node], at[low]), (self.child[node] + 1, at[~low])]
        return out


def regions(sample: np.ndarray, number: int) -> Regions:
    """Median splits of the largest part along its widest side, to about ``number`` regions."""
    side, value, child = [-1], [0], [-1]
    parts = [(-len(sample), 0, np.arange(len(sample)))]
    leaves = 1
    while leaves < number and parts:
        _, node, at = heapq.heappop(parts)
        own = sample[at]
        spread = own.max(0) - own.min(0) if len(own) else np.zeros(0)
        if not spread.any():
            continue
        best = int(np.argmax(spread))
        ordered = np.sort(own[:, best])
        cut = int(ordered[(len(ordered) - 1) // 2])
        if cut == ordered[-1]:  # more than half are the largest: cut below them
            cut = int(ordered[np.searchsorted(ordered, cut) - 1])
        side[node], value[node], child[node] = best, cut, len(side)
        for part in (at[own[:, best] <= cut], at[own[:, best] > cut]):
            heapq.heappush(parts, (-len(part), len(side), part))
            side.append(-1)
            value.append(0)
            child.append(-1)
        leaves += 1
    for number, node in enumerate(n for n in range(len(side)) if side[n] < 0):
        value[node] = number
    return Regions(side, value, child)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _in_regions(rows: DataFrame, tree: Regions) -> DataFrame:
    """``vec_id, v, region``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            region = pa.array(tree.of(_matrix(batch.column("v"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, region], ["vec_id", "v", "region"])

    return mapped(rows.select("vec_id", "v"), run, "vec_id long, v array<long>, region long")


def _boxes(dealt: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, low and high corners of the shards: one row a shard and task is shuffled, one a shard reaches the driver."""

    def least(batches: Batches) -> Batches:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            low, high = _matrix(batch.column("low")), _matrix(batch.column("high"))
            for s in np.unique(shard).tolist():
                a, b = low[shard == s].min(0), high[shard == s].max(0)
                if s in held:
                    a, b = np.minimum(a, held[s][0]), np.maximum(b, held[s][1])
                held[s] = a, b
        if held:
            corners = ([x[i].tolist() for x in held.values()] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), *(pa.array(c, pa.list_(pa.int64())) for c in corners)], ["shard", "low", "high"]
            )

    schema = "shard int, low array<long>, high array<long>"
    parts = mapped(dealt.select("shard", F.col("v").alias("low"), F.col("v").alias("high")), least, schema)
    found = mapped(parts.repartition("shard"), least, schema).collect()
    return tuple(np.array([r[c] for r in found], np.int64) for c in ("shard", "low", "high"))


def _worth(boxes: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Callable[[Batches], Batches]:
    """Every query once for each other shard whose box allows its kth score or more."""
    numbers, low, high = boxes

    def run(batches: Batches) -> Batches:
        step = max(1, (1 << 22) // len(numbers))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                v = _matrix(part.column("v"))
                ceiling = _product(np.maximum(v, 0), high.T) + _product(np.minimum(v, 0), low.T)
                bound, home = (part.column(c).to_numpy()[:, None] for c in ("bound", "shard"))
                query, shard = np.nonzero((ceiling >= bound) & (numbers[None, :] != home))
                if len(query):
                    rows = part.take(pa.array(query))
                    columns = [rows.column(c) for c in ("vec_id", "v", "bound", "bound_id")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(numbers[shard], pa.int32())], ["vec_id", "v", "bound", "bound_id", "shard"]
                    )

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The k vectors with the highest inner product for each query: ``query_id, rank, vec_id, score``.

    Both tables hold ``vec_id`` and an integer vector ``v`` (see ``quantised``).  Vectors take part,
    as queries and as candidates, if they have the length that most of ``vectors`` have (of
    equally frequent ones the largest); empty ones never do.  A query is not its own
    result, and neither are other rows of its id; queries of one id are ranked together.  Ties
    go to the smaller id; with fewer than k others, all are returned.  Scores must fit
    64 bits.  An empty table gives an empty one.

    A shard holds about ``shard_rows`` vectors of one region; a region that has more, such as the copies
    of one vector, is split by a hash.  The vectors are shuffled twice, however many queries there are.
    """
    stored = materialise(vectors.select("vec_id", "v"), "vectors")
    width = usual_length(stored, "v")
    stored = stored.filter(F.size("v") == width)
    rows = stored.count() if width else 0
    if not rows:
        return stored.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = max(1, min(-(-rows // shard_rows), BOX_BYTES // (16 * width)))
    shard_rows = -(-rows // shards)
    sample = stored.orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).select("v").collect() if shards > 1 else []
    tree = regions(np.array([r["v"] for r in sample], np.int64).reshape(-1, width), shards)
    placed = materialise(_in_regions(stored, tree), "regions")
    sizes = dict(placed.groupBy("region").count().collect())
    split = {r: -(-n // shard_rows) for r, n in sizes.items()}
    first_of = dict(zip(sorted(split), np.cumsum([0, *(split[r] for r in sorted(split))]).tolist()))
    shards = sum(split.values())
    table = [(r, first_of[r], split[r]) for r in sorted(split)]
    names = F.broadcast(stored.sparkSession.createDataFrame(table, "region long, first long, split long"))  # one row a region
    shard = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("split"))).cast("int").alias("shard")
    dealt = materialise(placed.join(names, "region").select("vec_id", "v", shard), "dealt")
    own = _in_regions(queries.filter(F.size("v") == width), tree).join(names, "region", "left").select("vec_id", "v", F.coalesce(shard, F.lit(0)).alias("shard"))
    asked = materialise(own, "queries")
    none = [F.lit(LOWEST).alias("bound"), F.lit(2**63 - 1).alias("bound_id")]
    first = materialise(_in_shards(dealt, asked.select("*", *none), shards, k, leaf_rows), "home")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
    known = kth.select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"), F.col("vec_id").alias("bound_id"))
    bounded = asked.join(known, "vec_id", "left").fillna({"bound": LOWEST, "bound_id": 2**63 - 1})
    schema = "vec_id long, v array<long>, bound long, bound_id long, shard int"
    travelling = mapped(bounded.select("vec_id", "v", "bound", "bound_id", "shard"), _worth(_boxes(dealt)), schema)
    found = first
    if shards > 1:
        found = first.unionByName(_in_shards(dealt, travelling, shards, k, leaf_rows))
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
