"""Best-fit packing of token sequences, planned on the histogram of their lengths.

The plan is made from how many pieces there are of each length, never from the pieces:
at most ``max_tokens`` counts reach the driver, whatever the corpus.  Pieces then take
the planned slots by their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Callable, Mapping
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import encoder, rank_bytes
from millrace.llm.common import Batches, in_slices, mapped, whole_texts
from millrace.session import materialise

MAX_TOKENS = 2048

# Pieces of one length are ranked in this many independent groups, so that a length that
# very many pieces share is no single group.
RANK_GROUPS = 256


def cut(length: int, most: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: all full but the first, which may be shorter."""
    first = length % most or most
    return [(0, first)] + [(s, most) for s in range(first, length, most)]


def token_pieces(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    end_id: int = 0,
    max_tokens: int = MAX_TOKENS,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is the ids of its whole text and ``end_id``; a null or empty text is
    ``end_id`` alone.  Only documents above ``max_tokens`` are cut.
    """
    ranks = rank_bytes(rank_file)

    def run(batches: Batches) -> Batches:
        encode = encoder(ranks, pattern)
        for batch in in_slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.asarray(encode(text) + [end_id], "<u4").tobytes()
                for number, (start, length) in enumerate(cut(len(ids) // 4, max_tokens)):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc, number, start, length, zlib.crc32(part), part if keep_ids else None)
                    for column, value in zip(out, row):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, types)][: 6 if keep_ids else 5], names[: 6 if keep_ids else 5]
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return mapped(whole_texts(docs, id_col, text_col), run, schema)


def length_histogram(pieces: DataFrame) -> dict[int, int]:
    """Number of pieces of each length: as many entries as there are lengths, ``max_tokens`` at most."""
    return {row[0]: row[1] for row in pieces.groupBy("length").count().collect()}


@dataclass(frozen=True)
class Slots:
    """Pieces of ``length`` with ranks from ``rank``: ``per`` of them go to each sequence from ``sequence`` on, the first of each at ``offset``."""

    length: int
    rank: int
    sequence: int
    per: int
    offset: int


def plan_best_fit(counts: Mapping[int, int], max_tokens: int = MAX_TOKENS) -> list[Slots]:
    """Best-fit decreasing over counts.

    Lengths are taken from the longest down; each goes to the fullest open sequences that
    still have room, then to new ones.  Open sequences are kept as intervals of numbers by
    the room they have left, so the work depends on the number of lengths, not of pieces.
    """
    if any(not 0 < length <= max_tokens for length in counts):
        raise ValueError(f"piece lengths must be between 1 and {max_tokens}")
    rooms: list[int] = []  # sorted; those that have open sequences
    open_ones: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # room: intervals (first, number)
    plan: list[Slots] = []
    made = 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if not open_ones[room]:
                insort(rooms, room)
            open_ones[room].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = open_ones[room].popleft()
                if not open_ones[room]:
                    rooms.pop(at)
            else:
                room, first = max_tokens, made
                number = -(-left // (max_tokens // length))
                made += number
            per = min(room // length, left)
            full = min(number, left // per)
            plan.append(Slots(length, rank, first, per, max_tokens - room))
            put(room - per * length, first, full)
            rank, left = rank + full * per, left - full * per
            if full < number and left and room == max_tokens and first + number == made:
                # the last new sequence gets what is left
                plan.append(Slots(length, rank, first + full, left, 0))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, number - full)
    return plan


def ranked(pieces: DataFrame, groups: int = RANK_GROUPS) -> DataFrame:
    """Adds ``rank``: the number of each piece among those of its length, from 0, without gaps.

    Ranks are counted within small groups and moved by the sizes of the groups before,
    so no length is ordered in one task.
    """
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    sizes = grouped.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        grouped.withColumn("_row", F.row_number().over(inner))
        .join(offsets, ["length", "_group"])
        .withColumn("rank", F.col("_before") + F.col("_row") - 1)
        .drop("_group", "_row", "_before")
    )


def take_slots(pieces: DataFrame, plan: list[Slots]) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: as-of join of each piece's rank to the plan's slots of its length.

    The plan is sent to the tasks; its size is bounded by the number of lengths.
    """
    table = np.array([astuple(s) for s in sorted(plan, key=astuple)], np.int64).reshape(-1, 5)
    keys = [*pieces.columns, "sequence_id", "offset"]

    def run(batches: Batches) -> Batches:
        first_of = np.searchsorted(table[:, 0], np.arange(table[:, 0].max(initial=0) + 2))
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for value in np.unique(length):
                own = table[first_of[value] : first_of[value + 1]]
                here = np.flatnonzero(length == value)
                slot = own[np.searchsorted(own[:, 1], rank[here], "right") - 1]
                number = rank[here] - slot[:, 1]
                sequence[here] = slot[:, 2] + number // slot[:, 3]
                offset[here] = slot[:, 4] + number % slot[:, 3] * value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], keys)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return mapped(pieces, run, f"{types}, sequence_id long, offset long")


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, plan_with: Callable = plan_best_fit) -> DataFrame:
    """Pieces with their place: ``sequence_id`` and ``offset`` in it, gapless from 0.

    ``pieces`` is written once, so that tokens are made once and a lost task finds the same
    rows again.  Pieces that are equal in all columns may exchange their places.  An empty
    table gives an empty one.
    """
    stored = materialise(pieces, "pieces")
    plan = plan_with(length_histogram(stored), max_tokens)
    return take_slots(ranked(stored), plan).drop("rank")
