"""Byte-level BPE: texts to token ids and back, by the tiktoken library with a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import Batches, in_slices, mapped, whole_texts

# Texts longer than this are encoded in pieces of about this many characters.
PIECE_CHARS = 50_000

# The part of the split pattern that looks ahead.  Without it the pattern needs no
# backtracking; it changes matches only where two white-space characters meet.
LOOKAHEAD = r"\s+(?!\S)|"


def rank_bytes(path: str) -> bytes:
    """The rank file's content, read once on the driver and sent to the tasks (under 2 MB)."""
    return Path(path).read_bytes()


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text where no match of the split pattern can cross.

    A match never holds a space after a character that is not white space, and the
    pattern never looks back; nor does it look ahead except behind white space.  So the
    place before a space that follows another character is a boundary in any context.
    A text without such a place stays whole.
    """
    start, boundary = 0, re.compile(r"(?<=\S) ")
    while len(text) - start > size:
        found = boundary.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encoder(ranks: bytes, pattern: str) -> Callable[[str], list[int]]:
    """A function from a text to its ids, without special tokens."""
    import tiktoken

    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    whole = tiktoken.Encoding("whole", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    plain = whole
    if LOOKAHEAD in pattern:
        plain = tiktoken.Encoding(
            "plain", pat_str=pattern.replace(LOOKAHEAD, ""), mergeable_ranks=table, special_tokens={}
        )
    meet = re.compile(r"\s\s")

    def encode(text: str) -> list[int]:
        if len(text) > PIECE_CHARS:
            ids: list[int] = []
            for piece in safe_pieces(text):
                ids += (whole if meet.search(piece) else plain).encode_ordinary(piece)
            return ids
        return (whole if meet.search(text) else plain).encode_ordinary(text)

    return encode


def _encoding(ranks: bytes, pattern: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encode = encoder(ranks, pattern)
        for batch in in_slices(batches):
            ids = [np.asarray(encode(t), dtype="<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    return run


def _decoding(ranks: bytes) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        decode = tiktoken.Encoding("back", pat_str=r"\s+", mergeable_ranks=table, special_tokens={}).decode_bytes
        for batch in batches:
            data = [
                None if ids is None else decode(np.frombuffer(ids, "<u4").tolist())
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(data, pa.binary())],
                ["doc_id", "ids", "data"],
            )

    return run


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: ``doc_id``, ``ids`` (little-endian unsigned 32-bit numbers).

    A null text counts as empty and has no ids; repeated rows and null ids give one row
    each; an empty table gives none.  Each match of ``pattern`` is encoded by itself.
    """
    return mapped(
        whole_texts(docs, id_col, text_col), _encoding(rank_bytes(rank_file), pattern), "doc_id long, ids binary"
    )


def decode(tokens: DataFrame, rank_file: str) -> DataFrame:
    """Bytes of every row of ``encode``: adds ``data`` (null for null ids).

    The bytes are returned raw, since a cut through a sequence of ids need not fall on a
    character.
    """
    return mapped(tokens.select("doc_id", "ids"), _decoding(rank_bytes(rank_file)), "doc_id long, ids binary, data binary")


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``decode(encode(docs))`` in one Python pass: ``doc_id``, ``ids``, ``data``."""
    ranks = rank_bytes(rank_file)
    there, back = _encoding(ranks, pattern), _decoding(ranks)
    return mapped(
        whole_texts(docs, id_col, text_col), lambda batches: back(there(batches)), "doc_id long, ids binary, data binary"
    )
