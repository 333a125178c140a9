"""Byte-level BPE: exact round trips, and ids equal to whole-text encoding and to the other library."""

import base64
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tables
import pytest

from millrace.llm import bpe, packing

RANKS = tables.path("byte_bpe_multi_50k.tiktoken")
SMALL = tables.path("byte_bpe_50k.tiktoken")


def library(path):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("test", pat_str=tables.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(2)
    bits = ["word", " ", "  ", "\n", "\t", "\x1c", " ", " ", "　", "é", "ß", "日本", "'s", "'", "12", "...", "🙂", "don't", "\r\n", "<|endoftext|>"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    long = " ".join("".join(rng.choice(bits) for _ in range(6)) for _ in range(20_000))
    return [*made, long, "x" * 70_000, " " * 60_000 + "a", "a " * 60_000, ""]


def test_encoder_equals_library_on_whole_texts():
    encode, plain = bpe.encoder(bpe.rank_bytes(RANKS), tables.PATTERN), library(RANKS)
    for text in texts():
        assert encode(text) == plain.encode_ordinary(text)


def test_safe_pieces_join_and_keep_ids():
    plain = library(RANKS)
    for text in texts()[:303]:
        pieces = list(bpe.safe_pieces(text, 7))
        assert "".join(pieces) == text
        assert sum((plain.encode_ordinary(p) for p in pieces), []) == plain.encode_ordinary(text)


def test_round_trip(documents):
    pairs = [(i, t) for i, t in enumerate(texts())] + [(None, "no id"), (7, None), (3, "again"), (3, "again")]
    rows = bpe.round_trip(documents(pairs), RANKS, tables.PATTERN).collect()
    assert Counter((r["doc_id"], bytes(r["data"])) for r in rows) == Counter((i, (t or "").encode()) for i, t in pairs)
    both = bpe.decode(bpe.encode(documents(pairs), RANKS, tables.PATTERN), RANKS).collect()
    assert Counter(map(str, both)) == Counter(map(str, rows))
    assert bpe.round_trip(documents([]), RANKS, tables.PATTERN).count() == 0


def test_decode_is_raw(spark):
    half = np.array([library(RANKS).encode_single_token(b"\xe6")], "<u4").tobytes()
    tokens = spark.createDataFrame([(1, half), (2, None)], "doc_id long, ids binary")
    assert {r["doc_id"]: r["data"] and bytes(r["data"]) for r in bpe.decode(tokens, RANKS).collect()} == {1: b"\xe6", 2: None}


def test_ranks_hold_the_vocabulary_of_the_other_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(tables.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    encode = bpe.encoder(bpe.rank_bytes(SMALL), tables.PATTERN)
    for text in texts()[:301]:
        assert encode(text) == other.encode(text, add_special_tokens=False).ids


# --- packing ---------------------------------------------------------------------------------


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(25, 10) == [(0, 5), (5, 10), (15, 10)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)]


def slots(plan, counts):
    """Sequence number: lengths placed, by walking the plan piece by piece."""
    filled = {}
    for length, number in counts.items():
        own = sorted((s for s in plan if s.length == length), key=lambda s: s.rank)
        for rank in range(number):
            s = [x for x in own if x.rank <= rank][-1]
            place = rank - s.rank
            filled.setdefault(s.sequence + place // s.per, []).append((s.offset + place % s.per * length, length))
    return filled


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_gapless_and_near_the_bound(seed):
    rng = random.Random(seed)
    most = rng.choice([10, 64, 300])
    counts = Counter(min(most, max(1, int(rng.lognormvariate(rng.uniform(0.5, 4), 1)))) for _ in range(rng.choice([1, 7, 300, 1500])))
    filled = slots(packing.plan_best_fit(counts, most), counts)
    for placed in filled.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= most
    bound = -(-sum(k * v for k, v in counts.items()) // most)
    assert sorted(filled) == list(range(len(filled)))
    assert bound <= len(filled) <= bound * 11 / 9 + 1  # what best-fit decreasing promises


def test_plan_refuses_lengths_outside():
    with pytest.raises(ValueError):
        packing.plan_best_fit({11: 1}, 10)


def test_pack_whole_documents(documents):
    rng = random.Random(5)
    pairs = [(i, "word " * rng.choice([0, 1, 3, 9, 40, 200])) for i in range(400)]
    pairs += [(i, "the same length") for i in range(1000, 1300)] + [(None, "x"), (5, None), (6, "twice"), (6, "twice")]
    pieces = packing.token_pieces(documents(pairs), SMALL, tables.PATTERN, 0, 64, keep_ids=True)
    rows = packing.pack(pieces, 64).collect()
    plain = library(SMALL)
    want = Counter()
    for i, t in pairs:
        ids = np.array(plain.encode_ordinary(t or "") + [0], "<u4")
        for n, (start, length) in enumerate(packing.cut(len(ids), 64)):
            part = ids[start : start + length].tobytes()
            want[(i, n, start, length, zlib.crc32(part), part)] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows)
    assert got == want
    placed = {}
    for r in rows:
        placed.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(placed) <= -(-sum(r["length"] for r in rows) // 64) * 1.1 + 1


def test_pack_nothing(documents):
    pieces = packing.token_pieces(documents([]), SMALL, tables.PATTERN)
    assert packing.pack(pieces).count() == 0


def test_ranks_are_gapless_for_a_hot_length(spark):
    rows = [(i % 50, 0, 0, 7 if i % 3 else i % 5 + 1, i) for i in range(900)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = {}
    for r in packing.ranked(pieces, groups=8).collect():
        got.setdefault(r["length"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and len(got[7]) == 600
