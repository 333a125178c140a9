"""Real words as contexts, probabilities that add up to one, base scores against plain counts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_hpylm import corpus, held_out, words_of

from millrace.llm import pitmanyor
from millrace.llm.pitmanyor import Settings


def trained(pairs):
    """Training counts by word before and word; None is the end, and stands before the first word."""
    out = defaultdict(Counter)
    for i, text in pairs:
        words = words_of(text)
        for before, word in zip([None, *words], words) if not held_out(i) else ():
            out[before][word] += 1
    return out


@pytest.mark.parametrize("more", [{}, {"bucket_bytes": 500, "block_tokens": 300}])
def test_base_columns(documents, more):
    pairs = corpus()
    count = sum(trained(pairs).values(), Counter())
    total, vocabulary = sum(count.values()), len(count)
    want = Counter()
    for i, t in pairs:
        words = words_of(t)
        score = sum(math.log10((count[w] + 1) / (total + vocabulary + 1)) for w in words)
        want[(i, held_out(i), len(words), sum(count[w] > 0 for w in words), total, round(score, 6))] += 1
    rows = pitmanyor.score(documents(pairs), **more).collect()
    assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_each_word_before_is_a_restaurant(documents):
    """``aaxyz`` and ``bbxyz`` end alike, and so do the words before them; what follows them differs."""
    pairs = [(i, f"{a}xyz {w}") for i in range(200) for a, w in (("aa", "left"), ("bb", "right"))]
    pairs += [(9000, "aaxyz left"), (9001, "bbxyz left"), (9002, "aaxyz right"), (9003, "bbxyz right")]
    score = {r["doc_id"]: r["score"] for r in pitmanyor.score(documents(pairs)).collect()}
    assert score[9000] > score[9001] + 1 and score[9003] > score[9002] + 1


def test_scores_without_draws_are_exact(documents):
    """No pair is seen twice: every dish sits at one table, and a hand calculation gives the scores."""
    learned, asked = [i for i in range(50) if not held_out(i)][:3], next(i for i in range(50) if held_out(i))
    pairs = list(zip(learned, ("a b c", "c a", "b x")))
    rooms = trained(pairs)
    assert max(c for room in rooms.values() for c in room.values()) == 1
    (d1, d0), (s1, s0) = (0.7, 0.0), (1.0, 1.5)
    settings = Settings(discounts=(d1, d0), strengths=(s1, s0))
    tables = Counter(w for room in rooms.values() for w in room)
    rows = {r["doc_id"]: r["score"] for r in pitmanyor.score(documents([*pairs, (asked, "x x q")]), settings).collect()}
    base = 1 / (len(tables) + 1)

    def probability(before, word):
        room = rooms.get(before, Counter())
        root = (tables[word] + s0 * base) / (s0 + tables.total())
        return (max(room[word] - d1, 0) + (s1 + d1 * len(room)) * root) / (s1 + room.total())

    for i, text in [*pairs, (asked, "x x q")]:
        words = words_of(text)
        want = sum(math.log10(probability(b, w)) for b, w in zip([None, *words], words))
        assert rows[i] == pytest.approx(want, abs=1e-9)


def test_probabilities_add_up_to_one():
    """In every restaurant, over all known words and one unknown, for any seats."""
    rng = np.random.default_rng(3)
    n, settings = 12, Settings()
    count = rng.poisson(1.5, (n, n))  # by word and word before
    samples = [np.minimum(count, 1 + rng.poisson(0.7, (n, n))) for _ in range(2)]
    known = np.flatnonzero(count.sum(1))
    words, roots = [np.append(count.sum(0), 0)], []  # customers of a restaurant
    for tables in samples:
        root_tables = np.minimum(tables.sum(1), 2)
        words += [np.append(tables.sum(1), 0), np.append(root_tables, 0), np.append(tables.sum(0), 0)]
        roots.append(pitmanyor.Root(int(tables.sum()), int(root_tables.sum()), len(known)))
    every = [*known, n]
    for before in every:
        pairs = [np.array([x[w, before] if w < n and before < n else 0 for w in every]) for x in (count, *samples)]
        chance = pitmanyor.probabilities(np.array(words), np.array(pairs), np.array(every), np.full(len(every), before), roots, settings)
        assert (chance > 0).all() and chance.sum() == pytest.approx(1, abs=1e-9)


def test_better_than_unigrams_on_held_out_texts(documents):
    rows = [r for r in pitmanyor.score(documents(corpus(600))).collect() if r["held_out"] and r["n_tokens"] > 5 and r["doc_id"] is not None and r["doc_id"] < 400]
    tokens = sum(r["n_tokens"] for r in rows)
    model, base = (10 ** (-sum(r[c] for r in rows) / tokens) for c in ("score", "base_score"))
    assert tokens > 500 and model < 0.5 * base


def test_words_of_one_hash_are_told_apart(documents, monkeypatch):
    """Under the first hash all words are one; the second serves."""
    want = {r["doc_id"]: r["base_score"] for r in pitmanyor.score(documents(corpus(20))).collect()}
    plain = pitmanyor.hashes_of
    short = lambda words, salt: plain(words, salt) if salt else np.full(len(words), 7, "<u8")
    monkeypatch.setattr(pitmanyor, "hashes_of", short)
    assert {r["doc_id"]: r["base_score"] for r in pitmanyor.score(documents(corpus(20))).collect()} == pytest.approx(want)


def test_nothing_to_learn_from(documents):
    assert pitmanyor.score(documents([])).count() == 0
    (row,) = pitmanyor.score(documents([(None, "only held out")])).collect()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["n_tokens"] == 4
    assert row["base_score"] == 0 and math.isfinite(row["score"])


ODD = ["", " ", "a", "\t b  A\n", *(f"x{chr(c)}y{chr(c)}" for c in range(128)), "\u00a0c\u2003d \u0085", "a\0 a", "\u00c4 \u00e4", "  ", "B b"]


def test_words_are_split_as_bytes_are():
    """In Arrow, with no Python object for a word: its kernels have to know the same white space and letters."""
    words, sizes = pitmanyor.words_of(pa.array(ODD))
    want = [t.encode().lower().split() for t in ODD]
    assert words.cast(pa.binary()).to_pylist() == sum(want, []) and sizes.tolist() == list(map(len, want))


@pytest.mark.parametrize("block_tokens", [1, 7, 1000])
def test_blocks_hold_the_tokens_of_all_texts(block_tokens):
    columns = {"doc_id": range(len(ODD)), "held_out": [i % 3 == 0 for i in range(len(ODD))], "text": ODD, "part": [2] * len(ODD)}
    batches = pa.table({n: pa.array(c) for n, c in columns.items()}).to_batches(max_chunksize=50)
    at = 0
    for number, block in enumerate(pitmanyor.blocks(iter(batches), block_tokens, 0)):
        assert isinstance(block.words, pa.Array) and block.number == (2 << 24) + number
        assert (np.diff(block.hashes.astype(float)) >= 0).all() and len(set(block.hashes.tolist())) == len(block.words)
        words = block.words.to_pylist()
        texts = np.split(np.array([*words, None], object)[block.tokens], block.ends[:-1])
        assert [t.tolist() for t in texts] == [[*ODD[i].encode().lower().split(), b" "] for i in block.ids]
        assert words[block.start] == b" " and block.ids == list(range(at, at + len(block.ids)))
        assert block.held == [i % 3 == 0 for i in block.ids] and (len(block.ids) == 1 or len(block.tokens) <= block_tokens + 1)
        at += len(block.ids)
    assert at == len(ODD)


def test_counted_pairs_are_those_of_all_tokens():
    rng = np.random.default_rng(5)
    for n in (1, 2, 9):
        tokens, counts = rng.integers(0, n, 60, np.int32), rng.random(60) < 0.5
        word, before, pair = pitmanyor.pairs_of(tokens, n - 1, n)
        assert (word[pair] == tokens).all() and (before[pair] == [n - 1, *tokens[:-1]]).all()
        for got, want in zip(pitmanyor.counted_pairs(tokens, n - 1, n, counts), (word, before, np.bincount(pair[counts], minlength=len(word)))):
            assert got.tolist() == want.tolist()


def test_packed():
    for x in ([], [0], [5, 1 << 40, 0], list(range(3000))):
        assert pitmanyor.unpacked(pitmanyor.packed(np.array(x, np.int64))).tolist() == x
