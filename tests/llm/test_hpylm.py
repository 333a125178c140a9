"""Seats against enumeration, probabilities that add up to one, base scores against plain counts."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import hpylm
from millrace.llm.hpylm import Settings


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w] + [None]


def held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 == 2


def corpus(n=250):
    """Each word is mostly followed by one of two."""
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    after = {w: rng.choices(vocabulary, k=2) for w in vocabulary}
    pairs = []
    for i in range(n):
        word, words = rng.choice(vocabulary), []
        for _ in range(rng.randint(0, 80)):
            words.append(word)
            word = rng.choice(after[word] if rng.random() < 0.9 else vocabulary)
        pairs.append((i, " ".join(words)))
    pairs += [(None, "no id"), (400, None), (401, ""), (402, "É \x1c  NEVER seen"), (403, "A a " * 3000), (5, pairs[5][1]), (5, pairs[5][1])]
    return pairs


def test_base_columns(documents):
    pairs = corpus()
    count = Counter(w for i, t in pairs if not held_out(i) for w in words_of(t))
    total, vocabulary = sum(count.values()), len(count)
    want = Counter()
    for i, t in pairs:
        words = words_of(t)
        score = sum(math.log10((count[w] + 1) / (total + vocabulary + 1)) for w in words)
        want[(i, held_out(i), len(words), sum(count[w] > 0 for w in words), total, round(score, 6))] += 1
    for more in ({}, {"bucket_bytes": 500, "block_tokens": 300}):
        rows = hpylm.score(documents(pairs), **more).collect()
        assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows) == want
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_better_than_unigrams_on_held_out_texts(documents):
    """Perplexity, by the averaged predictive probabilities."""
    rows = [r for r in hpylm.score(documents(corpus(600))).collect() if r["held_out"] and r["n_tokens"] > 5 and r["doc_id"] is not None and r["doc_id"] < 400]
    tokens = sum(r["n_tokens"] for r in rows)
    model, base = (10 ** (-sum(r[c] for r in rows) / tokens) for c in ("score", "base_score"))
    assert tokens > 500 and model < 0.8 * base


def test_probabilities_add_up_to_one(documents):
    rows = hpylm.prepared(documents(corpus()))
    merged = hpylm.merged_counts(rows, 16, 1000)
    settings = Settings(burn_in=1, samples=2)
    fitted = hpylm.fit(merged, settings)
    table = merged.toArrow().to_pylist()
    for leaf in (0, 5, 17, 63):
        for sample in range(len(fitted.totals)):
            known = 0.0
            for row in table:
                *_, seats = hpylm._seated(row, settings, fitted.totals[:sample], fitted.base)
                root, parents = seats.chances(fitted.totals[sample], fitted.base)
                d, s = settings.discounts[0], settings.strengths[0]
                totals = fitted.totals[sample]
                chance = (s + d * totals.tables[0][leaf]) * parents[:, leaf // hpylm.FAR]
                here = seats.leaf == leaf
                chance[seats.word[here]] += seats.customers[0][here] - d * seats.tables[0][here]
                chance = chance / (s + totals.customers[0][leaf])
                known += chance[seats.known].sum()
                unknown = chance[~seats.known]
            assert len(unknown) == 0 or np.ptp(unknown) < 1e-12
            (d2, d1, d0), (s2, s1, s0) = settings.discounts, settings.strengths
            rest = (s0 + d0 * totals.tables[2][0]) * fitted.base / (s0 + totals.customers[2][0])
            rest *= (s1 + d1 * totals.tables[1][leaf // hpylm.FAR]) / (s1 + totals.customers[1][leaf // hpylm.FAR])
            rest *= (s2 + d2 * totals.tables[0][leaf]) / (s2 + totals.customers[0][leaf])
            assert known + rest == pytest.approx(1, abs=1e-9)


def seatings(c):
    """All ways to seat c customers at tables, as lists of sizes."""
    out = [[1]]
    for _ in range(c - 1):
        out = [s[:k] + [s[k] + 1] + s[k + 1 :] for s in out for k in range(len(s))] + [[*s, 1] for s in out]
    return out


def weight(sizes, discount):
    return math.prod(math.prod(j - discount for j in range(1, n)) for n in sizes)


def test_stirling_numbers():
    logs = hpylm.stirling_logs(0.3)
    for c in range(1, 8):
        for t in range(1, c + 1):
            exact = sum(weight(s, 0.3) for s in seatings(c) if len(s) == t)
            assert math.exp(logs[c, t]) == pytest.approx(exact, rel=1e-9)


def test_tables_follow_their_exact_distribution():
    c, chance, others, d, s = 6, 0.05, 9, 0.4, 1.5
    exact = np.zeros(c + 1)
    for sizes in seatings(c):
        opened = math.prod((s + d * (others + j)) * chance for j in range(len(sizes)))
        exact[len(sizes)] += opened * weight(sizes, d)
    exact /= exact.sum()
    n = 40_000
    drawn = hpylm.draw_tables(
        np.full(n, c), np.full(n, chance), np.full(n, others), d, s, np.random.default_rng(1), hpylm.stirling_logs(d)
    )
    assert np.abs(np.bincount(drawn, minlength=c + 1) / n - exact).max() < 0.01


@pytest.mark.parametrize("chance, others, d", [(0.001, 200, 0.5), (0.02, 50_000, 0.8), (0.3, 500, 0.9), (1e-5, 10, 0.8)])
def test_many_customers_come_close_to_all_cases(chance, others, d):
    c, s, n = 400, 1.0, 4000
    logs = hpylm.stirling_logs(d, c)
    cases = logs[c, 1:] + np.cumsum(np.log(chance) + np.log(s + d * (others + np.arange(c))))
    cases = np.exp(cases - cases.max())
    cases /= cases.sum()
    mean = (cases * np.arange(1, c + 1)).sum()
    spread = math.sqrt((cases * (np.arange(1, c + 1) - mean) ** 2).sum())
    drawn = hpylm.draw_tables(np.full(n, c), np.full(n, chance), np.full(n, others), d, s, np.random.default_rng(2), hpylm.stirling_logs(d, 100))
    assert drawn.min() >= 1 and drawn.max() <= c
    assert drawn.mean() == pytest.approx(mean, rel=0.05, abs=0.1)
    assert drawn.std() == pytest.approx(spread, rel=0.15, abs=0.2)


def test_block(spark):
    texts = [[b"a", b"b", b"a"], [], [b"b", b"b"]]
    numbers = hpylm.Numbers({hpylm.END: 0})
    block = hpylm.block_of(numbers, [hpylm.numbered(t, numbers) for t in texts], [True, True, False], 4)
    assert block.ends.tolist() == [4, 5, 8] and len(block.pairs) == 8
    word = np.repeat(np.arange(len(block.words)), block.widths)
    spelled = [block.words[word[p]] for p in block.pairs]
    assert spelled == [b"a", b"b", b"a", hpylm.END, hpylm.END, b"b", b"b", hpylm.END]
    leaf = block.leaves[block.pairs]
    near = lambda w: 1 + zlib.crc32(w[-3:]) % (hpylm.NEAR - 1)
    far = lambda w: zlib.crc32(w[-2:]) % hpylm.FAR
    assert leaf.tolist() == [0, near(b"a") * hpylm.FAR, near(b"b") * hpylm.FAR + far(b"a"), near(b"a") * hpylm.FAR + far(b"b"), 0, 0, near(b"b") * hpylm.FAR, near(b"b") * hpylm.FAR + far(b"b")]
    assert block.counts.sum() == 5 and (np.diff(block.buckets) >= 0).all()
    assert all(hpylm.zlib.crc32(w) % 4 == b for w, b in itertools.zip_longest(block.words, block.buckets))


def test_nothing_to_learn_from(documents):
    assert hpylm.score(documents([])).count() == 0
    (row,) = hpylm.score(documents([(None, "only held out")])).collect()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["n_tokens"] == 4
    assert row["base_score"] == 0 and math.isfinite(row["score"])
