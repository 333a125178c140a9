"""Removed words against a table of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, substrings


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def brute(texts, window):
    """Kept words of each text."""
    lists = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for j, x in enumerate(w) if j not in gone])
    return out


def corpus(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, vocabulary))
    passages = [[word() for _ in range(rng.choice([34, 35, 36, 50, 90]))] for _ in range(6)]
    line = [word() for _ in range(12)]  # shorter than a window, in most texts
    pairs = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        if rng.random() < 0.7:
            words[len(words) // 2 : len(words) // 2] = line
        pairs.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    pairs += [(200, "same " * 100), (201, "same " * 34), (202, "a b " * 40), (203, pairs[3][1]), (203, pairs[3][1])]
    pairs += [(None, pairs[5][1]), (204, None), (205, ""), (206, "É\x1c x " * 50), (207, " " * 50)]
    return pairs


@pytest.mark.parametrize("window, anchor, tuning", [(35, 8, {}), (35, 8, {"hot": 3, "shard_words": 200}), (10, 4, {"shard_words": 50})])
def test_equals_table_of_windows(documents, window, anchor, tuning):
    pairs = corpus(window)
    rows = substrings.dedup(documents(pairs), window, anchor=anchor, **tuning).collect()
    want = Counter()
    for (i, t), kept in zip(pairs, brute([t for _, t in pairs], window)):
        want[(i, len(words_of(t)), len(words_of(t)) - len(kept), " ".join(kept))] += 1
    assert Counter(map(tuple, rows)) == want
    assert sum(r["n_removed"] > 0 for r in rows) > 10


def test_empty_and_lone_documents(documents):
    assert substrings.dedup(documents([])).count() == 0
    assert [tuple(r) for r in substrings.dedup(documents([(1, "a b")])).collect()] == [(1, 2, 0, "a b")]
    text = " ".join(map(str, range(60)))
    assert [tuple(r) for r in substrings.dedup(documents([(1, text)])).collect()] == [(1, 60, 0, text)]


def test_equal_windows_name_equal_anchors():
    rng = random.Random(3)
    shared = [str(rng.randint(0, 50)) for _ in range(80)]
    texts = [" ".join([str(rng.randint(0, 50)) for _ in range(rng.randint(0, 90))] + shared) for _ in range(20)]
    texts += ["", "x", "y " * 34, "z " * 70]
    named = {}
    for t, (runs, hashes) in zip(texts, substrings.anchors([t.encode() for t in texts])):
        words, covered = t.split(), 0
        for run, h in zip(runs.tolist(), hashes.tolist()):
            for s in range(run >> 8, (run >> 8) + (run & 255) + 1):
                named.setdefault(tuple(words[s : s + 35]), set()).add(h)
                covered += 1
        assert covered == max(0, len(words) - 34)
    assert all(len(h) == 1 for h in named.values())


def test_word_hashes_depend_on_the_word_alone():
    texts = [b"one two  three", b"", b" three\tone ", "één".encode()]
    hashes, bounds = substrings.word_hashes(texts)
    assert bounds.tolist() == [0, 3, 3, 5, 6]
    assert hashes[0] == hashes[4] and hashes[2] == hashes[3] and len(np.unique(hashes)) == 4


def test_without_repeats_keeps_white_space(documents):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = documents([(1, f"head\n\none  two {passage}\ttail  end\n"), (2, passage), (3, "clean  text\n"), (4, None), (5, f"x {passage}")])
    clean = substrings.without_repeats(docs)
    assert clean.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in clean.collect()} == {
        (1, "head\n\none  two tail  end\n"), (2, ""), (3, "clean  text\n"), (4, None), (5, "x ")
    }


@pytest.mark.parametrize("most", [3, 40, 10**6])
def test_more_words_than_characters(monkeypatch, most):
    monkeypatch.setattr(substrings.Symbols, "most", most)
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(60)]
    stretches = [" ".join([f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 40))] + shared[rng.randint(0, 20) :]) for _ in range(30)]
    counts = [1 + (i % 7 == 0) for i in range(30)]
    seen = Counter()
    for s, c in zip(stretches, counts):
        words = s.split(" ")
        for i in range(len(words) - 34):
            seen[tuple(words[i : i + 35])] += c
    want = [[i for i in range(len(s.split(" ")) - 34) if seen[tuple(s.split(" ")[i : i + 35])] > 1] for s in stretches]
    assert substrings.located(stretches, counts) == want and any(want)


def test_extra_columns_stay(documents):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = documents([(1, f"a {passage}"), (2, f"b {passage}"), (3, "c")])
    for k, name in enumerate(("row", "_row", "ranges", "_ranges", "a.b")):
        docs = docs.withColumn(name, F.lit(k))
    clean = substrings.without_repeats(docs)
    assert clean.columns == docs.columns
    assert {(r["doc_id"], r["text"].strip(), *tuple(r)[-5:]) for r in clean.collect()} == {(i, t, 0, 1, 2, 3, 4) for i, t in ((1, "a"), (2, "b"), (3, "c"))}


def test_query_digest(spark, documents, tmp_path):
    pairs = corpus(1)
    documents(pairs).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in queries.op8_repeated_phrases(spark, str(tmp_path)).select("doc_id", "n_removed", "kept_sha256").collect())
    assert got == Counter(
        (i, len(words_of(t)) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
        for (i, t), k in zip(pairs, brute([t for _, t in pairs], 35))
    )
