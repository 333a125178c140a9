"""Folding and matching by hand; held-out accuracy on planted words."""

import math
import os
import random
import re
import zlib

import pytest

from millrace.llm import queries, toxicity
from millrace.llm.common import whole_texts

TABLE = toxicity.folding()


def test_folding():
    assert toxicity.folded("", TABLE) == "  "
    assert toxicity.folded("St0p, IDI​OT!", TABLE) == " stop idiot "
    assert toxicity.folded("іdіоt ｉｄｉｏｔ ídïôt 1D10T", TABLE) == " idiot idiot idiot idiot "
    assert toxicity.folded("a\n\tb__c", TABLE) == " a b c "


def test_matching_and_exceptions():
    weights = {" bad ": 2.0, " stup": 1.0, " stupid ": 3.0}
    match = toxicity.matcher(weights, [" not bad "])
    text = toxicity.folded("Not bad, but BAD stupidity and stupid; bader", TABLE)
    assert sorted(w for _, w in match(text)) == [1.0, 2.0, 3.0]
    assert toxicity.matcher({}, [])(text) == []
    assert match("  ") == []


def test_strength_falls_with_length():
    short, long = " bad ", " bad " + "word " * 500
    match = toxicity.matcher({" bad ": 2.0}, [])
    assert toxicity.strength(short, match(short)) > toxicity.strength(long, match(long)) > 0


def planted(n=1500):
    rng = random.Random(8)
    plain = ["".join(rng.choice("abdefglmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    pairs, marks = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 200))
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(["zonker", "z0nker", "Zоnker!", "quvv" + rng.choice(plain), "trashy"]))
        elif rng.random() < 0.05:
            words.insert(3, "trashy cans")
        pairs.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    return pairs, marks


def test_held_out_accuracy(spark, documents):
    pairs, marks = planted()
    odd = [(None, 1, 1), (3, None, None), (9_999_999, 1, 1), (None, None, None)]
    labels = spark.createDataFrame([*marks, *odd], "doc_id long, quality int, toxic int")
    extra = [(None, "zonker zonker"), (5000, None), (5001, ""), (5002, "x " * 50_000), (7, pairs[7][1])]
    docs = documents([*pairs, *extra])
    model = toxicity.learn(whole_texts(docs), labels)
    assert any("trashy cans" in p for p in model.exceptions)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(pairs) + len(extra)
    assert all(0 <= r["score"] <= 1 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[None] > 0.5 and max(score[5000], score[5001], score[5002]) < 0.5
    held = [(score[i] >= 0.5, t) for i, _, t in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 200 and sum(a == bool(t) for a, t in held) / len(held) > 0.98


def plain_score(text, model):
    """Every entry at every place of the folded text, without an automaton."""
    rest, table = re.compile(r"[\W_]+"), toxicity.folding()
    text = f" {rest.sub(' ', (text or '').lower().translate(table)).strip()} "
    covered = [(m.start(), m.start() + len(p) - 1) for p in model.exceptions for m in re.finditer(f"(?={re.escape(p)})", text)]
    words = [i for i in range(len(text)) if text[i] == " "]
    weight = {}
    for n, at in enumerate(words):
        entries = [w for e, w in model.weights.items() if text.startswith(e, at)]
        if entries and not any(a <= at < b for a, b in covered):
            weight[n] = max(entries)
    best = max((sum(w for m, w in weight.items() if n - 200 < m <= n) for n in weight), default=0.0)
    strength = best / math.log2(8 + min(len(words) - 1, 200))
    return 1 / (1 + math.exp(-(model.slope * strength + model.offset)))


def test_scores_equal_a_plain_scorer(documents):
    model = toxicity.Model({" zonker ": 3.0, " zonk": 1.5, " trash": 1.0, " bad ": 0.5}, (" trashy cans ", " not bad "), 7.5, -5.5)
    rng = random.Random(8)
    words = ["zonker", "Z0NKER", "zonked", "trashy cans", "trashy", "not bad", "bad", "ok", "fine", "über", "a-b"]
    pairs = [(i, " ".join(rng.choices(words, [1, 1, 1, 2, 1, 2, 2, 30, 30, 30, 9], k=rng.randint(0, 700)))) for i in range(60)]
    pairs += [(100, None), (101, ""), (102, "?!"), (103, "zonker"), (104, "zonker " * 500)]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(pairs), model).collect()}
    for i, text in pairs:
        assert got[i] == pytest.approx(plain_score(text, model), abs=1e-12)


def test_long_clean_text_with_weak_words_stays_clean(documents):
    """One weak word in a hundred: the same score at a thousand words and at a hundred thousand; a strong passage still shows."""
    model = toxicity.Model({" meh ": 1.0, " zonker ": 4.0}, (), 7.5, -5.5)
    dull = lambda n: " ".join("meh" if i % 100 == 50 else f"w{i % 37}" for i in range(n))
    pairs = [(0, dull(1000)), (1, dull(100_000)), (2, f"{dull(50_000)} {'zonker you ' * 8} {dull(50_000)}")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(pairs), model).collect()}
    assert got[0] == got[1] < 0.1 and got[2] > 0.9


def test_without_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "zonker"), (2, None)])
    model = toxicity.learn(whole_texts(docs), labels)
    assert all(r["score"] < 0.5 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_sample_is_bounded_and_leaves_out_the_held_out(spark, documents):
    pairs, marks = planted(200)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    ids = [r["doc_id"] for r in toxicity.labelled(whole_texts(documents(pairs)), labels, 50).collect()]
    assert len(ids) == 50 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables not present")
def test_held_out_accuracy_on_the_tables(spark):
    got = queries.op5_toxicity_lexicon(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r[0] == 1 and r[1] == 1 for r in rows)
    assert hit / sum(r[1] for r in rows) > 0.9
    assert hit / sum(r[0] for r in rows) > 0.9


def test_texts_that_share_a_passage_all_count(spark, documents):
    """One passage in every text: each still counts with its own words and its own label."""
    rng = random.Random(2)
    passage = " ".join(f"licence{i}" for i in range(200))
    pairs, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        own = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}" for _ in range(8)] + (["zonker"] if toxic else ["gentle"])
        pairs.append((i, f"{passage} {' '.join(own)}"))
        marks.append((i, 1, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    weights = toxicity.learn_weights(toxicity.labelled(whole_texts(documents(pairs)), labels))
    assert any(" zonker ".startswith(entry) for entry in weights)
    assert not any(" gentle ".startswith(entry) for entry in weights)


def test_copies_count_once_for_each_label(spark, documents):
    """Ten copies of one toxic text are no evidence that its words are toxic."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    pairs = [(i, "Same old zonker line" if n < 10 else f"plain text number {i}") for n, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, 1, int(n < 10)) for n, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    assert toxicity.learn_weights(toxicity.labelled(whole_texts(documents(pairs)), labels)) == {}
