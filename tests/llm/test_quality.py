"""Base counts and distances against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm.quality import Limits

CLASS_TESTS = (str.islower, str.isupper, str.isdigit, lambda c: c in " \t\n\x0b\x0c\r", lambda c: c in ".,;:!?'\"()-", str.isalpha)


def base(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    seen = Counter(zip(words, words[1:], words[2:]))
    under = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(under)


def distance(a, b):
    n, m = sum(a), sum(b)
    out = 0.0
    for x, y in zip(a, b):
        p, q = x / n, y / m
        out += sum(v * math.log2(2 * v / (p + q)) for v in (p, q) if v > 0) / 2
    return math.sqrt(max(0.0, out))


def corpus():
    rng = random.Random(11)
    words = ["the", "of", "and", "to"] * 5 + ["".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    pairs = [(i, (rng.choice([" ", "\n", "  ", "\t"])).join(rng.choices(words, k=rng.randint(0, 200)))) for i in range(120)]
    pairs += [(200 + i, " | ".join(w.upper() + "!!" for w in rng.choices(words, k=90))) for i in range(4)]
    pairs += [(300, "same words " * 90), (301, "a b c a b c"), (302, "x\ny\nx\n \n \n\x0b\n"), (303, None), (304, ""), (305, " \x0b\x1c  ")]
    pairs += [(306, "É\x1cx #$ " * 30), (None, "no id " * 60), (5, pairs[5][1]), (5, pairs[5][1]), (307, "a" * 5000), (308, "1 2 " * 20_000)]
    return pairs


def test_base_counts(documents):
    pairs = corpus()
    rows = quality.judged(documents(pairs), Limits(least_documents=1)).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in rows) == Counter((i, *base(t)) for i, t in pairs)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_distances(documents):
    pairs = corpus()
    limits = Limits(common_words=6, least_documents=1)
    rows = quality.judged(documents(pairs), limits).collect()
    words = {i: [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w] for i, t in pairs}
    counts = Counter(w for _, t in pairs for w in set(re.split("[\x20\x09-\x0d]+", t or "")) if w)
    common = sorted(counts, key=lambda w: (-counts[w], w))[:6]

    def bins(text):
        own = [sum(f(c) for c in text) for f in CLASS_TESTS]
        letters = own[5] - own[0] - own[1]
        return [*own[:5], letters, len(text) - sum(own[:5]) - letters]

    def word_bins(own):
        found = [own.count(w) for w in common]
        return [*found, len(own) - sum(found)]

    def mean(histograms):
        return [sum(x) for x in zip(*([n / sum(h) for n in h] for h in histograms if sum(h)))]

    total = mean(bins(t or "") for _, t in pairs)
    word_total = mean(word_bins([w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]) for _, t in pairs)
    texts = dict(pairs)
    for r in rows:
        text, own = texts[r["doc_id"]] or "", words[r["doc_id"]]
        assert r["class_distance"] == (pytest.approx(distance(bins(text), total), abs=1e-9) if text else None)
        assert r["word_distance"] == (pytest.approx(distance(word_bins(own), word_total), abs=1e-9) if own else None)
    kept = {r["doc_id"] for r in quality.judged(documents(pairs), Limits(least_documents=1)).filter("kept").collect()}
    assert not kept & {200, 201, 202, 203, 300, 303} and len(kept) > 60


def test_guards(spark, documents):
    """No reference: a null language, a rare one, an empty table."""
    shouting = " | ".join(f"W{i}!!" for i in range(90))
    assert [r["kept"] for r in quality.judged(documents([(1, shouting)], lang=None)).collect()] == [True]
    assert [r["class_distance"] for r in quality.judged(documents([(1, shouting)])).collect()] == [None]
    assert quality.judged(documents([])).count() == 0
    docs = documents([(i, f"w{i} " + shouting.lower().replace("!!", "").replace("|", "")) for i in range(40)] + [(99, shouting)])
    short = Limits(least_words=1000)
    assert 99 not in {r["doc_id"] for r in quality.judged(docs).filter("kept").collect()}
    assert 99 in {r["doc_id"] for r in quality.judged(docs, short).filter("kept").collect()}


def test_keep(documents):
    docs = documents(corpus())
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    want = Counter(str(r["doc_id"]) for r in quality.judged(docs).filter("kept").collect())
    assert Counter(str(r["doc_id"]) for r in kept.collect()) == want


def test_extra_columns_stay(documents):
    docs = documents(corpus()).withColumn("row", F.lit(7)).withColumn("Row_", F.lit(8)).withColumn("a.b", F.lit(9)).withColumn("_row", F.lit(10))
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert {tuple(r)[-4:] for r in kept.collect()} == {(7, 8, 9, 10)}


def test_plan_is_native(documents):
    plan = quality.judged(documents(corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_every_language_with_enough_documents_has_a_reference(spark):
    rng = random.Random(13)
    rows = []
    for n in range(300):
        words = [f"w{n}x{i}" for i in range(12)]
        rows += [(10 * n + i, " ".join(rng.choices(words, k=60)), f"l{n:03}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = quality.judged(docs, Limits(common_words=4, least_documents=2)).collect()
    assert len(found) == 600
    assert all(r["class_distance"] is not None and r["word_distance"] is not None for r in found)
