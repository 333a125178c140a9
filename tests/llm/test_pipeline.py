"""The pipeline: every stage by its operator's plain version, stage on stage."""

import random
import re
from collections import Counter

import corpus_pipeline
from millrace.llm import quality, secrets
from test_secrets import expected
from test_shingles import edited, survivors
from test_substrings import brute, words_of


def corpus():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprst") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = text(60)
    pairs = [(i, text(rng.randint(60, 300))) for i in range(60)]
    pairs += [(100 + i, f"{text(70)}\n{passage}\n{text(30)}") for i in range(5)]
    pairs += [(200 + i, pairs[i][1]) for i in range(10)]
    pairs += [(220 + i, " ".join(edited(rng, pairs[i][1].split(), 1))) for i in range(15)]  # near copies, not exact ones
    pairs += [(300 + i, f"{text(60)} password = {'k' * 12}{i} {text(20)}") for i in range(4)]
    pairs += [(400, "short"), (401, None), (402, "again and again " * 40), (403, " | ".join(f"W{i}!!" for i in range(90)))]
    return pairs


def test_stages(spark, documents, tmp_path):
    pairs = corpus()
    docs = documents(pairs).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "substring_dedup", "secret_scan", "packing"]
    docs, out = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {name: {r["doc_id"]: r["text"] for r in out[name].collect()} for name in names[:-1]}

    judged = quality.judged(documents(pairs)).filter("kept").collect()
    kept = {r["doc_id"] for r in judged}
    assert set(texts["quality_rules"]) == kept and not kept & {400, 401, 402, 403} and set(range(60)) <= kept

    inside = [(i, t) for i, t in pairs if i in kept]
    assert sorted(texts["near_dedup"]) == survivors(inside)
    assert not set(texts["near_dedup"]) & {*range(200, 210), *range(220, 235)} and set(range(15)) <= set(texts["near_dedup"])

    left = sorted(texts["near_dedup"])
    for i, words in zip(left, brute([texts["near_dedup"][i] for i in left], 35)):
        assert words_of(texts["substring_dedup"][i]) == words
    assert all(len(words_of(texts["substring_dedup"][100 + i])) == 100 for i in range(5))

    for i, text in texts["secret_scan"].items():
        assert not expected(text, secrets.ALL_RULES)
        assert re.sub(r"\[secret\]", "", text) in (text, texts["substring_dedup"][i].replace(f"password = {'k' * 12}{i - 300}", ""))
    assert sum("[secret]" in t for t in texts["secret_scan"].values()) == 4
    assert all(r["n_chars"] == len(r["text"]) for r in out["secret_scan"].filter("doc_id >= 300").collect())

    pieces = out["packing"].collect()
    assert {r["doc_id"] for r in pieces} == set(texts["secret_scan"])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    same = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[c] for c in same) for r in whole) == Counter(tuple(r[c] for c in same) for r in pieces)


def test_empty_table(spark, documents, tmp_path):
    documents([]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
