"""Near-duplicates by shingle similarity against brute force."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from millrace.llm import shingles


def plain_shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(pairs, least=0.8):
    sets = [plain_shingles(t) for _, t in pairs]
    label = list(range(len(pairs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= least * len(a | sets[j]):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(pairs))]


def edited(rng, words, places):
    out = list(words)
    for at in rng.sample(range(len(out)), places):
        out[at] = f"edit{rng.randrange(10**6)}"
    return out


def copies(seed=3, groups=25):
    """Groups of copies with up to one edit in 50 words, and pairs that share about half."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    pairs = []
    for g in range(groups):
        words = fresh(rng.randint(60, 400))
        pairs.append((1000 * g, " ".join(words)))
        for i in range(1, rng.randint(2, 14)):
            pairs.append((1000 * g + i, " ".join(edited(rng, words, rng.randint(1, max(1, len(words) // 50))))))
        pairs.append((1000 * g + 500, " ".join(words[: len(words) // 2] + fresh(len(words) // 2))))
    return pairs


def survivors(pairs):
    first = {}
    for (i, _), g in zip(pairs, brute_groups(pairs)):
        first[g] = min(i, first.get(g, i))
    return sorted(first.values())


def test_stage_keeps_one_of_each_group_of_similar_texts(spark, documents):
    pairs = copies()
    want = survivors(pairs)
    assert len(want) < len(pairs) / 2
    kept = corpus_pipeline.near_dedup(spark, documents(pairs), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == want


@pytest.mark.parametrize("part_rows", [4, 16])
def test_large_groups_in_parts(documents, part_rows):
    rng = random.Random(5)
    words = [f"w{rng.randrange(4000)}" for _ in range(300)]
    pairs = [(i, " ".join(edited(rng, words, 2))) for i in range(200)] + [(500 + i, t) for i, t in copies(9, 6)]
    kept = shingles.one_of_each(documents(pairs), part_rows=part_rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == survivors(pairs)


def star(leaves, seed=7):
    """One text and variants of it with four changed words each: similar to it, hardly ever to each other."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(4000)}" for _ in range(200)]
    spots = lambda: [rng.randrange(2, 198) // 8 * 8 for _ in range(9)]
    pairs = [(0, " ".join(words))]
    while len(pairs) <= leaves:
        out = list(words)
        for at in list(dict.fromkeys(spots()))[:4]:
            out[at] = f"edit{rng.randrange(10**9)}"
        pairs.append((len(pairs), " ".join(out)))
    return pairs


def test_variants_of_one_text_are_all_joined_to_it(documents):
    pairs = star(2000)
    centre, sets = plain_shingles(pairs[0][1]), [plain_shingles(t) for _, t in pairs[:60]]
    assert all(len(centre & s) >= 0.8 * len(centre | s) for s in sets)
    assert sum(len(a & b) >= 0.8 * len(a | b) for a in sets[1:] for b in sets[1:]) < 200  # themselves, and a few
    found = shingles.near_duplicates(documents(pairs)).collect()
    joined = sum(r["component_id"] == 0 for r in found)
    assert joined >= 0.999 * len(pairs)


def test_unlike_texts_of_one_key_are_all_compared(documents):
    """Half of every text is the same: many share keys, few are copies."""
    rng = random.Random(6)
    common = [f"w{i}" for i in range(100)]
    pairs = []
    for i in range(150):
        own = [f"o{rng.randrange(10**6)}" for _ in range(60)]
        pairs.append((i, " ".join(common + own)))
        if i % 10 == 0:
            pairs.append((1000 + i, " ".join(edited(rng, common + own, 1))))
    kept = shingles.one_of_each(documents(pairs), part_rows=4)
    assert sorted(r["doc_id"] for r in kept.collect()) == survivors(pairs)


def test_ids_and_empty_texts(documents):
    text, other = " ".join(map(str, range(300))), " ".join(map(str, range(500, 900)))
    docs = documents([(5, text), (4, text + " more"), (None, text), (7, other), (7, other), (None, "alone here"), (9, None), (8, "")])
    kept = shingles.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted(
        [("4", text + " more"), ("7", other), ("None", "alone here"), ("8", "")]
    )
    assert shingles.one_of_each(documents([])).count() == 0


def test_extra_columns_stay(documents):
    text = " ".join(map(str, range(300)))
    docs = documents([(1, text), (2, text + " more"), (None, text), (None, "alone"), (5, "own words"), (5, "own words")])
    for k, name in enumerate(("_doc_id", "_fp", "fp_of", "doc_id_of", "a.b")):
        docs = docs.withColumn(name, F.lit(k))
    kept = shingles.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), *tuple(r)[-5:]) for r in kept.collect()) == [(i, 0, 1, 2, 3, 4) for i in ("1", "5", "None")]


def test_estimate_follows_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 4000, np.uint64)
    for shared in (0.2, 0.5, 0.9):
        n = int(shared * 4000)
        other = np.concatenate([base[:n], rng.integers(0, 1 << 63, 4000 - n, np.uint64)])
        equal = (shingles.min_hashes(base) == shingles.min_hashes(other)).mean()
        assert abs(equal - n / (8000 - n)) < 0.16


def test_golay_keys_name_candidates_of_the_stage(spark, documents, monkeypatch):
    rng = random.Random(11)
    texts = [[f"w{rng.randrange(4000)}" for _ in range(3000)] for _ in range(6)]
    pairs = [(i, " ".join(words)) for i, words in enumerate(texts)]
    pairs += [(10 + i, " ".join([*words, "end"])) for i, words in enumerate(texts)]
    pairs += [(20, " ".join(texts[0][:300])), (30, None), (31, "")]
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(shingles, "candidates", lambda *args: none)
    kept = corpus_pipeline.near_dedup(spark, documents(pairs), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(6), 20, 30]


def test_texts_of_one_fingerprint_and_of_near_ones_are_candidates(spark):
    prints = spark.createDataFrame([(1, 0), (2, 0), (3, 3), (4, -1), (5, 3)], "fp long, print long")
    found = {tuple(r) for r in shingles.golay_candidates(prints).collect()}
    assert {(1, 2), (3, 5), (1, 3)} <= found and all(4 not in p for p in found)


def form_letters(seed, letters=240, words=300):
    """Letters of one form: most pairs a little less similar than 0.8, a few a little more."""
    rng = random.Random(seed)
    form = [f"w{rng.randrange(4000)}" for _ in range(words)]
    return [(i, " ".join(edited(rng, form, rng.randint(4, 5)))) for i in range(letters)]


@pytest.mark.parametrize("rest_rows", [16, 512])
def test_links_that_estimates_hide_are_found_in_large_groups(documents, monkeypatch, rest_rows):
    """Every pair of a group is compared: nearer estimates of unlike texts hide none."""
    monkeypatch.setattr(shingles, "REST_ROWS", rest_rows)
    pairs = form_letters(1)
    groups, want = brute_groups(pairs), survivors(pairs)
    assert 20 < len(set(groups)) < 200
    kept = shingles.one_of_each(documents(pairs))
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_every_pair_of_a_group_in_several_components_is_compared(spark, documents):
    pairs = form_letters(2, 60) + [(1000 + i, t) for i, t in copies(4, 3)]
    docs = documents(pairs)
    signed = shingles.signatures(docs, 5, "doc_id", "text").drop("doc_id").dropDuplicates(["fp"])
    ids = {shingles.content(shingles.shingle_hashes(t)): i for i, t in pairs}
    sets = lambda named: shingles._sets(docs.select("doc_id", "text"), 5).join(named, "fp", "left_semi")
    none = spark.createDataFrame([], "a long, b long")
    plain = {i: plain_shingles(t) for i, t in pairs}
    found = [(ids[a], ids[b]) for a, b in shingles.rest_links(signed, none, sets).collect()]
    assert all(len(plain[a] & plain[b]) >= 0.8 * len(plain[a] | plain[b]) for a, b in found)
    small = [(i, t) for i, t in pairs if i < 1000]
    nodes = {i: i for i, _ in small}
    for a, b in sorted(found) * len(small):
        if a in nodes and b in nodes:
            nodes[a] = nodes[b] = min(nodes[a], nodes[b])
    parts = lambda labels: sorted(sorted(i for i in labels if labels[i] == r) for r in set(labels.values()))
    assert parts(nodes) == parts(dict(zip(nodes, brute_groups(small))))
    joined = spark.createDataFrame([(min(ids), f) for f in ids], "a long, b long")
    assert shingles.rest_links(signed, joined, sets).count() == 0
