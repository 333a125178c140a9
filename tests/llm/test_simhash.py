"""Fingerprints, Golay keys, links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from millrace.llm import components, simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in words).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    rng = random.Random(1)
    words = ["The", "É", "\x1c", "x y", "a", "B", " ", "long" * 9]
    for text in [None, "", " \n", "One", "one two", "one two THREE"] + [
        rng.choice([" ", "\t\n"]).join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)
    ]:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_fingerprint_of_many_words():
    words = [str(i % 977) for i in range(140_000)]
    whole = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)], np.uint64)
    ones = [int((whole >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
    assert simhash.fingerprint(" ".join(words)) == sum(1 << b for b in range(64) if 2 * ones[b] > len(whole))


def test_codewords():
    """12 bits of data, distance 7, every word within 3 of exactly one codeword."""
    codewords = np.flatnonzero(simhash.syndromes(np.arange(1 << 23)) == 0)
    assert len(codewords) == 4096 and len(np.unique(codewords >> 11)) == 4096
    assert np.bitwise_count(codewords[1:].astype(np.uint64)).min() == 7


def test_near_words_share_a_key():
    rng = np.random.default_rng(2)
    table = simhash.error_table()
    words = rng.integers(0, 1 << 23, 4000)
    for flips in (0, 1, 2):
        other = words.copy()
        for n, w in enumerate(other):
            for bit in rng.permutation(23)[:flips]:
                other[n] ^= 1 << bit
        a, b = simhash.codeword_keys(words, table), simhash.codeword_keys(other, table)
        assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(a, b))
    assert set((simhash.codeword_keys(words, table) >= 0).sum(1)) == {1, 6}


def test_every_near_pair_shares_a_refined_key():
    rng = np.random.default_rng(7)
    table = simhash.error_table()
    for _ in range(300):
        a = np.array([rng.integers(0, 2**63)], np.uint64)
        b = a.copy()
        for bit in rng.permutation(64)[: rng.integers(0, 3)]:
            b ^= np.uint64(1) << np.uint64(bit)
        found = []
        for p in (a, b):
            keys, rows = simhash.pair_keys(p, table)
            fine, _ = simhash.refined_keys(p[rows], table, keys)
            found.append((set(keys.tolist()), set(fine.tolist())))
        assert found[0][0] & found[1][0] and found[0][1] & found[1][1]


def brute_components(values):
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    for i, j in zip(*np.nonzero(near)):
        a, b = root(i), root(j)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("group_rows", [4096, 1])
def test_links_connect_exactly_near_fingerprints(spark, group_rows):
    rng = np.random.default_rng(0)
    chain = [rng.integers(0, 2**63, 80, dtype=np.int64).view(np.uint64)]
    for _ in range(3):
        flips = np.zeros(80, np.uint64)
        for _ in range(2):
            flips ^= np.uint64(1) << rng.integers(0, 64, 80).astype(np.uint64)
        chain.append(chain[-1] ^ flips)
    dense = chain[0][:1] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))  # all within two bits of each other
    values = np.unique(np.concatenate([*chain, dense]))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    roots = dict(map(tuple, components.connected(simhash.near_links(df, group_rows)).collect()))
    groups, want = {}, {}
    for v, r in zip(values.view(np.int64).tolist(), brute_components(values)):
        groups.setdefault(roots.get(v, v), set()).add(v)
        want.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates(documents):
    rng = random.Random(9)
    base = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200)) for _ in range(30)]
    pairs = [(10 + i, t) for i, t in enumerate(base)] + [(100 + i, t.upper()) for i, t in enumerate(base[:20])]
    pairs += [(200 + i, t + " z") for i, t in enumerate(base)]
    pairs += [(3, None), (2, ""), (None, " "), (None, base[0]), (10, base[0]), (10, base[0])]
    rows = simhash.near_duplicates(documents(pairs)).collect()
    prints = np.array([plain_fingerprint(t) for _, t in pairs], np.uint64)
    distinct, place = np.unique(prints, return_inverse=True)
    group = np.array(brute_components(distinct))[place]
    want = sorted(
        (str(i), int(p.view(np.int64)), min(j for (j, _), h in zip(pairs, group) if h == g and j is not None))
        for (i, _), p, g in zip(pairs, prints, group)
    )
    assert sorted((str(r[0]), r[1], r[2]) for r in rows) == want
    assert simhash.near_duplicates(documents([])).count() == 0


def test_one_of_each(documents):
    text, other = " ".join(map(str, range(300))), " ".join(map(str, range(500, 900)))
    docs = documents([(5, text), (4, text), (None, text), (7, other), (7, other), (None, "alone here"), (9, None)])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted(
        [("4", text), ("7", other), ("None", "alone here"), ("9", None)], key=lambda x: (x[0], x[1] or "")
    )


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (100, 101), (101, 100)]
    df = spark.createDataFrame(links, "b long, a long")
    got = dict(map(tuple, components.connected(df).collect()))
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
    assert components.connected(df.limit(0)).count() == 0
