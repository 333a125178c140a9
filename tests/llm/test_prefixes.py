"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from millrace.llm import prefixes, queries

SCHEMA = "conv_id long, turn long, role string, text string, path string, shard int, n string, turns int"


def table(spark, rows):
    """Turns beside extra columns with the operator's own names."""
    return spark.createDataFrame([(*r, "p", 3, "n", 4) for r in rows], SCHEMA)


def plain_rebuilt(rows):
    own = {}
    for c, n, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((n is not None, n or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: [*own.get(c - int(math.fmod(c, 100)), [])[: h[c]], *v[h[c] :]] for c, v in own.items()}


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = sorted(c for c in own if len(convs[c]) == len(node))
        out.add(
            (
                min(own),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own),
                sum(len(x) == len(node) + 1 for x in below),
                leaves,
                saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return out


def sample(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for i in range(convs):
        c = rng.choice([i, 100 + i % 7, 300 + i, 1000 * i + 200])
        if any(r[0] == c for r in rows):
            continue
        for n in range(rng.randint(1, 7)):
            rows.append((c, n, "user" if n % 2 else "assistant", "ab𝔘é" * rng.randint(0, 1) + rng.choice("xy")))
    return rows


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set((r[0], r[1]) for r in rows))  # the least member and the depth name a node
    return set(rows)


@pytest.mark.parametrize("shard_turns", [1 << 19, 60, 7])
def test_equals_plain_trie(spark, shard_turns):
    rows = sample(shard_turns)
    convs = prefixes.rebuilt(prefixes.turns_of(table(spark, rows)))
    df = prefixes.trie(convs, shard_turns)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found(df) == plain_trie(plain_rebuilt(rows))


def test_nulls_ties_copies_and_no_turns(spark):
    rows = [(7, 0, "u", "a"), (7, 1, None, None), (8, None, "u", "z"), (8, None, "u", "b"), (8, 0, "u", "c"), (8, 0, "a", "c"), (None, 0, "u", "lost")]
    rows += [(c, n, "u", t) for c in range(900, 960) for n, t in enumerate(["same", "turns", "here"])]  # a third of all and more
    rows += [(c, 0, "u", "only") for c in range(2001, 2012)]  # turnless when rebuilt, but for some
    rows += [(-5, 0, "u", "less"), (-100, 0, "u", "below"), (0, 0, "u", "zero"), (0, 1, "u", "one")]
    rows += [(5000 + c, n, "u", f"t{n}") for c in (1, 2) for n in range(300)]  # long ones
    want = plain_trie(plain_rebuilt(rows))
    assert any(c[1] == 0 and c[7] != prefixes.NOTHING for c in want)
    for shard_turns in (1 << 19, 20):
        convs = prefixes.rebuilt(prefixes.turns_of(table(spark, rows)))
        assert found(prefixes.trie(convs, shard_turns)) == want


def test_only_turnless_and_empty(spark):
    rows = [(c, 0, "u", "x") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6]
    got = found(prefixes.trie(prefixes.rebuilt(prefixes.turns_of(table(spark, rows)))))
    ids = ",".join(str(r[0]) for r in rows)
    assert got == {(rows[0][0], 0, None, len(rows), 0, 1, 0, hashlib.sha256(ids.encode()).hexdigest())}
    assert prefixes.trie(prefixes.rebuilt(prefixes.turns_of(table(spark, [])))).count() == 0


def test_intervals_by_range_minimum():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5, 83)
    values[0] = -2
    place, depth = np.repeat(np.arange(83), 6), np.tile(np.arange(6), 83)
    first, last = prefixes.RangeMinimum(values).interval(place, depth)
    for p, d, a, b in zip(place, depth, first, last):
        x = y = p
        while x > 0 and values[x] >= d:
            x -= 1
        while y < 82 and values[y + 1] >= d:
            y += 1
        assert (a, b) == (x, y)


def test_query_and_oracle(spark, tmp_path):
    rows = sample(5)
    table(spark, rows).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = found(queries.op13_conversation_trie(spark, str(tmp_path)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert got == set(con.sql(queries.OP13_SQL).fetchall()) == plain_trie(plain_rebuilt(rows))
