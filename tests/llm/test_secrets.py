"""Secret scans against plain searches with every rule over every text."""

import hashlib
import random
import re

import pytest

from millrace.llm import queries, secrets

HAND = [
    (1, 'Password = "abcdefgh1234" and API_KEY:zzzzzzzzzzzzzz'),
    (2, "AKIA" + "Z" * 14 + " AKIASHORT"),
    (3, "x" + "0a" * 8 + "g" + "f" * 15),
    (4, None),
    (5, ""),
    (None, "token: aaaaaaaaaaaa"),
    (6, "paſſword=aaaaaaaaaaaaaaa toKen=bbbbbbbbbbbbbb"),
    (6, "paſſword=aaaaaaaaaaaaaaa toKen=bbbbbbbbbbbbbb"),
    (7, "é" * 40 + "secret='" + "k" * 12 + "'" + "ö"),
    (8, "secret=short apikey : " + "q" * 30 + " -----BEGIN RSA PRIVATE KEY-----"),
    (9, "pass" + " " * 5),
    (10, "word=" + "a" * 20 + " api-key=" + "a" * 20),
    (11, "ghp_" + "A1" * 20 + " xoxb-1234567890ab eyJabcdefghij.eyJabcdefghij.abcdefghij"),
]


def expected(text, rules):
    """Every match that the rule's own words allow, without an index."""
    out = []
    for number, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or "", re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)):
            if m.end(rule.group) - m.start(rule.group) >= rule.least_chars:
                out.append((m.start(), number, m.end()))
    return ",".join(f"{rules[n].kind}:{a}:{b}" for a, n, b in sorted(out))


def random_texts(n):
    rng = random.Random(4)
    bits = ["password", "SECRET", "token", "api_key", "apikey", "AKIA", "=", ":", '"', " ", "é", "0f" * 9, "Q" * 15, "deadbeef", "\n"]
    return [(100 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def joined(rows):
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in rows)


def test_equals_plain_search(documents):
    pairs = HAND + random_texts(300)
    found = secrets.scan(documents(pairs)).collect()
    got = sorted((str(r["doc_id"]), joined(r["spans"])) for r in found)
    assert got == sorted((str(i), expected(t, secrets.ALL_RULES)) for i, t in pairs)
    assert sum(bool(x) for _, x in got) > 100


def test_empty_table(documents):
    assert secrets.scan(documents([])).count() == 0


def test_base_kinds_by_their_own_words():
    """Leftmost matches of the open-ended patterns, then the length test, give the same spans."""
    for _, text in HAND + random_texts(300):
        text = text or ""
        runs = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        assert runs == [(m.start(), m.end()) for m in secrets.BASE_RULES[2].compiled().finditer(text)]


@pytest.mark.parametrize("rule", secrets.ALL_RULES, ids=lambda r: r.kind)
def test_query_holds_for_every_match(rule):
    """A document that holds a match is always a candidate."""
    query = secrets.trigram_query(rule)
    texts = [t or "" for _, t in HAND + random_texts(300)]
    index = secrets.postings(texts, sorted(secrets._named(query)), block=64) if query is not True else {}
    rows = set(secrets.candidates(query, index, len(texts)).tolist())
    assert {i for i, t in enumerate(texts) if rule.compiled().search(t)} <= rows
    assert (rule.kind == "hex") == (len(rows) == len(texts))


def test_rules_without_mandatory_trigrams_read_everything():
    for pattern in (r"[0-9a-f]{16,}", r"(abc)?x", r"a|bcd", r".*", r"ab"):
        assert secrets.trigram_query(secrets.Rule("r", pattern)) is True


def test_postings_do_not_cross_texts():
    index = secrets.postings(["ab", "c", "ABC", "", "xabcabc"], [b"abc"], block=2)
    assert index[b"abc"].tolist() == [2, 4]


def test_redact_keeps_all_else(documents):
    docs = documents([*HAND, (50, "clean text\nstays"), (51, "token=" + "a" * 12 + "deadbeef" * 3)])
    got = {(r["doc_id"], r["text"]) for r in secrets.redact(docs).collect()}
    assert (50, "clean text\nstays") in got and (4, None) in got and (5, "") in got
    assert (51, "[secret]") in got
    assert secrets.redact(docs).columns == docs.columns
    assert all(not expected(t, secrets.ALL_RULES) for _, t in got)


def test_overlapping_spans_become_one_mark():
    assert secrets.blanked("0123456789", [(1, 4), (3, 6), (8, 9)], "#") == "0#67#9"


def test_query_digests(spark, documents, tmp_path):
    documents(HAND).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op1_secret_scan(spark, str(tmp_path)).collect()
    assert len(rows) == len(HAND)
    for r in rows:
        text = {str(i): t for i, t in HAND}[str(r["doc_id"])]
        base = expected(text, secrets.BASE_RULES)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(base.count(k + ":") for k in ("assign", "access", "hex"))
        assert r["spans"] == expected(text, secrets.ALL_RULES)


BODY = "\n".join(["MIIEpAIBAAKCAQEA" + "Zq9+/" * 9 + "abc"] * 5 + ["Qk3x+A=="])
MARK = "-----BEGIN RSA PRIVATE KEY-----"
LAST = "-----END RSA PRIVATE KEY-----"
KEYS = [
    (f"before {MARK}\n{BODY}\n{LAST} after", "before [secret] after"),
    (f"{MARK}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AB\n\n{BODY}\n{LAST}\nx", "[secret]\nx"),
    ('k = "' + f"{MARK}\n{BODY}\n{LAST}\n".replace("\n", "\\n") + '"', 'k = "[secret]\\n"'),
    (f"{MARK}\r\n" + BODY.replace("\n", "\r\n") + "\r\nNot a line of a key.", "[secret]\r\nNot a line of a key."),
    (f"{MARK}\nProc-Type: 4,ENCRYPTED\n\n{BODY}\n\nWords go on.", "[secret]\n\nWords go on."),
    (f"{MARK}\n{BODY[:150]}", "[secret]"),
    (f"{MARK}\n{BODY}\n-----END EC PRIVATE KEY-----", "[secret]\n-----END EC PRIVATE KEY-----"),
    (f"{MARK}\n{BODY}\n{MARK}\n{BODY}\n{LAST}.", "[secret]\n[secret]."),
    (f"a line {MARK} opens a key", "a line [secret] opens a key"),
]


def test_whole_private_keys_are_redacted(documents):
    got = {r["doc_id"]: r["text"] for r in secrets.redact(documents([(i, t) for i, (t, _) in enumerate(KEYS)])).collect()}
    assert [got[i] for i in range(len(KEYS))] == [want for _, want in KEYS]


def test_private_key_span_holds_the_key():
    rule = next(r for r in secrets.MORE_RULES if r.kind == "private_key")
    text = KEYS[0][0]
    match = rule.compiled().search(text)
    assert match[0] == text[len("before ") : -len(" after")]
    marker = secrets.Rule("marker", r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
    assert secrets._named(secrets.trigram_query(rule)) == secrets._named(secrets.trigram_query(marker))
