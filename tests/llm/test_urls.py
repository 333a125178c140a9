"""The temporal list join against a search of the whole list for each capture."""

import random
from collections import Counter

import pytest

from millrace.llm import urls

CAPTURES = "page_id long, url string, fetched long, verdict string, pattern int"
ENTRIES = "pattern string, verdict string, listed long, page_id long"


def brute(captures, entries):
    """For each capture the longest pattern whose newest entry by then is a block or an allowance."""
    out = Counter()
    for page, url, fetched in captures:
        best = None
        host = segment = None
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            for mark in "/?#":
                rest = rest.replace(mark, "\0" + mark, 1) if mark in rest else rest
            authority = rest.split("\0")[0]
            host = authority.rsplit("@", 1)[-1].split(":")[0].lower().rstrip(".") or None
            tail = url.split("://", 1)[1][len(authority) :]
            if tail.startswith("/"):
                segment = tail[1:].split("/")[0].split("?")[0].split("#")[0] or None
        if host and fetched is not None:
            labels = host.split(".")
            names = [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
            names.append(host + ("/" + segment if segment else ""))
            for name in names:
                past = [(d, urls.VERDICTS.index(v)) for p, v, d in entries if p and v in urls.VERDICTS and d is not None and p.lower() == name and d <= fetched]
                if past and max(past)[1] > 0:
                    listed, strength = max(past)
                    best = max(best or (), (len(name), name, urls.VERDICTS[strength], listed))
        verdict = best[2] if best else None
        out[(page, url, fetched, verdict, best and best[1], best and best[3], verdict == "block")] += 1
    return out


def got(spark, captures, entries, **more):
    a = spark.createDataFrame([(*c, "x", 1) for c in captures], CAPTURES)
    b = spark.createDataFrame([(*e, 5) for e in entries], ENTRIES)
    return Counter(map(tuple, urls.evaluate(a, b, **more).collect()))


@pytest.mark.parametrize("salts", [1, 8])
def test_equals_search_of_the_list(spark, salts):
    rng = random.Random(6)
    hosts = ["a.com", "B.a.com", "c.b.a.com", "localhost", "d.org", "x.d.org."]
    paths = ["", "/", "/p", "/p/q", "?q=/p", "#f", "/P?x", "//p"]
    captures = [(rng.randint(0, 50), f"http{rng.choice(['', 's'])}://{rng.choice(['', 'u:p@'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}{rng.choice(paths)}", rng.randint(0, 20)) for _ in range(300)]
    captures += [(1, None, 5), (None, "http://a.com", 5), (2, "", 5), (3, "no url", 5), (4, "http://a.com", None), (None, "http://a.com", 5)]
    names = ["a.com", "b.a.com", "A.com/p", "c.b.a.com", "d.org", "x.d.org/p", "com", "localhost", "x.d.org"]
    entries = [(rng.choice(names), rng.choice(urls.VERDICTS), rng.randint(0, 20)) for _ in range(60)]
    entries += [(None, "block", 1), ("a.com", "block", None), ("a.com", None, 3), ("d.org", "strange", 4), entries[0], entries[0]]
    assert got(spark, captures, entries, salts=salts) == brute(captures, entries)


def test_active_from_its_date_until_the_next(spark):
    entries = [("a.com", "block", 10), ("a.com", "clear", 20), ("a.com", "allow", 30)]
    captures = [(t, "http://a.com/", t) for t in (9, 10, 19, 20, 29, 30, 99)]
    assert {k[0]: k[3] for k in got(spark, captures, entries)} == {9: None, 10: "block", 19: "block", 20: None, 29: None, 30: "allow", 99: "allow"}


def test_empty_tables(spark):
    assert got(spark, [], [("a.com", "block", 1)]) == Counter()
    assert got(spark, [(1, "http://a.com", 1)], []) == Counter({(1, "http://a.com", 1, None, None, None, False): 1})


def test_fetch_times_of_very_large_ids(spark):
    ids = [0, 7, 3 * 10**11, 2**63 - 1, -(2**63), -5, None]
    pages = spark.createDataFrame([(i, "u", 1) for i in ids], "page_id long, url string, fetched int")
    got = {r["page_id"]: r["fetched"] for r in urls.with_fetch_time(pages).collect()}
    assert got == {i: None if i is None else i * 7919 * 3600 % 31536000 for i in ids}


def test_case_counts_in_paths_and_not_in_hosts(spark):
    captures = [(1, "http://Host.com/Products/a", 5), (2, "http://host.com/products/a", 5)]
    entries = [("HOST.com/Products", "block", 1)]
    want = Counter(
        [
            (1, "http://Host.com/Products/a", 5, "block", "host.com/Products", 1, True),
            (2, "http://host.com/products/a", 5, None, None, None, False),
        ]
    )
    assert got(spark, captures, entries) == want
