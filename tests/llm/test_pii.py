"""Personal data against plain searches, checks and places in Python."""

import hashlib
import re

import duckdb
import pytest

from millrace.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and plain_luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "", re.ASCII) if passes(k, m.group())]


def with_check(digits):
    """The digits and the last one that makes them pass."""
    return next(digits + c for c in "0123456789" if plain_luhn(digits + c))


VISA, LONG, SHORT = with_check("411111111111111"), with_check("670000000000000001"), with_check("37144963539843")
IBAN = "DE" + str(98 - int("370400440532013000" + "131400") % 97).zfill(2) + "370400440532013000"

TEXTS = [
    None,
    "",
    "nothing here, not even one @ or +",
    "mail a.b+c@d-e.example.org.uk. then x@y.z_w@q.r, not a@b or @c.d or a@b..c",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 0000255.001.02.3 and 1.2.3 and 999999999999999999999.1.1.1 9.9.9.9",
    f"cards {VISA} {' '.join(VISA[i : i + 4] for i in range(0, 16, 4))}, {LONG}; {VISA[:-1]}{(int(VISA[-1]) + 1) % 10}. x{VISA}y {VISA}  1",
    f"{VISA}-{VISA} {VISA} 7",
    "call +49 (30) 123-45 67. or +1 2, +12345678901234567, ++44 20 7946 0018  +4 ( ) 5",
    "naïve 𝔘𝔫𝔦 é@é ünï@x.de 𝔘+33 1 23 45 67 89𝔘 8.8.8.8é",
    f"a@b.c1.2.3.4+49 30 1234567{VISA}",
    f"bank account {IBAN}, {' '.join(IBAN[i : i + 4] for i in range(0, 22, 4))}. x{IBAN} {IBAN}y {IBAN[:4]}9{IBAN[5:]}",
    f"pay by card {SHORT} soon",
    f"order {SHORT} soon",
    "social security 123-45-6789, ssn 000-12-3456, ssn: 666-12-3456 and 1123-45-6789 SSN 219-09-9999",
    "just 123-45-6789 alone",
    "\n".join(f"user{i}@host{i % 7}.net 10.0.{i}.{i % 300}" for i in range(700)),
    "a" * 500 + "@" + "." * 200 + "1" * 500 + " 1" * 300 + "+" * 100 + "1.2.3." * 300 + "é@x.yz",
]


def test_equals_plain_search(spark, documents):
    got = {r["doc_id"]: r["spans"] for r in pii.find(documents(enumerate(TEXTS))).collect()}
    assert set(got) == set(range(len(TEXTS)))
    for i, text in enumerate(TEXTS):
        found = [f"{s['kind']}:{s['start']}:{s['end']}" for s in got[i] if s["kind"] in pii.BASE_KINDS]
        assert found == base_spans(text), i
        assert all(0 <= s["score"] <= 1 for s in got[i])
    of = lambda i, kind: [TEXTS[i][s["start"] : s["end"]] for s in got[i] if s["kind"] == kind]
    assert len(of(10, "iban")) == 2 and of(11, "short_card") == [SHORT] and of(12, "short_card") == []
    assert of(13, "tax_id") == ["123-45-6789", "219-09-9999"] and of(14, "tax_id") == []
    scores = {TEXTS[3][s["start"] : s["end"]]: s["score"] for s in got[3]}
    assert scores["a.b+c@d-e.example.org.uk"] == 1.0 and scores["x@y.z"] == 0.8


def test_query_and_oracle(spark, documents, tmp_path):
    pairs = [*enumerate(TEXTS[:-1]), (None, "id gone 7.7.7.7"), (3, TEXTS[3])]
    docs = documents(pairs)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op12_personal_data(spark, str(tmp_path)).collect()
    for r in rows:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None else "id gone 7.7.7.7"
        base = base_spans(text)
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k + ":") for s in base) for k in PLAIN]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in PLAIN] == base
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(queries.OP12_SQL).fetchall()
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted((tuple(r) for r in rows), key=order) == sorted(want, key=order)


def test_very_long_runs(spark, documents):
    """Runs of one class in a text of a million characters, where a plain search takes the square of their length."""
    start = "a" * 400_000 + "@" + "." * 50_000 + "1" * 300_000 + " 1" * 100_000 + "+" * 10_000
    text = start + "x@y.zz " + "1.2.3.4 " * 20_000
    row = pii.find(documents([(1, text)])).first()
    at = len(start) + 7
    ips = [f"ip:{at + 8 * i}:{at + 8 * i + 7}" for i in range(20_000)]
    found = [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["spans"]]
    assert found == [f"email:{len(start) - 10_001}:{len(start) + 6}", *ips]


def test_mask(spark, documents):
    texts = ["x a@b.de y 1.2.3.4", None, "clean", "a@1.2.3.4 end", "+49123 1.2.3.4 z"]
    got = {r["doc_id"]: r["masked"] for r in pii.mask(documents(enumerate(texts))).collect()}
    assert got == {0: "x [email] y [ip]", 1: "", 2: "clean", 3: "[email] end", 4: "[phone] z"}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 99, 100, 101])
def test_sums_before(spark, n):
    from pyspark.sql import functions as F

    values = [(i * 7) % 11 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<long>").withColumn("g", F.ceil(F.sqrt(F.size("v"))).cast("int"))
    got = df.select(pii._sums_before(F.col("v"), F.col("g")).alias("s")).first()["s"]
    assert got == [sum(values[:i]) for i in range(n)]


def test_native_and_empty(spark, documents):
    df = pii.find(documents([]))
    assert df.count() == 0
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
