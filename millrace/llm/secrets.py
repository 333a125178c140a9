"""Secret scans: a trigram inverted index finds candidates for each rule, the regex verifies them.

Each rule's regex is turned into a Boolean query over trigrams that every match must
contain.  A shard of documents gets an inverted index from trigram to document, the
query intersects and unites its postings, and only documents that remain are searched
with the regex.  A rule without mandatory trigrams reads all documents.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as K
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Batches, in_slices, mapped, numbered, whole_texts

SPANS = "array<struct<kind:string,start:long,end:long>>"

# A run of adjacent positions is spelled out while it has at most this many spellings.
MOST_SPELLINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches whose ``group`` is long enough.

    Only ASCII letters are matched in either case, if ``ignore_case``.
    """

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least_chars: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The three base kinds.  A maximal run of 16 or more is the same as a
# maximal run that is kept if it has 16 or more.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ignore_case=True,
        group=2,
        least_chars=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least_chars=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)

# A private key runs to the END line with the name of its BEGIN line, over anything but another
# such line; without it to the last line of base64, over the header lines before.  Line ends
# may be written as \\n, lines may be quoted.
_BREAK = r"""["']?\x20*(?:\r?\n|\\r\\n|\\n)[\x20\t>#*|"']*"""
_KEY = (
    r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?:"
    r"[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1PRIVATE KEY-----|"
    rf"(?:(?:{_BREAK})+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
    rf"(?:(?:(?:{_BREAK})+[A-Za-z0-9+/]{{16,}}+|\s*[A-Za-z0-9+/]{{32,}}+)={{0,2}}+)*+"
    rf"(?:(?:{_BREAK})+(?:(?:[A-Za-z0-9+/]{{4}})*(?:[A-Za-z0-9+/]{{2}}==|[A-Za-z0-9+/]{{3}}=|[A-Za-z0-9+/]{{4}})"
    r"""(?=["']?\x20*(?:[\r\n\\]|\Z))|[A-Za-z0-9+/]+={0,2}(?=\s*\Z)))?)"""
)

# Public formats of further credentials; all of them have mandatory trigrams.
MORE_RULES = (
    Rule("private_key", _KEY),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay_key", r"[sr]k_live_[0-9A-Za-z]{16,}"),
)

ALL_RULES = BASE_RULES + MORE_RULES


# --- Boolean trigram queries -------------------------------------------------------------------
# A query is True (no condition), a trigram (bytes), ("and", queries) or ("or", queries).


def _all(parts):
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[bytes]):
    """One of these strings occurs: its trigrams do."""
    return _any(_all(s[i : i + 3] for i in range(len(s) - 2)) if len(s) > 2 else True for s in sorted(strings))


def _spellings(op, value) -> set[bytes] | None:
    """All strings that a node can match, or None if there are too many."""
    if op is K.LITERAL:
        return {chr(value).encode()}
    if op is K.IN:
        out: set[bytes] = set()
        for kind, item in value:
            if kind is K.LITERAL:
                out.add(chr(item).encode())
            elif kind is K.RANGE and item[1] - item[0] < MOST_SPELLINGS:
                out |= {chr(c).encode() for c in range(item[0], item[1] + 1)}
            else:
                return None
        return out if len(out) <= MOST_SPELLINGS else None
    if op is K.SUBPATTERN:
        return _sequence_spellings(value[-1])
    if op is K.BRANCH:
        out = set()
        for part in value[1]:
            strings = _sequence_spellings(part)
            if strings is None:
                return None
            out |= strings
        return out if len(out) <= MOST_SPELLINGS else None
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and value[1] is not K.MAXREPEAT and value[1] <= 4:
        once = _sequence_spellings(value[2])
        if once is None:
            return None
        out, run = set(), {b""}
        for n in range(value[1] + 1):
            if n >= value[0]:
                out |= run
            run = {a + b for a in run for b in once}
            if len(out) + len(run) > 4 * MOST_SPELLINGS:
                return None
        return out if len(out) <= MOST_SPELLINGS else None
    if op is K.AT:
        return {b""}
    return None


def _sequence_spellings(nodes) -> set[bytes] | None:
    run = {b""}
    for op, value in nodes:
        strings = _spellings(op, value)
        if strings is None or len(run) * len(strings) > MOST_SPELLINGS:
            return None
        run = {a + b for a in run for b in strings}
    return run


def _sequence_query(nodes):
    """Conjunction over the runs of adjacent positions that can be spelled out."""
    parts, run = [], {b""}
    for op, value in nodes:
        strings = _spellings(op, value)
        if strings is not None and len(run) * len(strings) <= MOST_SPELLINGS:
            run = {a + b for a in run for b in strings}
            continue
        parts.append(_of_strings(run))
        run = strings if strings is not None else {b""}
        if strings is None:
            parts.append(_node_query(op, value))
    return _all([*parts, _of_strings(run)])


def _node_query(op, value):
    if op is K.SUBPATTERN:
        return _sequence_query(value[-1])
    if op is K.BRANCH:
        return _any(_sequence_query(part) for part in value[1])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT) and value[0] > 0:
        return _sequence_query(value[2])
    return True  # classes, optional parts, look-arounds: nothing is mandatory


def _folded(query):
    if query is True:
        return True
    return query.lower() if isinstance(query, bytes) else (query[0], tuple(map(_folded, query[1])))


def trigram_query(rule: Rule):
    """The rule's Boolean query over trigrams of the text with A-Z folded; True if none is mandatory."""
    return _folded(_sequence_query(parser.parse(rule.pattern, re.ASCII)))


def _named(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_named, query[1]))


# --- the index of a shard ----------------------------------------------------------------------

LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def postings(texts: Sequence[str], trigrams: Sequence[bytes], block: int = 1 << 20) -> dict[bytes, np.ndarray]:
    """The shard's inverted index: sorted row numbers of the texts holding each trigram."""
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data])
    buffer = LOWER[np.frombuffer(b"".join(data), np.uint8)]
    number = {t: i for i, t in enumerate(trigrams)}
    codes = np.array([t[0] << 16 | t[1] << 8 | t[2] for t in trigrams], np.int32)
    order = np.argsort(codes)
    wanted = np.zeros(1 << 24, bool)
    wanted[codes] = True
    rows: list[np.ndarray] = []
    kinds: list[np.ndarray] = []
    for start in range(0, len(buffer) - 2, block):
        part = buffer[start : start + block + 2].astype(np.int32)
        code = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        at = np.flatnonzero(wanted[code])
        row = np.searchsorted(ends, at + start, "right")
        inside = at + start + 2 < ends[row]
        rows.append(row[inside])
        kinds.append(order[np.searchsorted(codes, code[at[inside]], sorter=order)])
    row, kind = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, kinds))
    return {t: np.unique(row[kind == i]) for t, i in number.items()}


def candidates(query, index: dict[bytes, np.ndarray], n_rows: int) -> np.ndarray:
    """Rows that satisfy the query, by intersecting and uniting postings."""
    if query is True:
        return np.arange(n_rows)
    if isinstance(query, bytes):
        return index[query]
    parts = [candidates(q, index, n_rows) for q in query[1]]
    out = parts[0]
    for other in parts[1:]:
        out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
    return out


def _scanner(rules: Sequence[Rule]):
    """A function from the texts of a shard to the sorted spans of each."""
    queries = [trigram_query(r) for r in rules]
    regexes = [r.compiled() for r in rules]
    trigrams = sorted(set().union(*map(_named, queries)))

    def scan(texts: Sequence[str]) -> list[list[tuple[int, int, int]]]:
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        index = postings(texts, trigrams) if trigrams else {}
        for number, (rule, query, regex) in enumerate(zip(rules, queries, regexes)):
            for row in candidates(query, index, len(texts)):
                for match in regex.finditer(texts[row]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least_chars:
                        found[row].append((match.start(), number, match.end()))
        for spans in found:
            spans.sort()
        return found

    return scan


def scan(docs: DataFrame, rules: Sequence[Rule] = ALL_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All secrets of every whole text: ``doc_id``, ``spans`` (kind, start, end in code points, end exclusive).

    Spans are sorted by start, then by the order of the rules.  A null or empty text has
    none; every row, repeated or with a null id, gives one row; an empty table gives none.
    """
    rules = tuple(rules)

    def run(batches: Batches) -> Batches:
        search = _scanner(rules)
        for batch in in_slices(batches, most_bytes=4 << 20):
            spans = [
                [{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in row]
                for row in search(batch.column("text").to_pylist())
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return mapped(whole_texts(docs, id_col, text_col), run, f"doc_id long, spans {SPANS}")


def blanked(text: str, spans: Sequence[tuple[int, int]], mark: str) -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: Sequence[Rule] = ALL_RULES, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; all columns stay, texts without secrets as they are.

    A null text stays null.
    """
    rules, schema, names = tuple(rules), docs.schema, docs.columns
    place = docs.columns.index(text_col)

    def run(batches: Batches) -> Batches:
        search = _scanner(rules)
        for batch in in_slices(batches, f"c{place}", 4 << 20):
            columns = list(batch.columns)
            texts = columns[place].to_pylist()
            found = search([t or "" for t in texts])
            clean = [blanked(t, [(a, b) for a, _, b in s], mark) if s else t for t, s in zip(texts, found)]
            columns[place] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return mapped(numbered(docs), run, schema)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
