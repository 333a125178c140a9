"""Personal data in texts, by built-in functions alone.

Regular expressions propose spans, checksums (Luhn, mod 97) and value ranges confirm
them, and words nearby move the score.  The places of the matches follow from the texts
between them, so no text is searched from Python and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole_texts

SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
FOUND = "array<struct<match:string,before:string,after:string,start:bigint>>"

# Characters on either side of a span in which its context words are looked for.
NEAR = 40
CONTEXT = 0.3

# Spans of kinds that are not required need this score.
LEAST_SCORE = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.split(F.reverse(digits), "")

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(each, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces passes the mod 97 check: first four characters last, A = 10."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _alone(before: Column, after: Column) -> Column:
    """No letter or digit touches the span."""
    return ~(before.rlike(r"[A-Za-z0-9]\z") | after.rlike(r"\A[A-Za-z0-9]"))


@dataclass(frozen=True)
class Proposal:
    """What finds the matches of one or more kinds.

    ``pattern`` gives the matches that ``plain``, its simple form, gives, but for those no kind
    accepts: guarded at their start and possessive, so that it reads a text once, however
    long its runs.  Only texts that hold ``mark`` are searched.
    """

    name: str
    plain: str
    pattern: str
    mark: str | None = None


# The plain patterns of the four base kinds.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ACCOUNT = r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?"

# A run starts where no character of its class stands before, or where the last match ended.
PROPOSALS = {
    p.name: p
    for p in (
        Proposal(
            "email",
            EMAIL,
            r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
            "@",
        ),
        Proposal("ip", IP, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", "."),
        # Chains of 9 to 19 digits; the others are of no kind.
        Proposal("card", CARD, r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){8,18}+(?![\x20-]?[0-9])"),
        Proposal("phone", PHONE, PHONE, "+"),
        Proposal("account", ACCOUNT, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?+"),
    )
}


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: a proposal's matches that ``valid`` (match, before, after) accepts.

    The score is ``score``, more by ``CONTEXT`` with one of ``words`` nearby (whole words, in
    lower case), less by it with one of ``against``, between 0 and 1.  A ``required`` kind keeps its spans whatever their score.
    """

    name: str
    proposal: str
    valid: Callable[[Column, Column, Column], Column]
    score: float
    words: tuple[str, ...]
    against: tuple[str, ...] = ()
    required: bool = True


def _of_digits(least: int, most: int) -> Callable[[Column, Column, Column], Column]:
    return lambda m, before, after: F.length(_digits(m)).between(least, most)


def _card(least: int, most: int) -> Callable[[Column, Column, Column], Column]:
    return lambda m, before, after: F.when(F.length(_digits(m)).between(least, most), luhn(_digits(m))).otherwise(False)


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TEST_WORDS = ("example", "sample", "dummy")

KINDS = (
    Kind("email", "email", lambda m, b, a: F.lit(True), 0.8, ("mail", "contact", "write to"), TEST_WORDS),
    Kind("ip", "ip", lambda m, b, a: m.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"), 0.6, ("ip", "address", "host", "server"), ("version", "release")),
    Kind("card", "card", _card(16, 19), 0.8, ("card", "visa", "credit", "debit", "payment"), ("order", "tracking", *TEST_WORDS)),
    Kind("phone", "phone", _of_digits(8, 15), 0.6, ("phone", "call", "tel", "mobile", "fax"), TEST_WORDS),
    # The method's own: checked more weakly, so that words nearby decide on some.
    Kind(
        "iban",
        "account",
        lambda m, b, a: _alone(b, a) & F.length(F.replace(m, F.lit(" "))).between(15, 34) & mod97(F.replace(m, F.lit(" "))),
        0.8,
        ("iban", "account", "bank", "konto", "cuenta", "compte"),
        TEST_WORDS,
        required=False,
    ),
    Kind(
        "short_card",
        "card",
        lambda m, b, a: _alone(b, a) & _card(13, 15)(m, b, a),
        0.4,
        ("card", "visa", "credit", "debit", "payment", "amex"),
        ("order", "tracking", *TEST_WORDS),
        required=False,
    ),
    Kind(
        "tax_id",
        "card",
        lambda m, b, a: _alone(b, a) & m.rlike(r"\A(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}\z"),
        0.4,
        ("ssn", "social security", "tax id", "taxpayer"),
        TEST_WORDS,
        required=False,
    ),
)
BASE_KINDS = [k.name for k in KINDS if k.required]


def _sums_before(lengths: Column, group: Column) -> Column:
    """The sum of all entries before each place, by sums of groups of ``group`` entries.

    Adds up group * entries + (entries / group)^2 numbers, where a growing array would copy
    the square of the entries.
    """
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
    starts = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / group).cast("int")),
        lambda g: total(F.slice(lengths, g * group + 1, group)),
    )
    return F.flatten(
        F.transform(
            F.transform(starts, lambda s, g: F.struct(g.alias("g"), total(F.slice(starts, 1, g)).alias("at"))),
            lambda s: F.transform(
                F.slice(lengths, s["g"] * group + 1, group),
                lambda x, i: s["at"] + total(F.slice(lengths, s["g"] * group + 1, i)),
            ),
        )
    )


def _proposed(texts: DataFrame, proposal: Proposal) -> DataFrame:
    """Adds the column ``proposal.name``: every match with its start and the characters near it.

    Each step is a column that the next ones name more than once, so that it is computed once a text.
    """
    name = proposal.name
    matches, gaps, steps, group = (f"{name}_{x}" for x in ("matches", "gaps", "steps", "group"))
    none = F.array().cast("array<string>")
    all_matches = F.regexp_extract_all("text", F.lit(proposal.pattern), F.lit(0))
    if proposal.mark:
        all_matches = F.when(F.contains("text", F.lit(proposal.mark)), all_matches).otherwise(none)
    between = F.when(F.size(matches) > 0, F.split("text", proposal.pattern, -1)).otherwise(none)
    # A step is the text between two matches and the match before it.
    lengths = F.transform(matches, lambda m, i: F.length(m).cast("long") + F.length(F.get(gaps, i)))
    placed = F.zip_with(
        F.transform(matches, lambda m, i: F.struct(m.alias("match"), F.get(gaps, i).alias("gap"), F.get(gaps, i + 1).alias("next"))),
        _sums_before(F.col(steps), F.col(group)),
        lambda m, at: F.struct(
            m["match"].alias("match"),
            F.right(m["gap"], F.lit(NEAR)).alias("before"),
            F.left(m["next"], F.lit(NEAR)).alias("after"),
            (at + F.length(m["gap"])).alias("start"),
        ),
    )
    return (
        texts.withColumn(matches, all_matches)
        .withColumn(gaps, between)
        .withColumn(steps, lengths)
        .withColumn(group, F.ceil(F.sqrt(F.size(steps))).cast("int"))
        .withColumn(name, F.when(F.size(steps) > 0, placed).otherwise(F.array().cast(FOUND)))
        .drop(matches, gaps, steps, group)
    )


def _spans(kind: Kind) -> Column:
    """The accepted spans of one kind, with their scores, by start."""

    def scored(x: Column) -> Column:
        near = F.lower(F.concat(x["before"], F.lit(" "), x["after"]))
        any_of = lambda words: near.rlike(rf"(?:^|[^a-z0-9])(?:{'|'.join(words)})(?:[^a-z0-9]|$)") if words else F.lit(False)
        score = F.lit(kind.score) + F.when(any_of(kind.words), CONTEXT).otherwise(0.0) - F.when(any_of(kind.against), CONTEXT).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            x["start"].alias("start"),
            (x["start"] + F.length(x["match"])).alias("end"),
            F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 2).alias("score"),
        )

    accepted = F.filter(kind.proposal, lambda x: kind.valid(x["match"], x["before"], x["after"]))
    spans = F.transform(accepted, scored)
    return spans if kind.required else F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)


def find(docs: DataFrame, kinds: Sequence[Kind] = KINDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text: ``doc_id, spans`` (kind, start, end in code points, end exclusive, score).

    Spans are sorted by the order of ``kinds``, then by start; those of one kind do not
    overlap, those of two kinds may.  A null or empty text has none.  Every row, repeated or
    without an id, gives one row; other columns are not looked at; an empty table gives none.
    """
    texts = whole_texts(docs, id_col, text_col)
    for name in dict.fromkeys(k.proposal for k in kinds):
        texts = _proposed(texts, PROPOSALS[name])
    return texts.select("doc_id", F.concat(F.array().cast(SPANS), *(_spans(k) for k in kinds)).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask(docs: DataFrame, kinds: Sequence[Kind] = KINDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, masked``: every whole text with each found span replaced by its kind in brackets.

    Of spans that overlap, the one that starts first is named, of those the longest, and the
    mark stands for all of them.  A null text is masked to an empty one.
    """
    texts = whole_texts(docs, id_col, text_col)
    for name in dict.fromkeys(k.proposal for k in kinds):
        texts = _proposed(texts, PROPOSALS[name])
    spans = F.concat(F.array().cast(SPANS), *(_spans(k) for k in kinds))
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end"), s["kind"].alias("kind")),
    )
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        between = F.substr(F.col("text"), (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(
            F.when(inside, state["done"]).otherwise(F.concat(state["done"], between, F.lit("["), s["kind"], F.lit("]"))).alias("done"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    end = F.aggregate("ordered", start, step, lambda s: F.concat(s["done"], F.substr(F.col("text"), (s["at"] + 1).cast("int"))))
    return texts.withColumn("ordered", ordered).select("doc_id", F.when(F.size("ordered") > 0, end).otherwise(F.col("text")).alias("masked"))
