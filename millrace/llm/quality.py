"""Quality rules by distribution divergence, in DataFrame operations alone.

Each document's histograms of character classes and of common words are compared with
those of its language by the Jensen-Shannon distance.  A reference is the mean histogram of
all documents of the language, so that no single document, however long, shapes it.
Documents too short for a histogram, and languages too rare for a reference, are not
judged by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name
from millrace.session import materialise

SPACE = "\t\n\x0b\f\r "
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# Classes of characters; what none of them matches is the last class.
CLASSES = (r"\p{Ll}+", r"\p{Lu}+", r"\p{Nd}+", SPACES, r"""[.,;:!?'"()\-]+""", r"\p{L}+")


@dataclass(frozen=True)
class Limits:
    """Production parameters of the divergence rules."""

    common_words: int = 24  # words of each language's histogram, beside all others
    least_documents: int = 20  # of a language with a reference
    least_words: int = 50  # of a document that is judged
    most_class_distance: float = 0.30
    most_word_distance: float = 0.40


def words_of(text: Column) -> Column:
    """Runs of anything but space and 09-0D."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def _windows(words: Column) -> Column:
    """A hash of the three words at each place but the last two."""
    return F.when(F.size(words) < 3, F.array().cast("array<long>")).otherwise(
        F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(1))),
            lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
        )
    )


def _in_order(windows: Column) -> Column:
    """The windows with their places, sorted by hash; empty if no hash occurs twice."""
    placed = F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    none = F.array().cast("array<struct<g:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), none).otherwise(F.sort_array(placed))


def _covered(ordered: Column) -> Column:
    """The number of words under windows that have an equal one."""
    twice = F.filter(
        ordered,
        lambda x, i: F.equal_null(F.get(ordered, i - 1)["g"], x["g"]) | F.equal_null(F.get(ordered, i + 1)["g"], x["g"]),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n")),
        lambda a: a["n"],
    )


def measured(docs: DataFrame) -> DataFrame:
    """Base counts of every row: ``doc_id, lang, text`` become counts; ``words`` stays for histograms.

    ``no_lower`` and ``bare`` stay too: the text without lower-case letters, and without those and
    spaces.  All other classes are counted in what is left there, a small part of the text.
    """
    text = F.col("text")
    split = docs.withColumn("words", words_of(text)).withColumn("lines", F.split(text, "\n"))
    spoken = split.withColumn("lines", F.filter("lines", lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    lower, space = CLASSES[0], CLASSES[3]
    return (
        spoken.withColumn("no_lower", F.regexp_replace(text, lower, ""))
        .withColumn("bare", F.regexp_replace("no_lower", space, ""))
        .withColumn("windows", _windows(F.col("words")))
        .withColumn("ordered", _in_order(F.col("windows")))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("n_spaces", (F.length("no_lower") - F.length("bare")).cast("long"))
        .withColumn("word_chars", F.length(text).cast("long") - F.col("n_spaces"))
        .withColumn("n_symbols", (F.length("bare") - F.length(F.regexp_replace("bare", SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_repeat_words", _covered(F.col("ordered")))
        .drop("windows", "ordered", "lines")
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def histograms(rows: DataFrame) -> DataFrame:
    """Adds ``classes`` (characters of each class, then the rest) and ``common_counts`` (of each common word, then the rest).

    ``rows`` comes from ``measured`` and holds ``common``, the words that are counted (null: none).
    """
    rest = lambda c: (F.length("bare") - F.length(F.regexp_replace("bare", c, ""))).cast("long")
    lower = (F.length("text") - F.length("no_lower")).cast("long")
    upper, number, marks, letters = (rest(CLASSES[i]) for i in (1, 2, 4, 5))
    counted = F.struct(
        lower.alias("lower"), upper.alias("upper"), number.alias("number"), F.col("n_spaces").alias("space"), marks.alias("marks"), letters.alias("letters")
    )
    each = F.transform(
        F.coalesce("common", F.array().cast("array<string>")),
        lambda w: F.col("n_words") - F.size(F.array_remove("words", w)),
    )
    c = F.col("counted")
    others = F.length("text").cast("long") - c["lower"] - c["number"] - c["space"] - c["marks"] - c["letters"]
    return (
        rows.withColumn("counted", counted)
        .withColumn("common_counts", each)
        .withColumn("classes", F.array(*(c[n] for n in ("lower", "upper", "number", "space", "marks")), c["letters"] - c["upper"], others))
        .withColumn("common_counts", F.array_append("common_counts", F.col("n_words") - _total(F.col("common_counts"))))
        .drop("counted", "no_lower", "bare", "n_spaces")
    )


def common_words(docs: DataFrame, limits: Limits) -> DataFrame:
    """``lang, common``: the words that most documents of a language hold, for each that gets a reference.

    Ties go to the smaller word.
    """
    known = (
        docs.filter("lang is not null")
        .groupBy("lang")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= limits.least_documents)
        .select("lang")
    )
    counts = docs.select("lang", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")).groupBy("lang", "word").count()
    best = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    top = counts.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= limits.common_words)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("common"))
    return materialise(
        known.join(listed, "lang", "left").select("lang", F.coalesce(F.col("common")["word"], F.array().cast("array<string>")).alias("common")),
        "common",
    )


def shares(counts: Column) -> Column:
    """Each count over their sum, as doubles; null if the sum is not positive."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    each = F.transform(F.arrays_zip(counts.alias("c"), F.array_repeat(total, F.size(counts)).alias("t")), lambda x: x["c"] / x["t"])
    return F.when(total > 0, each)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms given as shares; null if one is."""

    def term(a: Column, b: Column) -> Column:
        part = lambda x: F.when(x > 0, x * F.log2(2 * x / (a + b))).otherwise(0.0)
        return (part(a) + part(b)) / 2

    divergence = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda a, b: a + b)
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def judged(
    docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Base counts, ``base_failed``, the two distances and ``kept`` for every row, with ``row``, a hash of id, language and text.

    ``base_failed``: fewer than 50 words, or more than half of the words under repeated
    windows of three.  Such documents are not kept, and neither are those of at least
    ``least_words`` words with a distance above its limit.  A document without a reference
    for its language (null, rare) has null distances and is judged by the base rules alone.
    A null text counts as empty.  Every row, repeated or without an id, gives one row.
    """
    both = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    common = common_words(both, limits)
    counted = histograms(measured(both.join(common, "lang", "left")))
    real = lambda c: shares(F.transform(c, lambda x: x.cast("double")))
    counted = (
        counted.withColumn("row", row_of("doc_id", "text", "lang"))
        .withColumn("classes", real(F.col("classes")))
        .withColumn("common_counts", real(F.col("common_counts")))
        .drop("text", "words", "common")
    )
    stored = materialise(counted, "counted")
    sums = lambda column, n: F.array(*(F.sum(F.get(column, i)) for i in range(n)))
    references = (
        common.select("lang")
        .join(stored, "lang")
        .groupBy("lang")
        .agg(
            sums("classes", len(CLASSES) + 1).alias("class_reference"),
            sums("common_counts", limits.common_words + 1).alias("word_reference"),
        )
        .select("lang", shares(F.col("class_reference")).alias("class_reference"), shares(F.array_compact("word_reference")).alias("word_reference"))
    )
    # Written, so that its size is known: a small table may be broadcast, a large one is joined by language.
    compared = stored.join(materialise(references, "references"), "lang", "left")
    repeated = 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    far = (F.col("class_distance") > limits.most_class_distance) | (F.col("word_distance") > limits.most_word_distance)
    return (
        compared.withColumn("class_distance", js_distance(F.col("classes"), F.col("class_reference")))
        .withColumn("word_distance", js_distance(F.col("common_counts"), F.col("word_reference")))
        .withColumn("base_failed", (F.col("n_words") < 50) | repeated)
        .withColumn(
            "kept",
            ~F.col("base_failed") & ~((F.col("n_words") >= limits.least_words) & F.coalesce(far, F.lit(False))),
        )
        .drop("classes", "common_counts", "class_reference", "word_reference")
    )


def row_of(id_col: str, text_col: str, lang_col: str) -> Column:
    """128 bits that name a row by its id, text and language; equal rows share them."""
    parts = (F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit("\0")))
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def keep(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that are kept, with all their columns, whatever their names; the cases are those of ``judged``."""
    key = free_name(docs, "row")
    rejected = judged(docs, limits, id_col, text_col, lang_col).filter("not kept").select(F.col("row").alias(key)).distinct()
    rows = docs.withColumn(key, row_of(id_col, text_col, lang_col))
    return rows.join(rejected, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
