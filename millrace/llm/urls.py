"""URL filters: a temporal join of captures with a dated block list, in DataFrame operations alone.

List entries become validity intervals: an entry holds from its date until the next entry
for the same pattern.  A capture asks for the patterns that can cover its URL and meets
the entry of each that was active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A host that a third of all captures share is met in this many groups.
SALTS = 8

# Verdicts in the order in which they win on one date.
VERDICTS = ("clear", "allow", "block")

# scheme://user@ before the host; host up to port, path, query or fragment
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def segment_of(url: Column) -> Column:
    """The first part of the path; null if there is none."""
    part = F.regexp_extract(url, SEGMENT, 1)
    return F.when(part != "", part)


def patterns_of(url: Column) -> Column:
    """Patterns that cover a URL: its host, the domains above it of two labels or more, and host/segment."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.array_compact(F.array_append(domains, F.concat_ws("/", host, segment_of(url))))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, verdict, valid_from, valid_to`` (exclusive, null: until now) from ``pattern, verdict, listed``.

    Entries without pattern, date or a known verdict are left out.  Of entries for one
    pattern and date the strongest verdict counts; repeated ones are one.  The case of a
    host does not count, that of a path does.
    """
    host, path = F.regexp_extract("pattern", "^[^/]*", 0), F.regexp_replace("pattern", "^[^/]*", "")
    rank = F.array_position(F.array(*map(F.lit, VERDICTS)), F.col("verdict"))
    dated = (
        entries.select(F.concat(F.lower(host), path).alias("pattern"), "verdict", "listed")
        .filter(F.col("pattern").isNotNull() & F.col("listed").isNotNull() & (rank > 0))
        .groupBy("pattern", "listed")
        .agg(F.max_by("verdict", rank).alias("verdict"))
    )
    following = Window.partitionBy("pattern").orderBy("listed")
    return dated.select(
        "pattern", "verdict", F.col("listed").alias("valid_from"), F.lead("listed").over(following).alias("valid_to")
    )


def evaluate(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """``page_id, url, fetched`` of every capture with ``verdict, pattern, listed`` of the entry that decides it, and ``blocked``.

    Of the patterns that cover a URL, the longest with an entry active at fetch time other
    than "clear" decides.  An entry is active from its date on.  Captures without URL, host
    or date, and those that no entry covers, have nulls and are not blocked.  Repeated
    captures are evaluated once and given once each; an empty table gives none.
    """
    capture = ["page_id", "url", "fetched"]
    once = captures.groupBy(*capture).agg(F.count("*").alias("_copies"))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int").alias("_salt")
    asked = once.select(*capture, "_copies", salt, F.explode_outer(patterns_of(F.col("url"))).alias("_asked"))
    active = intervals(entries).filter("verdict != 'clear'")
    active = active.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    holds = (F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    met = asked.join(active, (F.col("_asked") == F.col("pattern")) & (F.col("_salt") == F.col("_part")) & holds, "left")
    found = F.when(F.col("pattern").isNotNull(), F.struct(F.length("pattern").alias("n"), "pattern", "verdict", "valid_from"))
    best = met.groupBy(*capture, "_copies").agg(F.max(found).alias("_best"))
    return best.select(
        *capture,
        F.col("_best.verdict").alias("verdict"),
        F.col("_best.pattern").alias("pattern"),
        F.col("_best.valid_from").alias("listed"),
        F.coalesce(F.col("_best.verdict") == "block", F.lit(False)).alias("blocked"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")


# --- a dated list and fetch times for tables without them ------------------------------------

DAY = 86_400


def _number(text: Column) -> Column:
    """24 bits of the MD5 of a text, as a number that SQL gives as well."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long")


def with_fetch_time(pages: DataFrame) -> DataFrame:
    """``page_id, url, fetched``: seconds within one year, spread over the pages by their ids, of any size."""
    year = F.lit(365 * DAY)
    return pages.select("page_id", "url", F.pmod(F.pmod("page_id", year) * (7919 * 3600), year).alias("fetched"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, parent domains and path prefixes that occur in the pages.

    Which of them are listed, and when, follows from a hash: blocks, some cleared after 30
    days and some of those listed again 60 days later; blocked domains with hosts allowed.
    """
    url = F.col("url")
    hosts = pages.select(host_of(url).alias("pattern")).filter("pattern is not null").distinct()
    parents = (
        hosts.filter(F.size(F.split("pattern", r"\.")) > 3)
        .select(F.regexp_replace("pattern", r"^[^.]+\.", "").alias("pattern"))
        .distinct()
    )
    prefixes = (
        pages.filter(segment_of(url).isNotNull())
        .select(F.concat_ws("/", host_of(url), segment_of(url)).alias("pattern"), host_of(url).alias("host"))
        .filter("host is not null")
        .select("pattern")
        .distinct()
    )
    number = _number(F.col("pattern"))
    day = number % 300

    def entry(names: DataFrame, part: int, left: int, verdict: str, later: int) -> DataFrame:
        listed = names.filter(number % part == left)
        return listed.select("pattern", F.lit(verdict).alias("verdict"), ((day + later) * DAY).alias("listed"))

    return (
        entry(hosts, 4, 0, "block", 0)
        .unionByName(entry(hosts, 8, 0, "clear", 30))
        .unionByName(entry(hosts, 16, 0, "block", 90))
        .unionByName(entry(hosts, 7, 1, "allow", 10))
        .unionByName(entry(parents, 5, 0, "block", 0))
        .unionByName(entry(prefixes, 9, 0, "block", 0))
    )
