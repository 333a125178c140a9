"""The registered queries ``opN_<name>`` of this package, with SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, kdtree, packing, pii, pitmanyor, prefixes, quality, secrets, simhash, substrings, toxicity, urls, whitening
from millrace.llm.common import whole_texts
from millrace.session import read_table

BASE_KINDS = [rule.kind for rule in secrets.BASE_RULES]


def op1_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    found = secrets.scan(read_table(spark, base, "documents"))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base_spans = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    return found.select(
        "doc_id",
        *(of_kind(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(secrets.joined_spans(base_spans), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op2_exact_top_k(spark: SparkSession, base: str) -> DataFrame:
    vectors = kdtree.quantised(read_table(spark, base, "embeddings"))
    return kdtree.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


OP2_SQL = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), usual AS (
  SELECT len(v) AS n FROM usable WHERE len(v) > 0 GROUP BY n ORDER BY count(*) DESC, n DESC LIMIT 1
), equal AS (
  SELECT vec_id, v FROM usable JOIN usual ON len(v) = n
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM equal q JOIN equal c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), numbered AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM numbered WHERE rank <= 5
"""


def op3_byte_bpe(spark: SparkSession, base: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.round_trip(read_table(spark, base, "documents"), path, public_tokenizers.PATTERN)
    return tokens.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def packed(docs: DataFrame) -> DataFrame:
    """Production parameters of packing: the ranks hold the vocabulary of ``byte_bpe_50k.json``."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.token_pieces(docs, path, public_tokenizers.PATTERN, end_id=0, max_tokens=2048)
    return packing.pack(pieces, 2048)


def op4_best_fit_packing(spark: SparkSession, base: str) -> DataFrame:
    return packed(read_table(spark, base, "documents"))


def op5_toxicity_lexicon(spark: SparkSession, base: str) -> DataFrame:
    docs = read_table(spark, base, "documents")
    model = toxicity.learn(whole_texts(docs), read_table(spark, base, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_quality_divergence(spark: SparkSession, base: str) -> DataFrame:
    found = quality.judged(read_table(spark, base, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM docs
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r
), known AS (
  SELECT lang FROM docs WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= 20
), counts AS (
  SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(list_distinct(words)) AS word FROM split) JOIN known USING (lang) GROUP BY ALL
), common AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS bin FROM counts
  QUALIFY bin <= 24
), found AS (
  SELECT r, bin, count(*) AS n
  FROM (SELECT r, lang, unnest(words) AS word FROM split) JOIN common USING (lang, word) GROUP BY ALL
), word_bins AS (
  SELECT s.r, s.lang, c.bin, coalesce(f.n, 0) AS n
  FROM split s JOIN common c USING (lang) LEFT JOIN found f ON f.r = s.r AND f.bin = c.bin
), runs AS (
  SELECT r, lang, length(text) AS n,
    length(text) - length(regexp_replace(text, '\p{Ll}+', '', 'g')) AS a,
    length(text) - length(regexp_replace(text, '\p{Lu}+', '', 'g')) AS b,
    length(text) - length(regexp_replace(text, '\p{Nd}+', '', 'g')) AS c,
    length(text) - length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS d,
    length(text) - length(regexp_replace(text, '[.,;:!?''"()\-]+', '', 'g')) AS e,
    length(text) - length(regexp_replace(text, '\p{L}+', '', 'g')) AS f
  FROM docs JOIN known USING (lang)
), bins AS (
  SELECT 'word' AS kind, r, lang, bin, n FROM word_bins
  UNION ALL
  SELECT 'word', s.r, s.lang, 0, len(s.words) - coalesce(sum(f.n), 0)
  FROM split s JOIN known USING (lang) LEFT JOIN found f USING (r) GROUP BY s.r, s.lang, s.words
  UNION ALL
  SELECT 'class', r, lang, unnest(range(7)), unnest([a, b, c, d, e, f - a - b, n - f - c - d - e]) FROM runs
), reference AS (
  SELECT kind, lang, bin, sum(n / total) AS n
  FROM (SELECT *, nullif(sum(n) OVER (PARTITION BY kind, r), 0) AS total FROM bins) GROUP BY ALL
), shares AS (
  SELECT kind, r, b.n / sum(b.n) OVER (PARTITION BY kind, r) AS p, f.n / sum(f.n) OVER (PARTITION BY kind, r) AS q
  FROM bins b JOIN reference f USING (kind, lang, bin)
), distances AS (
  SELECT kind, r, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                     + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d
  FROM shares GROUP BY ALL
), judged AS (
  SELECT s.r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words,
         coalesce(c.d > 0.30, false) OR coalesce(w.d > 0.40, false) AS far
  FROM split s LEFT JOIN repeated p ON p.r = s.r
  LEFT JOIN distances c ON c.r = s.r AND c.kind = 'class'
  LEFT JOIN distances w ON w.r = s.r AND w.kind = 'word'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR far) AS kept
FROM judged
"""


def op7_pitman_yor_scores(spark: SparkSession, base: str) -> DataFrame:
    return pitmanyor.score(read_table(spark, base, "documents"))


def op8_repeated_phrases(spark: SparkSession, base: str) -> DataFrame:
    found = substrings.dedup(read_table(spark, base, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash_golay(spark: SparkSession, base: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, base, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, base: str) -> DataFrame:
    pages = read_table(spark, base, "pages")
    found = urls.evaluate(urls.with_fetch_time(pages), urls.derived_entries(pages))
    return found.select("page_id", "fetched", "verdict", "pattern", "listed", "blocked")


OP10_SQL = r"""
WITH parts AS (
  SELECT page_id, url, (((page_id % 31536000) * 7919 * 3600) % 31536000 + 31536000) % 31536000 AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.+$', ''), '') AS host,
         nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1), '') AS segment
  FROM pages
), names AS (
  SELECT 'host' AS kind, pattern FROM (SELECT DISTINCT host AS pattern FROM parts WHERE host IS NOT NULL)
  UNION ALL
  SELECT 'parent', pattern FROM (
    SELECT DISTINCT regexp_replace(host, '^[^.]+\.', '') AS pattern FROM parts WHERE len(string_split(host, '.')) > 3)
  UNION ALL
  SELECT 'prefix', pattern FROM (
    SELECT DISTINCT host || '/' || segment AS pattern FROM parts WHERE host IS NOT NULL AND segment IS NOT NULL)
), numbered AS (
  SELECT kind, pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS number FROM names
), rules(kind, part, remainder, verdict, later) AS (
  VALUES ('host', 4, 0, 'block', 0), ('host', 8, 0, 'clear', 30), ('host', 16, 0, 'block', 90),
         ('host', 7, 1, 'allow', 10), ('parent', 5, 0, 'block', 0), ('prefix', 9, 0, 'block', 0)
), dated AS (
  SELECT pattern, (number % 300 + later) * 86400 AS listed,
         max(list_position(['clear', 'allow', 'block'], verdict)) AS strength
  FROM numbered JOIN rules USING (kind) WHERE number % part = remainder
  GROUP BY 1, 2
), intervals AS (
  SELECT pattern, ['clear', 'allow', 'block'][strength] AS verdict, listed,
         lead(listed) OVER (PARTITION BY pattern ORDER BY listed) AS ended
  FROM dated
), asked AS (
  SELECT page_id, url, fetched, unnest(list_append(
    [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, greatest(len(string_split(host, '.')), 2))],
    CASE WHEN segment IS NULL THEN host ELSE host || '/' || segment END)) AS pattern
  FROM parts WHERE host IS NOT NULL
), best AS (
  SELECT page_id, url, fetched, max((length(pattern), pattern, verdict, listed)) AS found
  FROM (SELECT DISTINCT * FROM asked) JOIN intervals USING (pattern)
  WHERE verdict <> 'clear' AND fetched >= listed AND (ended IS NULL OR fetched < ended)
  GROUP BY ALL
)
SELECT p.page_id, p.fetched, found[3] AS verdict, found[2] AS pattern, found[4] AS listed,
       coalesce(found[3] = 'block', false) AS blocked
FROM parts p LEFT JOIN best b ON p.page_id IS NOT DISTINCT FROM b.page_id AND p.url = b.url AND p.fetched = b.fetched
"""


def op11_embedding_whitening(spark: SparkSession, base: str) -> DataFrame:
    """A deviation that no long holds is null."""
    found = whitening.whiten(whitening.quantised(read_table(spark, base, "embeddings")), components=8, weights="counts")
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_personal_data(spark: SparkSession, base: str) -> DataFrame:
    found = pii.find(read_table(spark, base, "documents"))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base_spans = F.filter("spans", lambda s: s["kind"].isin(pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *(of_kind(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.joined_spans(base_spans), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
    )


def _pii_matches() -> str:
    """Matches and the texts between them, for each plain pattern."""
    one = """
  SELECT r, '{name}' AS p, regexp_extract_all(text, '{re}') AS m, string_split_regex(text, '{re}') AS g FROM docs"""
    return "\n  UNION ALL".join(one.format(name=x.name, re=x.plain) for x in pii.PROPOSALS.values())


def _pii_kinds() -> str:
    """A row for each kind: its place, proposal, score and context words."""
    words = lambda w: f"(?:^|[^a-z0-9])(?:{'|'.join(w)})(?:[^a-z0-9]|$)" if w else "^\\b$"
    rows = (
        f"({i}, '{k.name}', '{k.proposal}', {k.score}, '{words(k.words)}', '{words(k.against)}', {str(k.required).lower()})"
        for i, k in enumerate(pii.KINDS)
    )
    return ",\n  ".join(rows)


OP12_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), matches AS ({_pii_matches()}
), steps AS (
  SELECT r, p, i, m[i] AS match, g[i] AS gap, g[i + 1] AS following
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matches)
), placed AS (
  SELECT r, p, match, right(gap, 40) AS before, left(following, 40) AS after,
         regexp_replace(match, '[^0-9]', '', 'g') AS digits, replace(match, ' ', '') AS bare,
         CAST(sum(length(gap) + length(match)) OVER (PARTITION BY r, p ORDER BY i) - length(match) AS BIGINT) AS start
  FROM steps
), checked AS (
  SELECT *, lower(before || ' ' || after) AS near,
    NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AS alone,
    list_sum(list_transform(regexp_extract_all(reverse(digits), '.'), lambda c, i:
      CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN 2 * CAST(c AS INT) - 9 ELSE 2 * CAST(c AS INT) END)) % 10 = 0 AS luhn,
    list_reduce(list_prepend(0, list_transform(regexp_extract_all(bare[5:] || bare[1:4], '.'), lambda c: CAST(ascii(c) AS INT))), lambda a, c:
      CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) = 1 AS mod97,
    len(list_filter(string_split(match, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(x AS BIGINT), 0) > 255)) = 0 AS parts
  FROM placed
), kinds(place, kind, p, score, words, against, required) AS (
  VALUES {_pii_kinds()}
), spans AS (
  SELECT r, place, required, kind, start, concat_ws(':', kind, start, start + length(match)) AS span,
         score + CASE WHEN regexp_matches(near, words) THEN 0.3 ELSE 0 END
               - CASE WHEN regexp_matches(near, against) THEN 0.3 ELSE 0 END AS points
  FROM checked JOIN kinds USING (p)
  WHERE CASE kind WHEN 'email' THEN true
                  WHEN 'ip' THEN parts
                  WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND luhn
                  WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
                  WHEN 'iban' THEN alone AND length(bare) BETWEEN 15 AND 34 AND mod97
                  WHEN 'short_card' THEN alone AND length(digits) BETWEEN 13 AND 15 AND luhn
                  ELSE alone AND regexp_matches(match, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$')
                       AND NOT regexp_matches(match, '^(000|666|9)|-00-|-0000$') END
), kept AS (
  SELECT r, count_if(kind = 'email') AS n_email, count_if(kind = 'ip') AS n_ip, count_if(kind = 'card') AS n_card,
         count_if(kind = 'phone') AS n_phone, string_agg(span, ',' ORDER BY place, start) FILTER (required) AS base,
         string_agg(span, ',' ORDER BY place, start) AS spans
  FROM spans WHERE required OR points >= 0.499 GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip,
       CAST(coalesce(n_card, 0) AS BIGINT) AS n_card, CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN kept USING (r)
"""


def op13_conversation_trie(spark: SparkSession, base: str) -> DataFrame:
    turns = prefixes.turns_of(read_table(spark, base, "conversations"))
    return prefixes.trie(prefixes.rebuilt(turns))


OP13_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), named AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(regexp_extract_all(CAST(conv_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))
    )) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT n.conv_id, 0 AS part, i, role, text FROM named n JOIN turns t ON t.conv_id = n.base AND i <= h
  UNION ALL
  SELECT n.conv_id, 1, i, role, text FROM named n JOIN turns t USING (conv_id) WHERE i > h
), keyed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d, length(text) AS chars,
         md5(length(role) || ':' || role || text) AS key
  FROM rebuilt
), members AS (
  SELECT conv_id, d, chars, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM keyed
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM named
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars, left(path, 32 * (d - 1)) AS above
  FROM members GROUP BY path, d
), children AS (
  SELECT above AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY above
), spread AS (
  SELECT left(nodes.path, 32 * unnest(range(d + 1))) AS path, children.n IS NULL AS leaf, (nodes.n - 1) * chars AS saved
  FROM nodes LEFT JOIN children USING (path)
), subtrees AS (
  SELECT path, count_if(leaf) AS leaves, sum(saved) AS saved FROM spread GROUP BY path
), ends AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, d) AS path FROM members GROUP BY conv_id) GROUP BY path
)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes x JOIN subtrees s USING (path)
LEFT JOIN nodes p ON x.d > 0 AND p.path = x.above
LEFT JOIN children c ON c.path = x.path
LEFT JOIN ends e ON e.path = x.path
"""


RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_exact_top_k,
        op3_byte_bpe,
        op4_best_fit_packing,
        op5_toxicity_lexicon,
        op6_quality_divergence,
        op7_pitman_yor_scores,
        op8_repeated_phrases,
        op9_simhash_golay,
        op10_url_filter,
        op11_embedding_whitening,
        op12_personal_data,
        op13_conversation_trie,
    )
}

ORACLES = {"op2_exact_top_k": OP2_SQL, "op6_quality_divergence": OP6_SQL, "op10_url_filter": OP10_SQL, "op12_personal_data": OP12_SQL, "op13_conversation_trie": OP13_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(RUNNERS)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
