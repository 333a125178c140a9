"""Vectors (V) and matrices (M), on the embeddings.

Vector results are returned in long form ``(vec_id, pos, x)``: one row per element.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import matrices as M
from millrace.functions import vectors as V
from millrace.ml import cluster
from millrace.plans import inputs as I
from millrace.plans.registry import query
from millrace.session import read_table

# The two halves of each embedding serve as a pair of vectors.
HALVES_SQL = """halves AS (SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos,
    CAST(embedding[p] AS DOUBLE) AS a, CAST(embedding[p + 32] AS DOUBLE) AS b
    FROM embeddings, range(1, 33) r(p)) """
ELEMENTS_SQL = """elements AS (SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos,
    CAST(embedding[p] AS DOUBLE) AS x FROM embeddings, range(1, 65) r(p)) """


def _halves(spark, base):
    return I.vec(spark, base).select(
        "vec_id", F.slice("v", 1, 32).alias("a"), F.slice("v", 33, 32).alias("b")
    )


def _long(df, **vectors):
    """Named vectors of equal length as one row per element."""
    zipped = F.arrays_zip(*[c.alias(n) for n, c in vectors.items()])
    return df.select("vec_id", F.posexplode(zipped).alias("pos", "e")).select(
        "vec_id", "pos", *[F.col(f"e.{n}").alias(n) for n in vectors]
    )


def _ab():
    return F.col("a"), F.col("b")


@query(
    "v01_vec_elementwise",
    f"WITH {HALVES_SQL} SELECT vec_id, pos, round(a + b, 8) AS plus, round(a * b, 8) AS times, "
    "round(a / b, 4) AS ratio, a < b AS below, a = b AS same FROM halves",
)
def vec_elementwise(spark, base):
    df = _halves(spark, base).select(
        "vec_id",
        V.add(*_ab()).alias("plus"),
        V.multiply(*_ab()).alias("times"),
        V.divide(*_ab()).alias("ratio"),
        V.less(*_ab()).alias("below"),
        V.equal(*_ab()).alias("same"),
    )
    long = _long(df, **{n: F.col(n) for n in ("plus", "times", "ratio", "below", "same")})
    return long.withColumns(
        {"plus": F.round("plus", 8), "times": F.round("times", 8), "ratio": F.round("ratio", 4)}
    )


@query(
    "v02_vec_scalar_op",
    f"WITH {ELEMENTS_SQL} SELECT vec_id, pos, round((x + 1.0) * 2.0, 8) AS x FROM elements",
)
def vec_scalar_op(spark, base):
    df = I.vec(spark, base).select("vec_id", V.scale(V.add_scalar(F.col("v"), 1.0), 2.0).alias("x"))
    return _long(df, x=F.col("x")).withColumn("x", F.round("x", 8))


@query(
    "v03_vec_dot",
    f"WITH {HALVES_SQL} SELECT vec_id, round(sum(a * b), 8) AS dot FROM halves GROUP BY vec_id",
)
def vec_dot(spark, base):
    return _halves(spark, base).select("vec_id", F.round(V.dot(*_ab()), 8).alias("dot"))


@query(
    "v04_vec_cosine",
    f"WITH {HALVES_SQL} SELECT vec_id, round(sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))), 8) "
    "AS cosine FROM halves GROUP BY vec_id",
)
def vec_cosine(spark, base):
    return _halves(spark, base).select("vec_id", F.round(V.cosine(*_ab()), 8).alias("cosine"))


@query(
    "v05_vec_sq_distance",
    f"WITH {HALVES_SQL} SELECT vec_id, round(sum((a - b) * (a - b)), 8) AS distance "
    "FROM halves GROUP BY vec_id",
)
def vec_sq_distance(spark, base):
    return _halves(spark, base).select(
        "vec_id", F.round(V.squared_distance(*_ab()), 8).alias("distance")
    )


@query(
    "v06_vec_sum_cumsum",
    f"WITH {ELEMENTS_SQL} SELECT vec_id, pos, round(sum(x) OVER (PARTITION BY vec_id), 8) AS total, "
    "round(sum(x) OVER (PARTITION BY vec_id ORDER BY pos), 8) AS running FROM elements",
)
def vec_sum_cumsum(spark, base):
    df = I.vec(spark, base).select(
        "vec_id", F.posexplode(V.running_sum(F.col("v"))).alias("pos", "running"), V.total(F.col("v")).alias("total")
    )
    return df.select(
        "vec_id", "pos", F.round("running", 8).alias("running"), F.round("total", 8).alias("total")
    )


@query(
    "v07_vec_max_argmax",
    I.with_tables("vec")
    + "SELECT vec_id, list_max(v) AS largest, "
    "CAST(list_position(v, list_max(v)) - 1 AS BIGINT) AS place FROM vec",
)
def vec_max_argmax(spark, base):
    return I.vec(spark, base).select(
        "vec_id", V.largest(F.col("v")).alias("largest"), V.argmax(F.col("v")).alias("place")
    )


@query(
    "v08_vec_bool",
    f"WITH {HALVES_SQL} SELECT vec_id, count(*) FILTER (WHERE a > 0 AND b > 0) AS n_both, "
    "count(*) FILTER (WHERE a > 0 OR b > 0) AS n_either, count(*) FILTER (WHERE NOT a > 0) AS n_not, "
    "bool_or(a <> 0) AS any_a, bool_and(b <> 0) AS all_b FROM halves GROUP BY vec_id",
)
def vec_bool(spark, base):
    def count(flags):
        return F.size(F.filter(flags, lambda x: x)).cast("long")

    positive = [F.transform(c, lambda x: x > 0) for c in _ab()]
    return _halves(spark, base).select(
        "vec_id",
        count(V.both(*positive)).alias("n_both"),
        count(V.either(*positive)).alias("n_either"),
        count(V.negate(positive[0])).alias("n_not"),
        V.any_nonzero(F.col("a")).alias("any_a"),
        V.all_nonzero(F.col("b")).alias("all_b"),
    )


@query(
    "v09_vec_round",
    f"WITH {ELEMENTS_SQL} SELECT vec_id, pos, round(x * 10) + 0.0 AS nearest, ceil(x * 10) + 0.0 AS up, "
    "floor(x * 10) + 0.0 AS down, CAST(sign(x) AS DOUBLE) AS sign, abs(x) AS size FROM elements",
)
def vec_round(spark, base):
    tens = V.scale(F.col("v"), 10.0)
    df = I.vec(spark, base)
    return _long(
        df.select(
            "vec_id",
            V.rounded(tens).alias("nearest"),
            V.ceiling(tens).alias("up"),
            V.floored(tens).alias("down"),
            V.sign(F.col("v")).alias("sign"),
            V.absolute(F.col("v")).alias("size"),
        ),
        **{n: F.col(n) for n in ("nearest", "up", "down", "sign", "size")},
    )


@query(
    "v10_vec_slice",
    I.with_tables("vec")
    + "SELECT vec_id, v[1] AS first, v[64] AS last, round(list_sum(v[2:5]), 8) AS part, "
    "v[6] AS back_first, v[1] AS back_last, 63 AS n_rest FROM vec",
)
def vec_slice(spark, base):
    back = V.span(F.col("v"), 5, 0)
    return I.vec(spark, base).select(
        "vec_id",
        V.element(F.col("v"), 0).alias("first"),
        V.element(F.col("v"), -1).alias("last"),
        F.round(V.total(V.span(F.col("v"), 1, 4)), 8).alias("part"),
        V.element(back, 0).alias("back_first"),
        V.element(back, -1).alias("back_last"),
        F.size(V.span(F.col("v"), 1, -1)).alias("n_rest"),
    )


@query(
    "v11_vec_assign",
    f"WITH {ELEMENTS_SQL} SELECT vec_id, pos, CASE WHEN pos BETWEEN 1 AND 4 THEN 5.0 ELSE x END AS fixed, "
    "CASE WHEN pos BETWEEN 1 AND 4 THEN lead(x, 59) OVER (PARTITION BY vec_id ORDER BY pos) ELSE x END "
    "AS copied FROM elements",
)
def vec_assign(spark, base):
    df = I.vec(spark, base).select(
        "vec_id",
        V.assign(F.col("v"), 1, 4, 5.0).alias("fixed"),
        V.assign(F.col("v"), 1, 4, V.span(F.col("v"), 60, 63)).alias("copied"),
    )
    return _long(df, fixed=F.col("fixed"), copied=F.col("copied"))


@query(
    "v12_vec_concat",
    f"WITH {HALVES_SQL} SELECT vec_id, CAST(pos + 32 AS INTEGER) AS pos, a AS x FROM halves "
    "UNION ALL SELECT vec_id, pos, b FROM halves",
)
def vec_concat(spark, base):
    df = _halves(spark, base).select("vec_id", V.joined(F.col("b"), F.col("a")).alias("x"))
    return _long(df, x=F.col("x"))


def _entries(spark, base):
    return M.to_entries(read_table(spark, base, "embeddings"), "vec_id", "embedding")


def _pair(spark, base):
    """The two halves of the matrix as two matrices of equal shape."""
    entries = _entries(spark, base)
    right = entries.filter("j >= 32").withColumn("j", F.col("j") - 32)
    return entries.filter("j < 32"), right


PAIR_SQL = """, lft AS (SELECT * FROM entries WHERE j < 32),
    rgt AS (SELECT i, j - 32 AS j, v FROM entries WHERE j >= 32) """


@query("m01_mat_transpose", I.with_tables("entries") + "SELECT j AS i, i AS j, v FROM entries")
def mat_transpose(spark, base):
    return M.transpose(_entries(spark, base))


@query(
    "m02_mat_axis_sum",
    I.with_tables("entries")
    + "SELECT 'all' AS axis, -1 AS idx, round(sum(v), 6) AS total FROM entries UNION ALL "
    "SELECT 'column', j, round(sum(v), 6) FROM entries GROUP BY j UNION ALL "
    "SELECT 'row', i, round(sum(v), 6) FROM entries GROUP BY i",
)
def mat_axis_sum(spark, base):
    entries = _entries(spark, base)

    def named(axis, key):
        index = F.lit(-1).cast("long") if key is None else F.col(key)
        return M.axis_sum(entries, key).select(
            F.lit(axis).alias("axis"), index.alias("idx"), F.round("total", 6).alias("total")
        )

    return named("all", None).unionByName(named("column", "j")).unionByName(named("row", "i"))


@query(
    "m03_mat_trace_diag",
    I.with_tables("entries")
    + "SELECT 'trace' AS kind, 0 AS i, round(sum(embedding[vec_id + 1]::DOUBLE), 8) AS v FROM embeddings "
    "WHERE vec_id < 64 UNION ALL "
    "SELECT 'diag', vec_id, embedding[vec_id + 1]::DOUBLE FROM embeddings WHERE vec_id < 64 UNION ALL "
    "SELECT 'eye', vec_id, 1.0 FROM embeddings UNION ALL "
    "SELECT 'label', vec_id, label FROM embeddings",
)
def mat_trace_diag(spark, base):
    entries = _entries(spark, base)
    labels = M.diagonal_matrix(read_table(spark, base, "embeddings"), "vec_id", "label")

    def named(kind, df):
        return df.select(F.lit(kind).alias("kind"), "i", "v")

    trace = M.trace(entries).select(
        F.lit(0).cast("long").alias("i"), F.round("trace", 8).alias("v")
    )
    return (
        named("trace", trace)
        .unionByName(named("diag", M.diagonal(entries)))
        .unionByName(named("eye", M.identity_like(entries)))
        .unionByName(named("label", M.diagonal(labels)))
    )


@query(
    "m04_mat_triangular",
    I.with_tables("entries")
    + "SELECT 'lower' AS kind, * FROM entries WHERE i >= j UNION ALL "
    "SELECT 'upper', * FROM entries WHERE i <= j",
)
def mat_triangular(spark, base):
    entries = _entries(spark, base)
    lower = M.lower_triangle(entries).withColumn("kind", F.lit("lower"))
    return lower.unionByName(M.upper_triangle(entries).withColumn("kind", F.lit("upper")))


@query(
    "m05_mat_multiply",
    I.with_tables("entries")
    + """, centre AS (SELECT j AS i, CAST(label AS BIGINT) AS j, avg(v) AS v
              FROM entries JOIN embeddings ON vec_id = i GROUP BY j, label)
         SELECT e.i AS vec_id, CAST(c.j AS INTEGER) AS pos, round(sum(e.v * c.v), 6) AS x
         FROM entries e JOIN centre c ON e.j = c.i GROUP BY e.i, c.j""",
)
def mat_multiply(spark, base):
    rows = I.vec(spark, base)
    # One column per label: the mean vector of its rows.
    centres = M.transpose(M.to_entries(cluster.group_centres(rows, "label", "v"), "label", "centre"))
    product = M.multiply_rows(rows.select("vec_id", "v"), "v", centres, "x", (64, 10))
    return _long(product, x=F.col("x")).withColumn("x", F.round("x", 6))


@query(
    "m05_mat_multiply_long",
    I.with_tables("entries")
    + """, t AS (SELECT label AS i, j, sum(v) AS v FROM entries JOIN embeddings ON vec_id = i
              GROUP BY label, j)
         SELECT CAST(a.i AS BIGINT) AS i, CAST(b.i AS BIGINT) AS j, round(sum(a.v * b.v), 5) AS v
         FROM t a JOIN t b ON a.j = b.j GROUP BY a.i, b.i""",
)
def mat_multiply_long(spark, base):
    sums = (
        I.vec(spark, base)
        .select(F.col("label").cast("long").alias("i"), F.posexplode("v").alias("j", "v"))
        .groupBy("i", F.col("j").cast("long").alias("j"))
        .agg(F.sum("v").alias("v"))
    )
    return M.multiply(sums, M.transpose(sums)).withColumn("v", F.round("v", 5))


# Both halves of every row side by side: one pass, where a join of the halves' entries may be planned as a product.
HALVES_SQL = """(SELECT vec_id AS i, CAST(p - 1 AS BIGINT) AS j, CAST(embedding[p] AS DOUBLE) AS a,
        CAST(embedding[p + 32] AS DOUBLE) AS b FROM (SELECT vec_id, embedding, unnest(range(1, 33)) AS p FROM embeddings)) halves"""


@query(
    "m06_mat_elementwise",
    f"""SELECT i, j, round(a + b, 8) AS plus,
        CASE WHEN i BETWEEN 1 AND 2 AND j BETWEEN 1 AND 2 THEN 5.0 ELSE round(a * b, 8) END AS patched FROM {HALVES_SQL}""",
)
def mat_elementwise(spark, base):
    left, right = _pair(spark, base)
    both = M.elementwise(left, right, lambda a, b: F.struct((a + b).alias("s"), (a * b).alias("p")))
    plus = F.round("v.s", 8).alias("plus")
    product = both.select("i", "j", plus, F.round("v.p", 8).alias("v"))
    return M.assign_block(product, (1, 2), (1, 2), 5.0).withColumnRenamed("v", "patched")


@query(
    "m05_mat_multiply_sparse",
    I.with_tables("entries")
    + """, centre AS (SELECT j AS i, CAST(label AS BIGINT) AS j, avg(v) AS v
              FROM entries JOIN embeddings ON vec_id = i WHERE j < 40 AND label <> 3 GROUP BY j, label)
         SELECT vec_id, CAST(p.j AS INTEGER) AS pos, round(coalesce(x, 0), 6) AS x
         FROM embeddings CROSS JOIN range(10) p(j) LEFT JOIN
         (SELECT e.i, c.j, sum(e.v * c.v) AS x FROM entries e JOIN centre c ON e.j = c.i GROUP BY e.i, c.j) m
         ON m.i = vec_id AND m.j = p.j""",
)
def mat_multiply_sparse(spark, base):
    """The right matrix stores neither its last 24 rows nor its column 3."""
    rows = I.vec(spark, base)
    centres = M.transpose(M.to_entries(cluster.group_centres(rows, "label", "v"), "label", "centre"))
    stored = centres.filter("i < 40 and j <> 3")
    product = M.multiply_rows(rows.select("vec_id", "v"), "v", stored, "x", (64, 10))
    return _long(product, x=F.col("x")).withColumn("x", F.round("x", 6) + 0.0)


LINES_SQL = """a AS (SELECT l_orderkey AS i, l_partkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
        b AS (SELECT l_partkey AS k, l_suppkey AS j, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY ALL)"""


@query(
    "m05_mat_multiply_tiles",
    f"""WITH {LINES_SQL}, product AS (SELECT i, j, sum(a.v * b.v) AS v FROM a JOIN b USING (k) GROUP BY i, j)
        SELECT j, count(*) AS n, CAST(sum(v) AS DOUBLE) AS total, CAST(max(v) AS DOUBLE) AS largest FROM product GROUP BY j""",
)
def mat_multiply_tiles(spark, base):
    """Orders by parts times parts by suppliers: neither matrix, nor their product, is small."""
    lines = read_table(spark, base, "lineitem")
    ordered = lines.select(F.col("l_orderkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_quantity").cast("double").alias("v"))
    supplied = lines.select(F.col("l_partkey").alias("i"), F.col("l_suppkey").alias("j"), F.lit(1.0).alias("v"))
    product = M.multiply_tiles(ordered, supplied)
    return product.groupBy("j").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.max("v").alias("largest"))


@query(
    "m06_mat_elementwise_sparse",
    f"""SELECT i, j, round(l + r, 8) AS plus, round(l - r, 8) AS minus FROM
        (SELECT i, j, CASE WHEN i >= j THEN a ELSE 0 END AS l, CASE WHEN i <= j THEN b ELSE 0 END AS r FROM {HALVES_SQL})""",
)
def mat_elementwise_sparse(spark, base):
    """A lower and an upper triangle: most places are stored on one side only."""
    left, right = _pair(spark, base)
    both = M.elementwise(
        M.lower_triangle(left), M.upper_triangle(right), lambda a, b: F.struct((a + b).alias("p"), (a - b).alias("m"))
    )
    return both.select("i", "j", F.round("v.p", 8).alias("plus"), F.round("v.m", 8).alias("minus"))


@query(
    "m07_mat_concat",
    I.with_tables("entries") + PAIR_SQL
    + """SELECT 'stacked' AS kind, * FROM lft UNION ALL
         SELECT 'stacked', i + (SELECT max(vec_id) + 1 FROM embeddings), j, v FROM rgt UNION ALL
         SELECT 'beside', * FROM lft UNION ALL
         SELECT 'beside', i, j + 32, v FROM rgt""",
)
def mat_concat(spark, base):
    left, right = _pair(spark, base)
    height = read_table(spark, base, "embeddings").agg(F.max("vec_id") + 1).scalar()
    stacked = M.stack(left, right, height).withColumn("kind", F.lit("stacked"))
    return stacked.unionByName(M.beside(left, right, 32).withColumn("kind", F.lit("beside")))


@query(
    "m08_mat_gram",
    I.with_tables("entries")
    + "SELECT a.j AS i, b.j, round(sum(a.v * b.v), 6) AS v FROM entries a "
    "JOIN entries b ON a.i = b.i GROUP BY a.j, b.j",
)
def mat_gram(spark, base):
    gram = M.gram(read_table(spark, base, "embeddings"), "embedding")
    return gram.withColumn("v", F.round("v", 6))


@query(
    "m09_mat_approx_equal",
    I.with_tables("entries") + PAIR_SQL
    + """SELECT 'negated' AS kind, true AS equal, count(*) AS n_equal FROM entries UNION ALL
         SELECT 'halves', bool_and(abs(abs(lft.v) - abs(rgt.v)) <= 1e-6),
                count(*) FILTER (WHERE abs(abs(lft.v) - abs(rgt.v)) <= 1e-6)
         FROM lft JOIN rgt ON lft.i = rgt.i AND lft.j = rgt.j""",
)
def mat_approx_equal(spark, base):
    entries = _entries(spark, base)
    negated = entries.withColumn("v", -F.col("v"))
    same = M.approx_equal(entries, negated).withColumn("kind", F.lit("negated"))
    return same.unionByName(
        M.approx_equal(*_pair(spark, base)).withColumn("kind", F.lit("halves"))
    )
