"""Operators on small hand-made tables with worked-out answers."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import matrices as M
from millrace.functions import scalars as S
from millrace.functions import udfs as U
from millrace.functions import vectors as V
from millrace.ml import classify, metrics
from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.operators import sampling as X
from millrace.operators import setops as D
from millrace.operators import topn as W
from millrace.operators import transforms as P
from millrace.reports import clicks, news, sales, staff

# Small input tables with known answers.
SCORES = [("class1", 89), ("class1", 99), ("class1", 90), ("class1", 10), ("class1", 1),
          ("class2", 100), ("class2", 99), ("class2", 2), ("class2", 3)]
EMPLOYEES = [
    ("Leo", 25, 1, "male", 20000), ("Marry", 30, 2, "female", 25000),
    ("Jack", 35, 1, "male", 15000), ("Tom", 42, 3, "male", 18000),
    ("Kattie", 21, 3, "female", 21000), ("Jen", 30, 2, "female", 28000),
    ("James", 19, 2, "female", 8000), ("James", 19, 2, "female", 8000),
]
SALES = [
    ("Thin", "Cell Phone", 6000), ("Normal", "Tablet", 1500), ("Mini", "Tablet", 5500),
    ("UltraThin", "Cell Phone", 6000), ("VeryThin", "Cell Phone", 6000), ("Big", "Tablet", 2500),
    ("Bendable", "Cell Phone", 3000), ("Foldable", "Cell Phone", 3000), ("Pro", "Tablet", 4500),
    ("Pro2", "Tablet", 6500),
]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, "grp string, score int")


@pytest.fixture(scope="module")
def staff_tables(spark):
    employee = spark.createDataFrame(
        EMPLOYEES, "name string, age long, dep_id long, gender string, salary long"
    )
    department = spark.createDataFrame(
        [(1, "Technical"), (2, "Financial"), (3, "HR")], "id long, dep_name string"
    )
    return employee, department


def test_word_count_drops_empty_tokens(spark, collected):
    lines = spark.createDataFrame([("class1 89",), (" class1  99 ",), ("",)], "line string")
    assert collected(A.word_count(lines, "line")) == [("89", 1), ("99", 1), ("class1", 2)]


def test_group_topn_array_keeps_duplicates_and_short_groups(scores, spark, collected):
    more = scores.union(spark.createDataFrame([("class3", 7), ("class2", 100)], scores.schema))
    assert collected(W.group_topn_array(more, "grp", "score", 3)) == [
        ("class1", [99, 90, 89]), ("class2", [100, 100, 99]), ("class3", [7])
    ]


def test_global_topn_and_secondary_sort(spark):
    numbers = spark.createDataFrame([(n,) for n in (1, 34, 4, 5, 22, 9, 12, 7)], "n int")
    assert [r.n for r in W.global_topn(numbers, [F.desc("n")], 3).collect()] == [34, 22, 12]
    pairs = [(1, 5), (2, 3), (5, 4), (3, 2), (2, 1), (3, 1), (2, 2), (3, 3)]
    df = spark.createDataFrame(pairs, "a int, b int").repartition(3)
    assert [tuple(r) for r in W.secondary_sort(df, "a", "b").collect()] == sorted(pairs)


def test_combine_by_key(spark, collected):
    pairs = spark.createDataFrame(
        [(1, 1.0), (1, 2.0), (1, 3.0), (2, 4.0), (2, 5.0), (2, 6.0)], "k int, v double"
    )
    assert collected(A.combine_by_key_avg(pairs, "k", "v")) == [(1, 6.0, 3, 2.0), (2, 15.0, 3, 5.0)]


def test_department_stats(staff_tables, collected):
    assert collected(staff.department_stats(*staff_tables)) == [
        ("Financial", "female", 26500.0, 30.0), ("HR", "female", 21000.0, 21.0),
        ("HR", "male", 18000.0, 42.0), ("Technical", "male", 17500.0, 30.0),
    ]


def test_basic_aggregates(staff_tables, collected):
    employee, department = staff_tables
    joined = J.join_inner(employee, department, employee.dep_id == department.id)
    assert collected(A.basic_aggregates(joined, "dep_name", "salary", "name")) == [
        ("Financial", 17250.0, 69000, 28000, 8000, 4, 3),
        ("HR", 19500.0, 39000, 21000, 18000, 2, 2),
        ("Technical", 17500.0, 35000, 20000, 15000, 2, 2),
    ]


def test_group_values_list_and_set(staff_tables, collected):
    employee, _ = staff_tables
    numbered = employee.withColumn("id", F.monotonically_increasing_id())
    lists = A.group_values(numbered, "dep_id", "name", "id", parts=1)
    assert collected(lists.select("dep_id", "values")) == [
        (1, ["Jack", "Leo"]), (2, ["James", "James", "Jen", "Marry"]), (3, ["Kattie", "Tom"])
    ]
    sets = A.group_values(numbered, "dep_id", "name", "id", distinct=True, parts=1)
    assert collected(sets.select("dep_id", "values"))[1] == (2, ["James", "Jen", "Marry"])


def test_set_operations(staff_tables, collected):
    employee, _ = staff_tables
    second = employee.filter("name in ('Leo', 'Marry')")
    names = [r[0] for r in collected(D.except_distinct(employee, second))]
    assert names == ["Jack", "James", "Jen", "Kattie", "Tom"]
    assert [r[0] for r in collected(D.intersect_distinct(employee, second))] == ["Leo", "Marry"]
    assert D.distinct_rows(employee).count() == 7
    assert D.drop_duplicates_by(employee, ["name"], ["age"]).count() == 7


def test_except_union_intersect_make_up_distinct(spark, collected):
    a = spark.createDataFrame([(i % 7, None if i % 5 == 0 else i % 3) for i in range(60)], "x int, y int")
    b = spark.createDataFrame([(i % 5, None if i % 4 == 0 else i % 2) for i in range(40)], "x int, y int")
    parts = D.union_rows(D.except_distinct(a, b), D.intersect_distinct(a, b))
    assert collected(parts) == collected(D.distinct_rows(a))


def test_filters(spark, collected):
    people = spark.createDataFrame([(None, "Orla"), (44, "Pavel"), (17, "Quim")], "age long, name string")
    assert collected(P.filter_between(people, "age", 13, 19)) == [(17, "Quim")]
    assert [r.name for r in P.filter_null(people, "age").collect()] == ["Orla"]
    assert [r.name for r in P.filter_null(people, "age", is_null=False, name="Pavel").collect()] == ["Pavel"]
    quoted = P.filter_conjunction(people, name="x' OR '1'='1")
    assert quoted.count() == 0


def test_row_formatting_and_flat_map(spark, collected):
    src = spark.createDataFrame([(0, "val_0"), (2, "val_2")], "key int, value string")
    assert [r.line for r in P.map_format_row(src, "Key: {key}, Value: {value}").collect()] == [
        "Key: 0, Value: val_0", "Key: 2, Value: val_2"
    ]
    tokens = P.explode_words(src.withColumn("text", F.lit("a  b ")), "text", "key")
    assert collected(tokens) == [(0, "a"), (0, "b"), (2, "a"), (2, "b")]
    twice = P.flat_map(src, F.array(F.lit(1), F.lit(2)), "n", "key")
    assert collected(twice) == [(0, 1), (0, 2), (2, 1), (2, 2)]


def test_partition_numbers(spark):
    names = ["zhangsan", "lisi", "wangwu", "zhaoliu"]
    two = spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)
    tagged = P.map_partitions_with_index(two.repartitionByRange(2, "name"))
    assert {r.partition_no for r in tagged.collect()} == {1, 2}
    assert tagged.count() == 4


def test_as_typed_rejects_missing_fields(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    typed = P.cast_to_schema(df, T.StructType([T.StructField("b", T.IntegerType())]))
    assert typed.collect()[0].b == 2
    with pytest.raises(ValueError, match="missing"):
        P.cast_to_schema(df, T.StructType([T.StructField("c", T.IntegerType())]))


def test_clean_number(spark):
    raw = spark.createDataFrame([('"?"',), ('"-3.5"',), ("4",), ("junk",)], "raw string")
    got = raw.select(P.clean_number(F.col("raw")), P.clean_number(F.col("raw"), non_negative=True))
    assert [tuple(r) for r in got.collect()] == [(0.0, 0.0), (-3.5, 0.0), (4.0, 4.0), (0.0, 0.0)]


def test_decode_flags(spark):
    codes = spark.createDataFrame([(0, "Action"), (1, "Comedy"), (2, "Drama")], "idx int, genre string")
    items = spark.createDataFrame([(1, [1, 0, 1]), (2, [0, 0, 0])], "id int, flags array<int>")
    decoded = P.decode_flags(items, "flags", codes, "idx", "genre", "names").orderBy("id")
    assert [r.names for r in decoded.collect()] == [["Action", "Drama"], []]


def test_semi_anti_outer_struct_joins(spark, collected):
    infos = spark.createDataFrame([("leo", 18), ("marry", 17), ("jack", 22)], "name string, age int")
    scores = spark.createDataFrame([("leo", 88), ("marry", 99), ("marry", 99), ("jack", 74)], "name string, score int")
    good = scores.filter("score >= 80")
    assert collected(J.join_semi(infos, good, "name")) == [("leo", 18), ("marry", 17)]
    assert collected(staff.good_students(infos, scores.distinct(), 80)) == [("leo", 18, 88), ("marry", 17, 99)]
    flags = spark.createDataFrame([("leo", True), ("jack", False), ("x", None)], "name string, flag boolean")
    assert collected(J.join_anti_flagged(infos, flags, "name")) == [("jack", 22), ("marry", 17)]
    outer = J.join_outer_default(infos, flags, "name", {"flag": False})
    assert collected(outer.select("name", "flag")) == [("jack", False), ("leo", True), ("marry", False)]
    both = J.join_struct(infos, scores.distinct(), F.col("l.name") == F.col("r.name"))
    assert both.count() == 3 and set(both.columns) == {"l", "r"}


def test_join_code_table_is_the_same_beyond_the_bound(spark, collected):
    """The optimiser's bound, in bytes: at -1 nothing is shipped."""
    facts = spark.range(50).withColumn("k", F.col("id") % 5)
    codes = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "k long, name string")
    small = collected(J.join_code_table(facts, codes, "k"))
    bound = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(bound)
    spark.conf.set(bound, "-1")
    try:
        assert collected(J.join_code_table(facts, codes, "k")) == small
    finally:
        spark.conf.set(bound, before)
    assert small == sorted((i % 5, i, f"c{i % 5}") for i in range(50))


def test_top_products_break_ties_by_name(spark, collected):
    df = spark.createDataFrame(SALES, "product string, category string, revenue long")
    top = sales.top_products(df)
    assert collected(top.select("category", "rank", "product", "revenue")) == [
        ("Cell Phone", 1, "Thin", 6000), ("Cell Phone", 2, "UltraThin", 6000),
        ("Cell Phone", 3, "VeryThin", 6000), ("Tablet", 1, "Pro2", 6500),
        ("Tablet", 2, "Mini", 5500), ("Tablet", 3, "Pro", 4500),
    ]


def test_news_reports(spark, collected):
    log = spark.createDataFrame(
        [
            ("2017-06-15", 1, 10, "a", "view"), ("2017-06-15", 1, 10, "a", "view"),
            ("2017-06-15", 2, 10, "a", "view"), ("2017-06-15", None, 10, "a", "view"),
            ("2017-06-15", None, 10, "a", "view"), ("2017-06-15", 5, None, None, "register"),
            ("2017-06-16", 3, 11, "b", "view"),
        ],
        "date string, user_id long, page_id long, section string, action string",
    ).withColumn("date", F.to_date("date"))
    day = "2017-06-15"
    assert [r.pv for r in news.daily_page_pv(log, day).collect()] == [5]
    assert [r.uv for r in news.daily_page_uv(log, day).collect()] == [3]
    assert [r.uv for r in news.daily_page_uv(log, day, count_null=False).collect()] == [2]
    assert [tuple(r)[1:] for r in news.register_rate(log, day).collect()] == [(1, 2, 0.5)]
    assert [tuple(r)[1:] for r in news.jump_rate(log, day).collect()] == [(1, 3, 0.33)]
    no_views = news.register_rate(log, "2017-06-16").collect()
    assert no_views[0].rate is None
    assert [r.uv for r in news.daily_uv(log).orderBy("date").collect()] == [3, 1]
    for pv, uv in zip(news.daily_page_pv(log).collect(), news.daily_page_uv(log).collect()):
        assert uv.uv <= pv.pv


def test_udfs(spark, collected):
    names = spark.createDataFrame(
        [(n,) for n in ("zhangsan", "zhangsan", "Tom", "Tom", "lisi", "wangwu", "Jerry")], "name string"
    )
    counts = names.groupBy("name").agg(U.row_count().alias("n"))
    assert dict(collected(counts)) == {"Jerry": 1, "Tom": 2, "lisi": 1, "wangwu": 1, "zhangsan": 2}
    U.register_strlen(spark)
    lengths = spark.sql("SELECT DISTINCT name, strlen(name) AS n FROM {names}", names=names)
    assert dict(collected(lengths)) == {"Jerry": 5, "Tom": 3, "lisi": 4, "wangwu": 6, "zhangsan": 8}


def test_row_count_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    assert df.groupBy("k").agg(U.row_count().alias("n")).collect()[0].n == 2


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], [1.0] * 4, [1.0, 0.0, -2.0], [1.2, 0.6, -2.3])],
                               "a array<double>, b array<double>, z array<double>, r array<double>")
    a, b, z, r = (F.col(c) for c in "abzr")
    row = df.select(
        V.dot(a, b).alias("dot"), V.running_sum(a).alias("run"), V.any_nonzero(z).alias("any"),
        V.all_nonzero(z).alias("all"), V.rounded(r).alias("round"), V.ceiling(r).alias("ceil"),
        V.floored(r).alias("floor"), V.sign(r).alias("sign"), V.absolute(r).alias("abs"),
        V.argmax(a).alias("argmax"), V.span(a, 2, 0).alias("back"), V.span(a, 1, -1).alias("rest"),
        V.assign(a, 1, 2, b).alias("assigned"), V.divide(a, F.transform(z, lambda x: x)).alias("ratio"),
        V.cosine(a, F.transform(b, lambda x: x * 0)).alias("none"),
    ).first()
    assert row["dot"] == 10 and row["run"] == [1, 3, 6, 10]
    assert row["any"] and not row["all"]
    assert row["round"] == [1, 1, -2] and row["ceil"] == [2, 1, -2] and row["floor"] == [1, 0, -3]
    assert row["sign"] == [1, 1, -1] and row["abs"] == [1.2, 0.6, 2.3]
    assert row["argmax"] == 3 and row["back"] == [3, 2, 1] and row["rest"] == [2, 3, 4]
    assert row["assigned"] == [1, 1, 1, 4] and row["ratio"][1] is None and row["none"] is None


@pytest.fixture(scope="module")
def square(spark):
    return spark.createDataFrame([(i, j, float(3 * i + j + 1)) for i in range(3) for j in range(3)],
                                 "i long, j long, v double")


def test_matrix_sums_and_parts(square, collected):
    assert M.axis_sum(square).first()[0] == 45
    assert collected(M.axis_sum(square, "j")) == [(0, 12.0), (1, 15.0), (2, 18.0)]
    assert collected(M.axis_sum(square, "i")) == [(0, 6.0), (1, 15.0), (2, 24.0)]
    assert M.trace(square).first()[0] == 15
    assert M.lower_triangle(square).count() == M.upper_triangle(square).count() == 6
    assert collected(M.column(square, 1)) == [(0, 2.0), (1, 5.0), (2, 8.0)]
    assert collected(M.identity_like(square)) == [(i, i, 1.0) for i in range(3)]


def test_matrix_products_agree(spark, square, collected):
    expected = sorted(
        (i, j, float(sum((3 * i + k + 1) * (3 * k + j + 1) for k in range(3))))
        for i in range(3) for j in range(3)
    )
    assert collected(M.multiply(square, square)) == expected
    rows = spark.createDataFrame([(i, [float(3 * i + j + 1) for j in range(3)]) for i in range(3)],
                                 "i long, x array<double>")
    by_row = M.multiply_rows(rows, "x", square, "y", (3, 3)).select("i", F.posexplode("y").alias("j", "v"))
    assert collected(by_row) == expected
    gram = M.gram(rows, "x")
    assert collected(gram) == collected(M.multiply(M.transpose(square), square))


def test_row_products_treat_unstored_entries_as_zero(spark, collected, monkeypatch):
    rows = spark.createDataFrame([(0, [1.0, 2.0, 3.0, 4.0]), (1, [10.0, 20.0, 30.0, 40.0]), (2, None)], "i long, x array<double>")
    short = spark.createDataFrame([(0, 0, 1.0), (1, 0, 0.5), (1, 0, 0.5)], "i long, j long, v double")
    got = M.multiply_rows(rows, "x", short, "y", (4, 2)).select("i", "y")
    assert collected(got) == [(0, [3.0, 0.0]), (1, [30.0, 0.0]), (2, None)]
    long = collected(M.multiply(M.to_entries(rows.filter("x is not null"), "i", "x"), short))
    assert long == [(0, 0, 3.0), (1, 0, 30.0)]
    with pytest.raises(Exception, match="must have 3 components"):
        M.multiply_rows(rows, "x", short, "y", (3, 2)).collect()
    with pytest.raises(ValueError, match="outside"):
        M.multiply_rows(rows, "x", short, "y", (1, 1))
    monkeypatch.setattr(M, "MOST_CELLS", 7)
    with pytest.raises(ValueError, match="use multiply"):
        M.multiply_rows(rows, "x", short, "y", (4, 2))


def test_elementwise_keeps_entries_of_either_side(spark, square, collected):
    eye = M.identity_like(square)
    total = dict(((i, j), v) for i, j, v in collected(M.elementwise(M.upper_triangle(square), eye, lambda a, b: a + b)))
    assert total == {(i, j): 3.0 * i + j + 1 + (i == j) for i in range(3) for j in range(i, 3)}
    minus = dict(((i, j), v) for i, j, v in collected(M.elementwise(eye, M.lower_triangle(square), lambda a, b: a - b)))
    assert minus == {(i, j): (i == j) - (3.0 * i + j + 1) for i in range(3) for j in range(i + 1)}


def test_matrix_concat_and_comparison(square, collected):
    stacked = M.stack(square, square, 3)
    assert stacked.agg(F.max("i"), F.count("*")).first()[:] == (5, 18)
    assert M.beside(square, square, 3).agg(F.max("j")).first()[0] == 5
    assert M.stack(square.filter("i < 0"), square, 5).agg(F.min("i"), F.max("i")).first()[:] == (5, 7)
    negated = square.withColumn("v", -F.col("v"))
    assert M.approx_equal(square, negated).first().equal
    assert not M.approx_equal(square, square.filter("i < 2")).first().equal
    patched = M.assign_block(square, (1, 2), (1, 2), 5.0)
    assert patched.filter("v = 5").count() == 4


def test_scalars(spark):
    df = spark.createDataFrame([("a b", " 12 ", "x", 0.123456)], "line string, n string, bad string, p double")
    row = df.select(
        S.split_get(F.col("line"), " ", 1).alias("second"),
        S.split_get(F.col("line"), " ", 5).alias("none"),
        S.cast_number(F.col("n"), "int").alias("n"),
        S.cast_number(F.col("bad")).alias("bad"),
        S.format_percent(F.col("p")).alias("pct"),
        S.threshold(F.lit(0.5)).alias("at"),
        S.days_before(F.to_date(F.lit("2024-03-01")), 1).alias("day"),
        (S.yesterday() == F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")).alias("y"),
    ).first()
    assert (row.second, row.none, row.n, row.bad) == ("b", None, 12, None)
    assert (row.pct, row["at"], row.day, row.y) == ("12.3456%", 0, "2024-02-29", True)


def test_splits_are_disjoint_complete_and_stable(spark, collected):
    ids = spark.range(3000)
    split = X.random_split(ids, ["id"], [3, 10, 20], seed=5)
    assert split.count() == 3000
    sizes = [split.filter(F.col("part") == p).count() for p in range(3)]
    assert sum(sizes) == 3000 and all(abs(s - 3000 * w / 33) < 120 for s, w in zip(sizes, (3, 10, 20)))
    again = X.random_split(ids.repartition(7), ["id"], [3, 10, 20], seed=5)
    assert collected(split) == collected(again)


def test_kfold_blocks_match_ntile(spark, collected):
    df = spark.range(103).withColumn("pos", F.col("id") * F.col("id"))
    expected = spark.sql("SELECT id, pos, ntile(5) OVER (ORDER BY pos) AS fold FROM {df}", df=df)
    assert collected(X.kfold_blocks(df, "pos", 5)) == collected(expected)
    few = spark.range(3)
    assert [r[1] for r in collected(X.kfold_blocks(few, "id", 5))] == [1, 2, 3]


def test_holdout_takes_rows_in_order_up_to_the_cap(spark):
    df = spark.createDataFrame([(p, p % 3) for p in range(60)], "pos long, user int")
    marked = X.holdout_nth_per_user(df, "user", "pos", 1, 10)
    per_user = marked.filter("is_test").groupBy("user").count().collect()
    assert sorted(r["count"] for r in per_user) == [10, 10, 10]
    assert marked.filter("is_test AND pos >= 30").count() == 0
    capped = X.holdout_nth_per_user(df, "user", "pos", 2, 10, max_test=5)
    assert sorted(r.pos for r in capped.filter("is_test").collect()) == [3, 4, 5, 6, 7]
    assert capped.count() == 60


def test_naive_bayes_parameters(spark):
    rows = [(float(c), [float(v) if j == c else 0.0 for j in range(3)]) for c in range(3) for v in (1, 2)]
    got = classify.naive_bayes_parameters(spark.createDataFrame(rows, "label double, features array<double>"))
    for r in got.collect():
        assert math.isclose(r.pi, math.log(1 / 3))
        assert math.isclose(r.theta, math.log(4 / 6 if r.pos == r.label else 1 / 6))


def test_average_precision(spark):
    predicted = spark.createDataFrame([("u", 1, 1), ("u", 2, 2), ("u", 3, 3), ("v", 1, 1)],
                                      "user string, item int, rank int")
    actual = spark.createDataFrame([("u", 1), ("u", 3), ("u", 3)], "user string, item int")
    at3 = dict(tuple(r) for r in metrics.average_precision(predicted, actual, "user", "item", 3).collect())
    assert math.isclose(at3["u"], (1 + 2 / 3) / 2) and at3["v"] == 1.0
    at1 = dict(tuple(r) for r in metrics.average_precision(predicted, actual, "user", "item", 1).collect())
    assert at1["u"] == 1.0


def test_batch_metrics_of_an_empty_batch(spark):
    schema = "user_id long, product long, price double"
    one = spark.createDataFrame([(1, 7, 2.0), (1, 8, 3.0), (2, 8, 5.0)], schema)
    assert tuple(sales.batch_metrics(one).first()) == (3, 2, 10.0, 8, 2)
    assert sales.batch_metrics(one.filter("false")).count() == 0


def test_hot_words_and_products_on_a_table(spark, collected):
    at = "2024-01-01 00:00:05"
    words = spark.createDataFrame([(at, w) for w in "aaabbccd"], "ts string, word string")
    words = words.withColumn("ts", F.to_timestamp("ts"))
    top = clicks.hot_words(clicks.search_word_counts(words))
    first = top.filter("start = '2024-01-01 00:00:00'")
    assert collected(first.select("rank", "word", "n")) == [(1, "a", 3), (2, "b", 2), (3, "c", 2)]
    assert top.select("start").distinct().count() == 6
