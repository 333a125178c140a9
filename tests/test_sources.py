"""Readers and writers."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from millrace.functions import matrices as M
from millrace.sources import files, images, jdbc, tables


def test_text_and_delimited(spark, tmp_path, collected):
    (tmp_path / "t.txt").write_text("a 1\n\nb 2\n")
    assert files.scan_text(spark, str(tmp_path / "t.txt")).count() == 3
    (tmp_path / "d.txt").write_text("leo\x0118\nmarry\x01null\n")
    got = files.scan_delimited(spark, str(tmp_path / "d.txt"), "name string, age int", "\x01", null_text="null")
    assert collected(got) == [("leo", 18), ("marry", None)]


def test_carriage_returns_and_blank_lines(spark, tmp_path, collected):
    (tmp_path / "d.txt").write_bytes(b"unknown|0\r\nAction|1\r\n\r\n")
    got = files.scan_delimited(spark, str(tmp_path / "d.txt"), "genre string, idx int", "|")
    assert collected(got) == [("Action", 1), ("unknown", 0)]


def test_json_lines_with_missing_keys(spark, tmp_path, collected):
    (tmp_path / "p.json").write_text('{"name":"Orla"}\n{"name":"Pavel","age":44}\n')
    got = files.scan_json(spark, str(tmp_path / "p.json")).select("name", "age")
    assert collected(got) == [("Orla", None), ("Pavel", 44)]


def test_nested_json_strings_with_inferred_schema(spark):
    text = '{"name":"Tove","address":{"city":"Bergen","state":"Vestland"}}'
    df = spark.createDataFrame([(text,), ('{"name":"Li"}',)], "doc string")
    got = files.scan_json_strings(df, "doc").select("parsed.name", "parsed.address.city", "parsed.address.state")
    assert sorted(tuple(r) for r in got.collect() if r.city) == [("Tove", "Bergen", "Vestland")]
    assert got.count() == 2


def test_merge_schema_over_partition_folders(spark, tmp_path):
    base = str(tmp_path / "m")
    squares = spark.createDataFrame([(i, i * i) for i in range(1, 6)], "value int, square int")
    cubes = spark.createDataFrame([(i, i**3) for i in range(6, 11)], "value int, cube int")
    files.sink_parquet(squares, f"{base}/key=1")
    files.sink_parquet(cubes, f"{base}/key=2")
    merged = files.scan_parquet(spark, base, merge_schema=True)
    assert set(merged.columns) == {"value", "square", "cube", "key"} and merged.count() == 10
    assert merged.filter("key = 2 AND square IS NOT NULL").count() == 0
    assert merged.filter("key = 1 AND cube IS NOT NULL").count() == 0


def test_append_then_merge(spark, tmp_path):
    path = str(tmp_path / "a")
    files.sink_parquet(spark.createDataFrame([("leo", 23), ("jack", 25)], "name string, age int"), path)
    files.sink_parquet(spark.createDataFrame([("marry", "A"), ("tom", "B")], "name string, grade string"), path)
    got = files.scan_parquet(spark, path, merge_schema=True)
    assert sorted(got.columns) == ["age", "grade", "name"] and got.count() == 4


def test_partition_types_found_or_declared(spark, tmp_path):
    path = str(tmp_path / "p")
    files.sink_parquet(spark.range(4).withColumn("code", F.col("id") % 2), path, partition_by=["code"])
    assert files.scan_partitioned(spark, path).schema["code"].dataType == T.IntegerType()
    declared = files.scan_partitioned(spark, path, "id long, code string")
    assert declared.schema["code"].dataType == T.StringType()
    text = files.scan_partitioned(spark, path).filter("code = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(code" in text


def test_sql_over_a_path(spark, tmp_path, collected):
    files.sink_parquet(spark.range(3), str(tmp_path / "x"))
    assert collected(files.scan_path_sql(spark, str(tmp_path / "x"), ["id"])) == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        files.scan_path_sql(spark, "x` UNION SELECT 1 --")


def test_tables(spark, tmp_path, collected):
    (tmp_path / "s.txt").write_text("leo\t88\nmarry\t99\n")
    for overwrite, n in ((True, 2), (False, 4), (True, 2)):
        got = tables.table_create_load(spark, "scores_t", str(tmp_path / "s.txt"),
                                       "name string, score int", "\t", overwrite=overwrite)
        assert got.count() == n
    good = tables.table_save_read(got.filter("score > 90"), "good_t")
    assert collected(good) == collected(spark.table("good_t")) == [("marry", 99)]


def test_frames(spark, collected):
    made = tables.frame_from_rows(spark, [("a", 1), ("b", 2)], ["k", "n"])
    assert collected(made) == [("a", 1), ("b", 2)]
    schema = T.StructType([T.StructField("d", T.StringType()), T.StructField("u", T.IntegerType())])
    bound = tables.frame_with_schema(spark.createDataFrame([("x", "7")], "a string, b string"), schema)
    assert bound.schema == schema and collected(bound) == [("x", 7)]
    with pytest.raises(ValueError):
        tables.frame_with_schema(made.select("k"), schema)


def bmp(path, pixels):
    """A 24-bit BMP file of rows of (r, g, b)."""
    h, w = len(pixels), len(pixels[0])
    pad = b"\0" * (-3 * w % 4)
    body = b"".join(b"".join(bytes((b, g, r)) for r, g, b in row) + pad for row in reversed(pixels))
    head = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0)
    path.write_bytes(head + info + body)


def test_images_to_gray_vectors(spark, tmp_path):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 256, (4, 6, 3))
    bmp(tmp_path / "a.bmp", [[tuple(map(int, p)) for p in row] for row in a])
    (tmp_path / "junk.bmp").write_bytes(b"no image")
    (tmp_path / "empty.bmp").write_bytes(b"")
    found = files.scan_images(spark, str(tmp_path))
    rows = found.select("path", images.pixel_vector(F.col("image"), 3, 2).alias("v")).collect()
    got = {r.path.rsplit("/", 1)[1]: r.v for r in rows}
    assert set(got) == {"a.bmp", "junk.bmp"} and got["junk.bmp"] is None
    np.testing.assert_allclose(got["a.bmp"], a.mean(axis=2)[1::2, 1::2].ravel())


def test_image_files_round_trip(spark, tmp_path):
    rng = np.random.default_rng(6)
    pixels = {f"{i:02}.png": rng.integers(0, 256, 20).tolist() for i in range(15)}
    rows = spark.createDataFrame([*pixels.items(), ("none.png", None)], "name string, pixels array<int>").repartition(3)
    encoded = rows.select("name", images.encode_png(F.col("pixels"), 5, 4).alias("data"))
    folder = str(tmp_path / "images")
    images.sink_files(encoded, folder, "name", "data")
    images.sink_files(encoded, folder, "name", "data")  # a repeated task writes the same files
    assert sorted(p.name for p in (tmp_path / "images").iterdir()) == sorted(pixels)
    found = files.scan_images(spark, folder, "*.png")
    got = found.select("path", images.pixel_vector(F.col("image"), 5, 4).alias("v")).collect()
    assert {r.path.rsplit("/", 1)[1]: r.v for r in got} == pixels


def test_libsvm_and_matrix_files(spark, tmp_path, collected):
    (tmp_path / "x.libsvm").write_text("1 1:0.5 3:2\n0 2:1\n")
    got = files.scan_libsvm(spark, str(tmp_path / "x.libsvm"), features=3).orderBy("label").collect()
    assert [list(r.features.toArray()) for r in got] == [[0, 1, 0], [0.5, 0, 2]]
    rows = spark.createDataFrame([(0, [1.5, 2.0]), (1, [0.1, -4.0])], "i long, x array<double>")
    entries = M.to_entries(rows, "i", "x")
    files.sink_matrix_csv(entries, str(tmp_path / "m"))
    back = files.scan_delimited(spark, str(tmp_path / "m"), "i long, j long, v double", ",")
    assert collected(back) == collected(entries)


@pytest.fixture
def calls(monkeypatch):
    """Database calls as they would reach Spark; no database is used."""
    seen = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: seen.append(("read", a, k)))
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: seen.append(("write", a, k)))
    return seen


def test_database_reads_are_split(spark, calls):
    database = jdbc.Database("jdbc:x:", {"user": "u", "password": "p"})
    jdbc.scan_jdbc(spark, database, "t")
    jdbc.scan_jdbc(spark, database, "t", "id", 0, 1000, 8)
    assert calls[0] == ("read", ("jdbc:x:", "t"), {"properties": {"user": "u", "password": "p", "fetchsize": "10000"}})
    split = calls[1][2]
    assert (split["column"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", 0, 1000, 8)


def test_database_writes_are_batched(spark, calls):
    jdbc.sink_jdbc(spark.range(3), jdbc.Database("jdbc:x:"), "t", mode="overwrite", batch_size=7)
    assert calls == [("write", ("jdbc:x:", "t"), {"mode": "overwrite", "properties": {"batchsize": "7"}})]
