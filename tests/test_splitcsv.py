import csv
import io
import random

import pytest
from pyspark.sql import types as T

from tessera.sources import files, splitcsv

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "text", "path")])


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "te\nxt", "path"])
    w.writerows(rows)
    path.write_bytes(out.getvalue().encode())


def sample(n, seed):
    rng = random.Random(seed)
    bits = ["a", "\n", '"', ",", "é", "word ", "\r\n", '""', "\n\n", "x" * 90]
    return [[str(i), "".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) + "z", f"p{i % 7}"] for i in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_records_over_many_splits(spark, tmp_path, small_splits):
    d = tmp_path / "in"
    d.mkdir()
    one, two = sample(300, 1), sample(150, 2)
    one[7][1] = "long\n" * 200 + "end"  # a field over many splits
    write(d / "one.csv", one)
    write(d / "two.csv", two, "\r\n")
    df = splitcsv.read_csv(spark, str(d), SCHEMA)
    assert rows_of(df) == sorted(map(tuple, one + two))
    lines = spark.read.option("lineSep", "\n").text(str(d / "one.csv"))
    assert lines.rdd.getNumPartitions() > 50


def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_splits):
    rows = [[i, t, p] for i, t, p in sample(120, 3)] + [["", "N/A", ""], ["900", "nan", "null"]]
    write(tmp_path / "f.csv", rows)
    assert rows_of(splitcsv.read_csv(spark, str(tmp_path / "f.csv"), SCHEMA).na.fill("?")) == rows_of(files.read_csv(spark, str(tmp_path / "f.csv"), SCHEMA).na.fill("?"))


def test_edges(spark, tmp_path, small_splits):
    d = tmp_path / "in"
    d.mkdir()
    (d / "empty.csv").write_text("")
    (d / "header.csv").write_text("id,text,path")
    (d / "short.csv").write_text('id,text,path\n\n1\n"2","b""\nc"\n\n3,,\n')
    got = sorted(map(tuple, splitcsv.read_csv(spark, str(d), SCHEMA).collect()))
    assert [r[0] for r in got] == ["1", "2", "3"]
    assert got[1] == ("2", 'b"\nc', None) and got[0] == ("1", None, None) and got[2] == ("3", None, None)
    numbers = T.StructType([T.StructField("text", T.IntegerType()), T.StructField("text2", T.StringType())])
    (tmp_path / "n.csv").write_text("a,b\n4,NULL\n5,x\n")
    assert rows_of(splitcsv.read_csv(spark, str(tmp_path / "n.csv"), numbers).na.fill("?")) == [(4, "?"), (5, "x")]
    (tmp_path / "bad.csv").write_text('id,text,path\n1,"open,2\n')
    with pytest.raises(ValueError, match="don't close"):
        splitcsv.read_csv(spark, str(tmp_path / "bad.csv"), SCHEMA)


def test_batches_cut_anywhere(spark, tmp_path, small_splits):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = sample(80, 4)
    write(tmp_path / "f.csv", rows)
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert rows_of(splitcsv.read_csv(spark, str(tmp_path / "f.csv"), SCHEMA)) == sorted(map(tuple, rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
