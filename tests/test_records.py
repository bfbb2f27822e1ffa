"""Delimited files in byte ranges against whole-file reading."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from cadenza.sources import files, records


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def ranges_of(spark):
    """Byte ranges of so many bytes."""
    def run(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield run
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def put(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def odd_text(rng, feed, quoted_only):
    def cell():
        kind = rng.random()
        text = "".join(rng.choices(["a", "b", " ", ",", '"', "\n", feed, "é", "x y"], k=rng.randrange(9)))
        if quoted_only or kind < 0.6:
            return '"' + text.replace('"', '""') + '"'
        # Quotes that open nothing, and text behind a closing one.
        return 'x"' if kind < 0.7 else '"ab"cd' if kind < 0.75 else text.translate(str.maketrans("", "", '",\r\n'))

    lines = [",".join(cell() for _ in range(3)) for _ in range(rng.randrange(1, 60))]
    lines.insert(rng.randrange(len(lines) + 1), '"' + f"long text{feed}" * 80 + '",y,z')
    return feed.join([f'k,"l{feed}m",n', *lines]) + (feed if rng.random() < 0.5 else "")


@pytest.mark.parametrize("size", [23, 120, 1 << 20])
def test_equals_whole_file_reading(spark, folder, ranges_of, size):
    rng = random.Random(size)
    for trial in range(5):
        path = put(folder, f"{trial}.csv", odd_text(rng, "\r\n" if trial % 2 else "\n", trial > 3))
        ranges_of(size)
        got, whole = files.read_csv(spark, path), records.whole_files(spark, ",", "UTF-8").csv(path)
        assert got.columns == whole.columns == ["k", "l\nm", "n"]
        assert rows(got) == rows(whole)


def test_edges_at_every_byte(spark, folder, ranges_of):
    """A quote, a separator, a CR or a line feed on the edge of a range, and no line end at the end."""
    path = put(folder, "a.csv", 'k,l\r\n1,"a ""q""\r\nb"\r\n"2\r\n",\r\n,"""\r\n"""')
    expected = ["('1', 'a \"q\"\\nb')", "('2\\n', None)", "(None, '\"\\n\"')"]
    for size in range(7, 50, 4):
        ranges_of(size)
        assert rows(files.read_csv(spark, path)) == expected, size


def test_large_file_is_read_by_many_tasks(spark, folder, ranges_of):
    block = "".join(f'{i},"line one of {i}\nline ""two"", of {i}",{"x" * (i % 40)}\n' for i in range(20_000))
    path = put(folder, "big.csv", "id,note,x\n" + block * 10)
    ranges_of(1 << 20)
    got, whole = files.read_csv(spark, path), records.whole_files(spark, ",", "UTF-8").csv(path)
    assert got.rdd.getNumPartitions() >= 8 and whole.rdd.getNumPartitions() == 1
    sums = [df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first() for df in (got, whole)]
    assert sums[0] == sums[1] and sums[0][0] == 200_000


def test_headers(spark, folder):
    a = put(folder, "a.csv", "\ufeffk,,K,n\n1,2,3,4\n")
    frame = files.read_csv(spark, a)
    assert frame.columns == ["k0", "_c1", "K2", "n"] and rows(frame) == ["('1', '2', '3', '4')"]
    b = put(folder, "b.csv", "k,n\n1,2\n\n3\nx,y,z\n")
    assert rows(files.read_csv(spark, b, schema="k string, n int")) == ["('1', 2)", "('3', None)", "('x', None)"]
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, b, schema="k string, m int")
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, [a, b])
    both = [put(folder, f"c/{i}.csv", f"k,n\n{i},x\nk,n\n") for i in range(3)]
    assert rows(files.read_csv(spark, both)) == sorted([*[f"('{i}', 'x')" for i in range(3)], *["('k', 'n')"] * 3])
    assert rows(files.read_csv(spark, os.path.dirname(both[0]))) == rows(files.read_csv(spark, both))
    assert files.read_csv(spark, put(folder, "only.csv", "k,n")).columns == ["k", "n"]
    assert files.read_csv(spark, put(folder, "none.csv", "")).count() == 0


def test_encodings(spark, folder, ranges_of):
    text = 'né,n\n"é\nè",1\n' + 'ü,"2"\n' * 40
    for encoding in ("utf-8", "latin-1"):
        path = put(folder, f"{encoding}.csv", text, encoding)
        ranges_of(64)
        frame = files.load_encoded(spark, path)
        assert frame.columns == ["né", "n"] and rows(frame) == sorted(["('é\\nè', '1')", *["('ü', '2')"] * 40])
    path = put(folder, "wide.csv", text, "utf-16")
    assert rows(files.read_csv(spark, path, encoding="UTF-16")) == rows(frame)


def test_folder_needs_few_jobs(spark, folder):
    for i in range(100):
        put(folder, f"x/a{i}.csv", f'k,"n"\n"é\n{i}",2\n', "latin-1" if i % 3 else "utf-8")
        put(folder, f"y/b{i}.tsv", f"k\tl{i % 2}\n{i}\t2,3\n")
    put(folder, "y/a7.tsv", "never\n1\n")
    put(folder, "z/odd name%20é.csv", "k\n1\n")
    spark.sparkContext.setJobGroup("folder", "jobs of a folder")
    try:
        tables = files.load_folder(spark, folder)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("folder"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4 and len(tables) == 201
    assert all(tuple(tables[f"a{i}"].first()) == (f"é\n{i}", "2") for i in (0, 1, 7, 99))
    assert tables["b5"].columns == ["k", "l1"] and tuple(tables["b5"].first()) == ("5", "2,3")
    assert tables["odd name%20é"].columns == ["k"]
