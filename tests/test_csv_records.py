"""CSV files read in blocks: records over lines and borders, headers found by tasks."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql.types import StringType, StructField, StructType

from mercastar.sources import csv_records
from mercastar.sources.csv_files import _headers, read_csv

SCHEMA = StructType([StructField(c, StringType()) for c in ("a", "b", "c")])


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few dozen bytes, so that every file is read by many tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("300b", "1b", "1"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plain(spark, path):
    """What the reader that takes a file in one task makes of it."""
    raw = spark.read.schema(SCHEMA).options(
        header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", columnPruning=False, encoding="UTF-8"
    ).csv(path)
    return sorted(tuple(r) for r in raw.collect())


def ours(spark, path):
    out = read_csv(spark, path, SCHEMA, multiline=True)
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((v is not None, v or "") for v in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or "") for v in r))


def quoted_field(rng):
    body = "".join(rng.choice(['""', ",", "\n", "x", "é", " ", "\n\n", "\r\n", "'", '""""']) for _ in range(rng.randint(0, 12)))
    return f'"{body}"'


def open_field(rng):
    text = "".join(rng.choice(["y", "z", " ", "ü", "'", "7"]) for _ in range(rng.randint(1, 9)))
    return text + rng.choice(["", "", "", '"', 'q"', '" inch'])  # quotes inside are plain characters


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_unsplit_reader(spark, small_blocks, tmp_path, seed, end):
    rng = random.Random(seed)
    for name in ("one", "two"):
        rows = [",".join(rng.choice([quoted_field, open_field])(rng) for _ in "abc") for _ in range(60)]
        rows.insert(rng.randint(0, 60), "")
        text = end.join(["a,b,c", *rows]) + rng.choice(["", end])
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    # The unsplit reader takes the line ends of a file for line feeds, in fields as well.
    found = [tuple(v and v.replace(end, "\n") for v in r) for r in ours(spark, str(tmp_path))]
    assert ordered(found) == ordered(tuple(r) for r in plain_rows(spark, str(tmp_path)))


def plain_rows(spark, path):
    from mercastar.functions.text import blank_missing

    raw = spark.read.schema(SCHEMA).options(
        header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", columnPruning=False, encoding="UTF-8"
    ).csv(path)
    return raw.selectExpr(*[f"{blank_missing(f'`{c}`')} AS {c}" for c in "abc"]).collect()


def test_a_field_over_many_blocks_and_many_tasks(spark, small_blocks, tmp_path):
    long = "\n".join(f'line {i}, with ""quotes""' for i in range(400))
    text = f'a,b,c\n1,"{long}",x\n' + "".join(f'{i},"p\nq",r\n' for i in range(2, 120)) + '120,"open at the end'
    text += '\nof the file",z'
    (tmp_path / "f.csv").write_text(text)
    out = read_csv(spark, str(tmp_path / "f.csv"), SCHEMA, multiline=True)
    rows = {r.a: (r.b, r.c) for r in out.collect()}
    assert len(rows) == 120 and rows["1"] == (long.replace('""', '"'), "x")
    assert rows["7"] == ("p\nq", "r") and rows["120"] == ("open at the end\nof the file", "z")
    lines = csv_records._lines(spark, str(tmp_path / "f.csv"))
    assert lines.rdd.getNumPartitions() > 20


def test_quotes_that_only_count_one_way(spark, small_blocks, tmp_path):
    """Counting quotes alone would take the text after the odd quote for a field."""
    rows = ['5" pipe,x,y', 'k,"l\nm",n', 'a"b"c",d,e', '"in ""and"" out",f,g'] * 40
    (tmp_path / "f.csv").write_text("a,b,c\n" + "\n".join(rows) + "\n")
    want = [('5" pipe', "x", "y"), ("k", "l\nm", "n"), ('a"b"c"', "d", "e"), ('in "and" out', "f", "g")] * 40
    assert ours(spark, str(tmp_path)) == sorted(want) == plain(spark, str(tmp_path))


@pytest.mark.parametrize("row", ["1,2", "1,2,3,4", '"1\n2",3'])
def test_rows_of_other_lengths_fail(spark, tmp_path, row):
    (tmp_path / "f.csv").write_text(f"a,b,c\n1,2,3\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, str(tmp_path / "f.csv"), SCHEMA, multiline=True).collect()


def test_headers_of_many_files(spark, tmp_path, monkeypatch):
    kinds = ["a,b,c", "c,b,a", '"b","a","c",more', "x,a,b,c"]
    for i in range(400):
        body = "1,2,3" + (",4" if i % 4 > 1 else "")
        (tmp_path / f"f{i:04}.csv").write_text(("﻿" if i % 8 == 0 else "") + kinds[i % 4] + ("\r\n" if i % 3 else "\n") + body + "\n")
    (tmp_path / "f0000.csv").rename(tmp_path / "f 0%20é.csv")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_hidden.csv").write_text("q,r\n")
    found = _headers(spark, str(tmp_path))
    assert {h: len(f) for h, f in found.items()} == {
        ("a", "b", "c"): 100, ("c", "b", "a"): 100, ("b", "a", "c", "more"): 100, ("x", "a", "b", "c"): 100
    }
    counts = read_csv(spark, str(tmp_path), SCHEMA, multiline=False).groupBy("a", "b", "c").count().collect()
    assert {tuple(r) for r in counts} == {("1", "2", "3", 100), ("3", "2", "1", 100), ("2", "1", "3", 100), ("2", "3", "4", 100)}
    with pytest.raises(FileNotFoundError):
        _headers(spark, str(tmp_path / "nothing*.csv"))


def test_headers_of_files_of_many_blocks(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b,c\n" + "1,2,3\n" * 400_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert csv_records.first_lines(spark, str(tmp_path)) == {"a,b,c": [f"file:{tmp_path}/f.csv"]}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_lines_are_taken_without_a_sort():
    def batch(*rows):
        lines, paths = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array(paths, pa.string())], ["value", "path"])

    batches = [batch(), batch(("a", "f"), ("b", "f"), ("", "g")), batch(("c", "g"), ("d", "h")), batch(("e", "h")), batch(("i", "k"))]
    got = [(r["line"], r["path"]) for b in csv_records._heads(iter(batches)) for r in b.to_pylist()]
    assert got == [("a", "f"), ("", "g"), ("d", "h"), ("i", "k")]


def test_states_of_lines():
    after = csv_records.inside_after
    assert [after(x, False) for x in ("", "a,b", 'a,"b', '"a""b"', '"a"",b', 'a"b', '"a"x,"b', '"a"x"b')] == [
        False, False, True, False, True, False, True, False
    ]
    assert [after(x, True) for x in ("", "a,b", 'b",c', 'b"",c', 'b","c', '"', '""', '"x"')] == [
        True, True, False, True, True, False, True, False
    ]
