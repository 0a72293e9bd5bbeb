"""Records with line breaks, cut at any place, against Python's csv module."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from hearth import schema
from hearth.sources import csvrecords, files

FIELDS = schema.T.StructType([schema.T.StructField(n, schema.S) for n in ("a", "b", "c")])


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def some_rows(n, seed):
    rnd = random.Random(seed)
    part = lambda: rnd.choice(["x", "y z", 'say "hi"', "a,b", "line\nbreak", "\n\n", '"', "é南", "long " * rnd.randint(1, 80), "tail\n"])
    return [(str(i), "".join(part() for _ in range(rnd.randint(1, 4))), part()) for i in range(n)]


def write(path, rows, end="\n", bom="", names=("a", "b", "c")):
    text = io.StringIO()
    w = csv.writer(text, lineterminator=end)
    w.writerow(names)
    w.writerows(rows)
    with open(path, "wb") as fh:
        fh.write((bom + text.getvalue()).encode())


def test_cut_anywhere(spark, scratch, small_splits):
    rows = some_rows(200, 1)
    write(f"{scratch}/x.csv", rows, bom="﻿")
    found = csvrecords._lines(spark, f"{scratch}/x.csv")
    assert found.select("block").distinct().count() > 20      # several tasks read the one file
    got = files.read_csv_table(spark, f"{scratch}/x.csv", FIELDS, seq="seq").orderBy("seq").collect()
    assert [(r.a, r.b, r.c) for r in got] == rows


def test_a_record_over_many_splits(spark, scratch, small_splits):
    rows = [("1", "start", "z"), ("2", "\n".join(f'row "{i}", of many' for i in range(300)), "z"), ("3", "x" * 5000 + "\n" + "y" * 5000, "\n"), ("4", "end", "z")]
    write(f"{scratch}/x.csv", rows)
    got = files.read_csv_table(spark, f"{scratch}/x.csv", FIELDS, seq="seq").orderBy("seq").collect()
    assert [(r.a, r.b, r.c) for r in got] == rows


def test_many_files_ends_of_line_and_index_column(spark, scratch):
    os.makedirs(f"{scratch}/d")
    every = []
    for k in range(3):
        rows = some_rows(30, k)
        every += rows
        write(f"{scratch}/d/part-{k}.csv", [(str(i), *r) for i, r in enumerate(rows)], end="\r\n", names=("Unnamed: 0", "a", "b", "c"))
    got = files.read_csv_table(spark, f"{scratch}/d", FIELDS, seq="seq").orderBy("seq").collect()
    assert [(r.a, r.b, r.c) for r in got] == every


def test_blank_lines_short_records_and_empty_files(spark, scratch):
    with open(f"{scratch}/x.csv", "w") as fh:
        fh.write('a,b,c\n\n1,"",\n2,only two\n   \n3,"p\n\nq",r\n')
    got = files.read_csv_table(spark, f"{scratch}/x.csv", FIELDS, seq="seq").orderBy("seq").collect()
    assert [(r.a, r.b, r.c) for r in got] == [("1", "", None), ("2", "only two", None), ("3", "p\n\nq", "r")]
    with open(f"{scratch}/y.csv", "w") as fh:
        fh.write("a,b,c\n")
    assert files.read_csv_table(spark, f"{scratch}/y.csv", FIELDS).count() == 0


def test_export_and_back_keeps_blanks_and_breaks(spark, scratch, small_splits):
    rows = [(str(i), " lead " + t, None if i % 7 == 0 else c) for i, (_, t, c) in enumerate(some_rows(100, 5))]
    files.write_csv_table(spark.createDataFrame(rows, FIELDS).repartition(3), f"{scratch}/out")
    back = files.read_csv_table(spark, f"{scratch}/out", FIELDS)
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(rows, key=str)
    assert dict(back.select(files.snapshot_day(F.lit("2025-05-08").cast("date")).alias("d")).limit(1).dtypes) == {"d": "string"}
