"""Records found in splits, against Python's csv module on whole files."""

import csv
import io
import random

import pytest

from cellweave.operators import cells as C
from cellweave.operators import emit as E
from cellweave import vocab as V
from cellweave.sources import delimited, records

PIECES = ["a", "bc", ",", ",", '"', '"', '""', "\n", "\r\n", "é", " ", "日本", '",', ',"', "\n\n", '"\n']


def whole(data):
    """Records of a text as the csv module reads it."""
    return [r for r in csv.reader(io.StringIO(data.replace("\r\n", "\n").replace("\r", "\n"))) if r]


def closed(text):
    """``text`` with a quote at its end if it ends inside quotes."""
    lines, state = text.replace("\r\n", "\n").split("\n"), records.OUTSIDE
    for line in lines:
        state = records.after(line, state)
    return text + '"' if state == records.INSIDE else text


def test_states_of_lines():
    for line, outside, inside in [
        ("a,b", 0, 1), ('a,"b', 1, 0), ('"a', 1, 0), ('"a"', 0, 0), ('a"b,c"d', 0, 0), ('"a""', 1, 0), ('"a"b,"c', 1, 1), ('a"', 0, 0),
        ('",', 1, 0), ('"",""', 0, 1), ('x","y', 1, 1), ("", 0, 1), ('""', 0, 1), ('"', 1, 0), ('a,"', 1, 0),
    ]:
        assert (records.after(line, 0), records.after(line, 1)) == (outside, inside), line


def test_states_follow_the_csv_module():
    r = random.Random(11)
    for _ in range(4000):
        text = closed("".join(r.choice(PIECES) for _ in range(r.randint(1, 14))))
        lines, state, made, held = text.replace("\r\n", "\n").split("\n"), 0, [], []
        for line in lines:
            if state == 0 and not line:
                continue
            held.append(line)
            state = records.after(line, state)
            if state == 0:
                made.append("\n".join(held))
                held = []
        assert records.parse(made) == whole(text), repr(text)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(table):
    width = len(table.names)
    return [[v for v in r[1:]] for r in sorted(table.frame.select("row_index", *[f"c{i}" for i in range(width)]).collect())]


def test_any_split_gives_the_records_of_the_whole_file(spark, tmp_path, small_splits):
    r = random.Random(5)
    for trial in range(6):
        body = closed("".join(r.choice(PIECES) for _ in range(r.choice([30, 300, 900]))))
        data = 'h1,"h ""2""",h3\n' + body
        path = tmp_path / f"t{trial}.csv"
        path.write_bytes(data.encode())
        table = delimited.read_csv_table(spark, str(path))
        wanted = [(x + [None] * 3)[:3] for x in whole(data)[1:]]
        assert table.names == ("h1", 'h "2"', "h3") and rows(table) == wanted
        assert len(body) < 200 or table.frame.rdd.getNumPartitions() > 1
        assert sorted(x[0] for x in table.frame.select("row_index").collect()) == list(range(len(wanted)))


def test_a_value_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "line\n" * 200 + "end, of ""it"
    (tmp_path / "a.csv").write_text('k,v\n1,"' + long + '"\n2,x\n')
    (tmp_path / "b.csv").write_text('﻿"k",v\n3,"y\n' + "\n" * 100 + 'z"\n4,\n')
    table = delimited.read_csv_table(spark, str(tmp_path), "t")
    assert rows(table) == [["1", long], ["2", "x"], ["3", "y\n" + "\n" * 100 + "z"], ["4", ""]]


def test_torn_records_and_unlike_files_raise(spark, tmp_path):
    (tmp_path / "torn.csv").write_text('a,b\n1,"open\n2,3\n')
    with pytest.raises(ValueError, match="not closed"):
        delimited.read_csv_table(spark, str(tmp_path / "torn.csv"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "in" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="differ"):
        delimited.read_csv_table(spark, str(tmp_path / "in"))
    assert delimited.read_csv_table(spark, str(tmp_path / "in"), header=["x", "y"]).names == ("x", "y")


def test_tables_with_unlike_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text("ID,NAME\n1,tern\n2,ruff,surplus\n")
    (tmp_path / "two.csv").write_text('NAME,ID,MORE\nsnipe,3,"far\nout"\n')
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "bare.csv").write_text("ONLY\n")
    table = delimited.read_csv_tables(spark, str(tmp_path))
    cells = {tuple(r) for r in C.melt(table).select("table_name", "row_index", "column_index", "column_name", "value").collect()}
    assert cells == {
        ("one", 0, 0, "ID", "1"), ("one", 0, 1, "NAME", "tern"), ("one", 1, 0, "ID", "2"), ("one", 1, 1, "NAME", "ruff"),
        ("two", 0, 0, "NAME", "snipe"), ("two", 0, 1, "ID", "3"), ("two", 0, 2, "MORE", "far\nout"),
    }
    columns = E.table_columns(E.tables_dim(spark, table), table, V.PLAIN).collect()
    assert {(r.table_name, r.column_index, r.column_name) for r in columns} == {
        ("one", 0, "ID"), ("one", 1, "NAME"), ("two", 0, "NAME"), ("two", 1, "ID"), ("two", 2, "MORE"), ("bare", 0, "ONLY"),
    }


def test_a_row_limit_reads_the_first_files_only(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i:02}.csv").write_text("id\n" + "".join(f"{10 * i + j}\n" for j in range(10)))
    table = delimited.read_csv_table(spark, str(tmp_path), "t", max_rows=7)
    assert rows(table) == [[str(i)] for i in range(7)]
    (tmp_path / "05.csv").write_text('id\n"never read')
    assert rows(delimited.read_csv_table(spark, str(tmp_path), "t", max_rows=15)) == [[str(i)] for i in range(15)]


def test_records_stay_readable_when_split_sizes_change(spark, tmp_path):
    """Plans that are made later split the files as they were counted; many splits are read by few tasks."""
    path = tmp_path / "long.csv"
    path.write_text("id,t\n" + "".join(f'{i},"one\n{i}, two"\n' for i in range(5000)))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "1024")
        frame = delimited.read_csv_table(spark, str(path), "t").frame
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 64 >= frame.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    frame.write.parquet(str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in found.collect()) == [(i, str(i), f"one\n{i}, two") for i in range(5000)]
