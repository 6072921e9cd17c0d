import csv
import io

from sample_tables import BLANKS, SAMPLE

from cellweave.operators import cells as C
from cellweave.operators.index import limit_report
from cellweave.sources import delimited


def melted(table):
    rows = C.melt(table).collect()
    return {(r.row_index, r.column_index): (r.column_name, r.value) for r in rows}


def test_pick_input():
    assert delimited.pick_input(["a.txt", "B.CSV", "c.csv"]).path == "B.CSV"
    nothing = delimited.pick_input(["a.txt"])
    assert nothing.path is None and nothing.alerts


def test_byte_order_mark_is_no_part_of_the_header(spark, csv_file):
    text = "Bird,Count\nsnipe,31\nruff,8\n"
    for data in (text.encode(), b"\xef\xbb\xbf" + text.encode()):
        table = delimited.read_csv_table(spark, csv_file(data))
        assert table.names == ("Bird", "Count") and table.name == "sample"
        assert melted(table)[(1, 1)] == ("Count", "8")


def test_blank_values_leave_no_cell(spark, csv_file):
    assert sorted(v for _, v in melted(delimited.read_csv_table(spark, csv_file(BLANKS))).values()) == [
        "12", "13", "Hill 9", "Quay 4", "Tern",
    ]


def test_odd_records(spark, csv_file):
    """Repeated names, short and long rows, quoted line ends, doubled quotes, blank lines, odd blanks."""
    data = 'A,A,B\n1,2,3\n   \n\n"x\r\ny",,"q""q"\n4\n5,6,7,8\n ,\u00a0,z\nlast,1,2'
    table = delimited.read_csv_table(spark, csv_file(data))
    assert table.names == ("A", "A", "B")
    rows = list(csv.reader(io.StringIO(data.replace("\r\n", "\n"))))[1:]
    rows = [r for r in rows if r]
    wanted = {
        (i, j): (table.names[j], v) for i, r in enumerate(rows) for j, v in enumerate(r[:3]) if v.strip()
    }
    assert melted(table) == wanted


def test_header_without_final_newline_or_odd_header(spark, csv_file):
    assert melted(delimited.read_csv_table(spark, csv_file("id,bird\n8,tern"))) == {
        (0, 0): ("id", "8"), (0, 1): ("bird", "tern"),
    }
    assert delimited.read_csv_table(spark, csv_file("one line of words\n##\n")).names == ("one line of words",)
    assert delimited.read_csv_table(spark, csv_file("", "empty.csv")) is None


def test_limit(spark, csv_file):
    path = csv_file(SAMPLE)
    assert {r for r, _ in melted(delimited.read_csv_table(spark, path, max_rows=2))} == {0, 1}
    assert len({r for r, _ in melted(delimited.read_csv_table(spark, path, max_rows=0))}) == 4
    report = limit_report(delimited.read_csv_table(spark, path), 2).first()
    assert (report.rows_available, report.rows_processed, report.is_cut) == (4, 2, True)


def test_positions_over_splits_and_files(spark, tmp_path):
    """Rows keep their place when files are cut into blocks and packed in another order."""
    folder = tmp_path / "in"
    folder.mkdir()
    n = 0
    for name, rows in (("a.csv", 3000), ("b.csv", 90_000), ("c.csv", 20)):
        lines = [f"{n + i},text {n + i}" for i in range(rows)]
        (folder / name).write_text("id,t\n" + "\n".join(lines) + "\n")
        n += rows
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        table = delimited.read_csv_table(spark, str(folder), "t")
        assert table.frame.filter("row_index != cast(c0 as bigint)").count() == 0
        assert table.frame.count() == n and table.frame.rdd.getNumPartitions() > 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_tables(spark, tmp_path):
    (tmp_path / "one two.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "THREE.CSV").write_text("a,b\n5,6\n")
    (tmp_path / "notes.txt").write_text("no table")
    table = delimited.read_csv_tables(spark, str(tmp_path))
    rows = {(r.table_name, r.row_index, r.c0) for r in table.frame.collect()}
    assert rows == {("one two", 0, "1"), ("one two", 1, "3"), ("THREE", 0, "5")}
    files = delimited.list_csv_files(spark, str(tmp_path)).collect()
    assert {f.table_name for f in files} == {"one two", "THREE"}
