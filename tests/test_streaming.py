from cellweave import vocab as V
from cellweave.operators import graph as G
from cellweave.plans.convert import convert
from cellweave.sources import delimited, triples
from cellweave.streaming import ingest

HEADER = "id,name,size\n"


def lines(first, last):
    return "".join(f"{i},name {i},{i * 3 if i % 4 else ''}\n" for i in range(first, last))


def stream(spark, folder):
    reader = spark.readStream.schema("id string, name string, size string").option("header", True).option("escape", '"')
    return reader.csv(str(folder))


def test_lots_of_files_continue_the_table(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()
    for n, (first, last) in enumerate(((0, 40), (40, 45), (45, 100))):
        (source / f"part{n}.csv").write_text(HEADER + lines(first, last))
        ingest.start(stream(spark, source), "t", out, checkpoint, rows_per_chunk=25).awaitTermination()
    found = triples.read_triples(spark, out + "/data")
    whole = tmp_path / "t.csv"
    whole.write_text(HEADER + lines(0, 100))
    wanted = convert(delimited.read_csv_table(spark, str(whole)), V.TYPED).data()
    assert G.diff(found, wanted).isEmpty()
    assert {r.chunk for r in found.select("chunk").distinct().collect()} == {f"chunk_000{i}" for i in range(4)}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.csv").write_text(HEADER + lines(0, 10))
    batch = ingest.with_source(spark.read.schema("id string, name string, size string").option("header", True).csv(str(source)))
    write = ingest.append_batches(batch, "t", out)
    for batch_id in (0, 1, 1, 0):
        write(batch, batch_id)
    rows = G.instances(triples.read_triples(spark, out + "/data"), V.TYPED.term("Row"))
    assert rows.count() == 20


def test_a_batch_reads_one_entry_of_the_ledger(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.csv").write_text(HEADER + lines(0, 10))
    for i in range(1000):
        entry = out / "ledger" / f"batch={i:09d}"
        entry.mkdir(parents=True)
        # any other entry than the last would give a wrong place
        (entry / "part-0.json").write_text(f'{{"batch_id": {i}, "rows": 3, "total": {3000 if i == 999 else 7}}}\n')
    batch = ingest.with_source(spark.read.schema("id string, name string, size string").option("header", True).csv(str(source)))
    write = ingest.append_batches(batch, "t", str(out))
    write(batch, 1000)
    write(batch, 1001)
    write(batch, 1000)  # a replay keeps its positions and those behind it
    write(batch, 1005)  # batches between had no files
    rows = G.instances(triples.read_triples(spark, f"{out}/data"), V.TYPED.term("Row")).collect()
    assert sorted(int(r.s.rsplit("/", 1)[1]) for r in rows) == list(range(3000, 3030))


def test_a_batch_writes_each_chunk_from_few_tasks(spark, tmp_path):
    """The rows of a chunk are brought together before they become many lines, in whatever files they came."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(8):
        (source / f"{i}.csv").write_text(HEADER + lines(10 * i, 10 * i + 10))
    batch = ingest.with_source(spark.read.schema("id string, name string, size string").option("header", True).csv(str(source)))
    ingest.append_batches(batch, "t", str(out), rows_per_chunk=40)(batch, 0)
    for chunk in ("chunk_0000", "chunk_0001"):
        # one file of rows and one of cells
        assert len(list((out / "data" / "batch=000000000" / f"chunk={chunk}").glob("part-*"))) == 2
    assert G.instances(triples.read_triples(spark, f"{out}/data"), V.TYPED.term("Row")).count() == 80


def test_lines_of_a_batch_take_little_of_the_disk(spark, tmp_path):
    """Lines repeat most of each other: what is written is a small part of their text, and reads as the same triples."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.csv").write_text(HEADER + lines(0, 2000))
    batch = ingest.with_source(spark.read.schema("id string, name string, size string").option("header", True).csv(str(source)))
    ingest.append_batches(batch, "t", str(out))(batch, 0)
    files = [f for f in (out / "data").rglob("part-*") if f.is_file()]
    text = spark.read.text(f"{out}/data").selectExpr("sum(length(value) + 1)").first()[0]
    assert 10 * sum(f.stat().st_size for f in files) < text
    wanted = convert(delimited.read_csv_table(spark, str(source / "a.csv"), "t"), V.TYPED).data()
    assert G.diff(triples.read_triples(spark, f"{out}/data"), wanted).isEmpty()
