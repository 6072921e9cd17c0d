"""Whole conversions: exact counts, structure, outputs."""

import json
from dataclasses import replace
from pathlib import Path

import pytest
from sample_tables import BLANKS, FULL, SAMPLE, SMALL
from pyspark.sql import functions as F

from cellweave import vocab as V
from cellweave.operators import graph as G
from cellweave.operators import pages as P
from cellweave.operators import summary as S
from cellweave.plans import convert as plans
from cellweave.sinks import graph as sinks
from cellweave.sinks.graph import write_lines
from cellweave.sources import bank_catalogue as bank
from cellweave.sources import delimited, documents, triples

CREATED = "2025-06-20T12:00:00"


def converted(spark, path, profile=V.TYPED, annotated=True, **options):
    catalogue = bank.bank_catalogue(spark) if annotated else None
    return plans.convert(delimited.read_csv_table(spark, path), profile, catalogue, CREATED, **options)


# With C columns, R rows, N cells, L links and K copied triples: plain 3 + 4C + 3R + 4N, typed 3 + 4C + L + K + R + 5N.
# Table, rows, columns, cells, triples of the plain profile, links, copied triples, triples of the typed profile.
GOLDEN = [
    (SAMPLE, 4, 8, 32, 175, 8, 90, 297),
    (FULL, 5, 15, 75, 378, 12, 118, 573),
    (BLANKS, 3, 3, 5, 44, 3, 39, 85),
    (SMALL, 1, 6, 6, 54, 6, 66, 130),
]


@pytest.mark.parametrize("text,rows,columns,cells,plain,linked,copied,typed", GOLDEN)
def test_counts(spark, csv_file, text, rows, columns, cells, plain, linked, copied, typed):
    path = csv_file(text)
    graph = converted(spark, path, V.PLAIN, annotated=False)
    assert graph.triples().count() == plain == graph.triples().distinct().count()
    graph = converted(spark, path)
    assert graph.linked.filter("annotation_iri is not null").count() == linked
    assert graph.metadata.count() == 3 + 4 * columns + linked + copied
    assert graph.triples().count() == typed == graph.triples().distinct().count()
    counts = plans.summarise(graph).first()
    assert (counts.rows_processed, counts.cells, counts.columns_mapped, counts.triples_generated) == (rows, cells, linked, typed)
    kinds = {r.kind: r.triples for r in S.triple_counts(graph.table, V.PLAIN).collect()}
    assert kinds == {"table": 3, "column": 4 * columns, "row": 3 * rows, "cell": 4 * cells}
    estimate = S.estimate_vs_actual(graph.table, V.PLAIN).first()
    assert (estimate.estimated_triples, estimate.triples_generated) == (50 * rows, plain)


def test_table_and_columns(spark, csv_file):
    metadata = converted(spark, csv_file(SAMPLE), annotated=False).metadata
    table = V.TYPED.base + "table/sample"
    assert {r.s for r in G.instances(metadata, V.TYPED.term("Table")).collect()} == {table}
    assert G.match(metadata, table, V.DCTERMS + "title").first().o == "Table: sample.csv"
    created = G.match(metadata, table, V.DCTERMS + "created").first()
    assert (created.o, created.o_datatype) == (CREATED, V.XSD + "dateTime")
    assert G.match(metadata, table, V.TYPED.term("column")).count() == 8
    names = {r.o for r in G.match(metadata, p=V.TYPED.term("columnName")).collect()}
    assert names == {"CERT", "NAME", "ADDRESS", "CITY", "STALP", "ZIP", "X", "Y"}


def test_rows_and_limit(spark, csv_file):
    graph = converted(spark, csv_file(SAMPLE), V.PLAIN, max_rows=2).triples()
    assert {r.o for r in G.match(graph, p=V.PLAIN.term("rowIndex")).collect()} == {"0", "1"}
    assert G.instances(graph, V.PLAIN.term("Row")).count() == 2


def test_literals(spark, csv_file):
    graph = converted(spark, csv_file("A,B\n01234,1e5\n -7 ,x\n")).triples()
    values = {(r.o, (r.o_datatype or "").rsplit("#")[-1]) for r in G.match(graph, p=V.TYPED.term("value")).collect()}
    assert values == {("1234", "integer"), ("100000.0", "decimal"), ("-7", "integer"), ("x", "")}


def test_declared_types_can_keep_leading_zeros(spark, csv_file):
    graph = converted(spark, csv_file("ZIP,N\n01234,05\n"), declared={"ZIP": "string"}).triples()
    values = {r.o for r in G.match(graph, p=V.TYPED.term("value")).collect()}
    assert values == {"01234", "5"}


def test_encoded_table_name_and_own_base(spark, csv_file):
    profile = replace(V.PLAIN, base="https://tables.example/")
    graph = converted(spark, csv_file("CERT,NAME\n8,Tern", "my table.csv"), profile, annotated=False).triples()
    assert G.instances(graph, profile.term("Table")).first().s == "https://tables.example/table/my%20table"


def test_annotations(spark, csv_file):
    graph = converted(spark, csv_file(FULL))
    linked = {r.column_name for r in graph.linked.filter("annotation_iri is not null").collect()}
    assert linked == {
        "NAME", "CERT", "X", "Y", "LONGITUDE", "LATITUDE", "ZIP", "CITY", "ADDRESS", "STALP", "STNAME", "SERVTYPE_DESC",
    }
    targets = {r.o for r in G.match(graph.metadata, p=V.SEE_ALSO).collect()}
    assert all(any(word in t for t in targets) for word in ("geosparql", "fibo", "geonames", "wikipedia"))
    assert S.reference_totals(bank.bank_catalogue(spark)).first().links == 35
    # The restriction on CERT hangs on an anonymous node, which is copied only on demand.
    assert G.match(graph.metadata, "_:certificate").count() == 0
    followed = converted(spark, csv_file(FULL), follow_bnodes=True).metadata
    assert G.match(followed, "_:certificate").count() == 3


def test_no_catalogue_is_no_error(spark, csv_file):
    assert bank.catalogue_or_default(spark, None, use_default=False) is None
    assert bank.catalogue_or_default(spark, None).count() == 125 + 3
    assert converted(spark, csv_file(SAMPLE), annotated=False).linked.filter("annotation_iri is not null").count() == 0


def test_navigation(spark, csv_file):
    graph = converted(spark, csv_file(SAMPLE))
    path = G.navigate(graph.cell_triples(), graph.metadata, V.TYPED)
    zip_cells = path.filter(F.col("cell").endswith("/5"))
    assert zip_cells.count() == 4 * 5
    assert path.count() == 4 * (5 + 6 + 4 + 1 + 1 + 5 + 4 + 4)


def test_rebuild(spark, csv_file):
    for profile in (V.PLAIN, V.TYPED):
        graph = converted(spark, csv_file(FULL), profile)
        back = {r.row_iri.rsplit("/", 1)[1]: r for r in G.rebuild(graph.triples(), graph.table.names, profile).collect()}
        assert len(back) == 5
        assert (back["0"].CERT, back["0"].NAME, back["0"].CITY) == ("301", "Heron Savings", "Brackwater")
        assert (back["4"].CERT, back["4"].NAME) == ("7", "Avocet Union")
        assert G.dangling(graph.triples().select(*"s p o o_kind o_datatype o_lang".split()), profile).isEmpty()


def test_match_makes_what_it_needs(spark, csv_file):
    base = V.TYPED.base
    graph = converted(spark, csv_file(FULL))
    whole = graph.triples().persist()
    value, kind = V.TYPED.term("value"), V.RDF_TYPE
    patterns = [
        {"s": base + "row/sample/2"}, {"s": base + "cell/sample/3/1"}, {"s": base + "cell/sample/3/99"}, {"p": value},
        {"s": base + "row/sample/x"}, {"s": base + "column/sample/0"}, {"s": base + "cell/sample/0/2", "p": value, "o": "301"},
        {"p": kind, "o": V.TYPED.term("Cell")}, {"s": base + "table/sample"}, {"o": "Vermont"}, {"s": base + "row/sample/02"},
    ]
    for pattern in patterns:
        assert G.diff(graph.match(**pattern), G.match(whole, **pattern)).isEmpty(), pattern
    whole.unpersist()
    plain = converted(spark, csv_file(FULL, "a b.csv"), V.PLAIN, annotated=False)
    for s in ("table/a%20b", "row/a%20b/1", "cell/a%20b/1/0"):
        assert G.diff(plain.match(V.PLAIN.base + s), G.match(plain.triples(), V.PLAIN.base + s)).isEmpty()
        assert not plain.match(V.PLAIN.base + s).isEmpty()


def test_union_and_diff(spark, csv_file):
    graph = converted(spark, csv_file(SAMPLE))
    assert G.union(graph.metadata, graph.metadata).count() == graph.metadata.count()
    assert G.diff(graph.triples(), graph.triples()).isEmpty()
    extra = G.diff(graph.triples(), graph.metadata)
    assert extra.count() == graph.data().count() and extra.filter("surplus != 1").isEmpty()


def test_quads(spark, csv_file):
    graph = converted(spark, csv_file(SAMPLE))
    column = V.TYPED.base + "column/sample/0"
    quads = G.quads({"metadata": graph.metadata, "again": graph.metadata})
    assert {(r.source, r.p) for r in G.describe(quads, column).collect()} == {
        (s, p) for s in ("metadata", "again")
        for p in (V.RDF_TYPE, *(V.TYPED.term(t) for t in ("columnName", "columnIndex", "hasAnnotation")))
    }


def test_identifiers_with_spaces_are_read_again(spark, csv_file, tmp_path):
    graph = converted(spark, csv_file("A b,C\n1,x y\n", "my table.csv"), annotated=False)
    write_lines(graph.triples(), str(tmp_path / "full"))
    assert G.diff(triples.read_triples(spark, str(tmp_path / "full")), graph.triples()).isEmpty()


def test_many_tables_in_one_conversion(spark, tmp_path):
    (tmp_path / "one two.csv").write_text("CERT,NAME\n1,a\n2,\n3,b\n")
    (tmp_path / "three.csv").write_text("CERT,NAME\n4,c\n")
    table = delimited.read_csv_tables(spark, str(tmp_path))
    graph = plans.convert(table, V.PLAIN, created=CREATED)
    assert graph.triples().count() == 2 * (3 + 4 * 2) + 3 * 4 + 4 * 7
    titles = {r.o for r in graph.match(p=V.DCTERMS + "title").collect()}
    assert titles == {"FDIC Table: one two.csv", "FDIC Table: three.csv"}
    assert graph.match(V.PLAIN.base + "cell/one%20two/2/1", V.PLAIN.term("value")).first().o == "b"
    linked = plans.convert(table, V.TYPED, bank.bank_catalogue(spark), CREATED)
    assert {(r.table_name, r.columns_mapped) for r in S.columns_mapped(linked.linked).collect()} == {("one two", 2), ("three", 2)}
    counts = {r.table_name: (r.rows_processed, r.cells) for r in S.table_counts(table).collect()}
    assert counts == {"one two": (3, 5), "three": (1, 2)}


def test_pages(spark, csv_file):
    table = delimited.read_csv_table(spark, csv_file(SAMPLE + ",,,77,,,,x\n"))
    pages = {r.page: r for r in P.pages(P.page_rows(table, V.PLAIN), 3).collect()}
    assert [(pages[i].start_row, pages[i].end_row, len(pages[i].rows)) for i in (0, 1)] == [(0, 2, 3), (3, 4, 2)]
    assert [r.row_index for r in pages[0].rows] == [0, 1, 2]
    row = pages[1].rows[1]
    assert row.cells == {"CERT": "77", "ADDRESS": "x"}
    assert row.cell_uris["ADDRESS"] == V.PLAIN.base + "cell/sample/4/7"
    assert row.cell_rdf["ADDRESS"].asDict() == {
        "uri": V.PLAIN.base + "cell/sample/4/7", "type": "fdic:Cell", "value": "x", "inRow": V.PLAIN.base + "row/sample/4",
        "inColumn": V.PLAIN.base + "column/sample/7", "columnName": "ADDRESS",
    }


def test_page_rows_of_repeated_names(spark, csv_file):
    table = delimited.read_csv_table(spark, csv_file("A,A,B\n1,2,3\n"))
    row = P.page_rows(table, V.PLAIN).first()
    assert row.cells == {"A": "2", "B": "3"} and row.cell_uris["A"].endswith("/1")


def test_preview(spark, csv_file):
    rows = "".join(f"{i},{'x' * (45 + i % 10)}\n" for i in range(30))
    first = S.preview(delimited.read_csv_table(spark, csv_file("id,t\n" + rows))).orderBy("row_index").collect()
    assert len(first) == 20
    assert first[5].t == "x" * 50 and first[6].t == "x" * 50 + "..."


def text_of(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_run_writes_everything(spark, csv_file, tmp_path):
    out = str(tmp_path / "out")
    graph = converted(spark, csv_file(FULL))
    counts = plans.run(graph, out, CREATED, rows_per_part=3, with_pages=True)
    assert (counts["rows_processed"], counts["cells"], counts["triples_generated"], counts["columns_mapped"]) == (5, 75, 573, 12)

    full = triples.read_triples(spark, f"{out}/full")
    assert G.diff(full, graph.triples()).isEmpty()
    assert G.diff(triples.read_triples(spark, f"{out}/table"), graph.metadata).isEmpty()
    chunks = triples.read_chunks(spark, f"{out}/chunks")
    assert {r.chunk for r in chunks.select("chunk").distinct().collect()} == {"chunk_0000", "chunk_0001"}
    assert G.diff(chunks, graph.data()).isEmpty()
    assert G.diff(triples.read_chunk(spark, f"{out}/chunks", "chunk_0001"), chunks.filter("chunk = 'chunk_0001'").drop("chunk")).isEmpty()
    with pytest.raises(KeyError):
        triples.read_chunk(spark, f"{out}/chunks", "chunk_0002")
    plans.sinks.write_chunks(graph.data(), f"{out}/folders", 3)
    assert G.diff(triples.read_triples(spark, f"{out}/folders"), chunks).isEmpty()
    assert len(list(Path(f"{out}/folders/chunk=chunk_0000").glob("part-*"))) == 1

    manifest = json.loads(text_of(f"{out}/table_manifest"))
    assert manifest["table_name"] == "sample" and manifest["dataset_uri"] == manifest["table_uri"] == V.TYPED.base + "table/sample"
    assert (manifest["row_count"], manifest["triple_count"], manifest["columns_mapped"], manifest["chunk_size"]) == (5, 573, 12, 3)
    assert manifest["files"]["chunks"] == ["chunk_0000", "chunk_0001"]
    results = json.loads(text_of(f"{out}/processing_results"))
    assert results["processing_results"] == {
        "table_uri": V.TYPED.base + "table/sample", "rows_processed": 5, "triples_generated": 573,
    }
    page_manifest = json.loads(text_of(f"{out}/page_manifest"))
    assert page_manifest["@type"] == "csvw:Table" and page_manifest["total_rows"] == 5
    assert page_manifest["pages"] == ["./page_0", "./page_1"]
    page = json.loads(text_of(f"{out}/pages/page_name=page_1"))
    assert (page["page"], page["start_row"], page["end_row"]) == (1, 3, 4)
    assert page["rows"][0]["cells"]["NAME"] == "Curlew Trust"
    found = documents.read_manifests(spark, f"{out}/table_manifest").first()
    assert (found.row_count, found.chunk_count) == (5, 2)


def test_lines_of_data_are_written_compressed(spark, csv_file, tmp_path):
    out = tmp_path / "out"
    graph = converted(spark, csv_file(FULL))
    plans.run(graph, str(out), CREATED, rows_per_part=3)
    for folder in (out / "full", out / "chunks" / "lines"):
        assert {p.suffix for p in folder.glob("part-*")} == {".gz"}
    assert G.diff(triples.read_triples(spark, str(out / "full")), graph.triples()).isEmpty()


def test_nodes_are_made_in_as_many_tasks_as_asked_for(spark, csv_file):
    found = sinks.nodes(converted(spark, csv_file(FULL)).triples(), limit=4)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
