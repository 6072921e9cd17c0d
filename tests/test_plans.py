"""Plans at scale: what must not shuffle does not, and nothing goes through one task."""

import pytest
from pyspark.sql import functions as F

from cellweave import session
from cellweave import vocab as V
from cellweave.operators import cells as C
from cellweave.operators import emit as E
from cellweave.operators import graph as G
from cellweave.operators import index as I
from cellweave.operators import pages as P
from cellweave.operators import summary as S
from cellweave.operators.hot import split_groups
from cellweave.plans.convert import convert
from cellweave.sinks.graph import nodes
from cellweave.sources.table import source_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def folder(spark, tmp_path):
    """A table in several files, none of which is small against the number of cores."""
    df = spark.range(0, 40_000, 1, 8).select(
        "id", F.concat(F.lit("name "), "id").alias("name"), (F.col("id") / 4).alias("price"),
        F.when(F.col("id") % 3 == 0, F.lit("  ")).otherwise(F.lit("x")).alias("note"), F.lit("unused").alias("other"),
    )
    df.write.parquet(str(tmp_path / "t"))
    return str(tmp_path / "t")


def test_positions_in_many_files(spark, folder):
    table = I.read_parquet_table(spark, folder, "t")
    assert table.frame.filter("row_index != c0").isEmpty() and table.frame.count() == 40_000
    first = I.read_parquet_table(spark, folder, "t", max_rows=7_000)
    assert first.frame.count() == 7_000 and first.frame.agg(F.max("c0")).first()[0] == 6_999


def test_positions_by_pieces_of_many_offsets(spark, folder, monkeypatch):
    # Two offsets fill a broadcast here, so the eight files are placed in four pieces.
    monkeypatch.setattr(session, "BROADCAST_BYTES", 2 * session.ROW_BYTES)
    frame = I.read_parquet_table(spark, folder, "t").frame
    text = plan(frame)
    assert text.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text
    assert frame.filter("row_index != c0").isEmpty() and frame.count() == 40_000


def test_a_small_table_is_not_shuffled(spark, tmp_path):
    spark.range(0, 3000, 1, 1).write.parquet(str(tmp_path / "one"))
    assert "Exchange" not in plan(I.read_parquet_table(spark, str(tmp_path / "one"), "one").frame)
    wide = I.read_parquet_table(spark, str(tmp_path / "one"), "one", partitions=6).frame
    assert "Exchange" in plan(wide) and wide.filter("row_index != c0").isEmpty()


def test_melt_and_emit_do_not_shuffle(spark, folder):
    table = I.read_parquet_table(spark, folder, "t")
    for profile, cells in ((V.TYPED, C.type_cells(C.melt(table), table)), (V.PLAIN, C.plain_cells(C.melt(table)))):
        text = plan(E.cell_triples(cells, table, profile))
        assert "Exchange hashpartitioning" not in text and "RoundRobin" not in text and "SortMergeJoin" not in text
        # The one exchange is that of the few file offsets.
        assert text.count("Exchange") == text.count("BroadcastExchange")
        assert "SinglePartition" not in text


def test_only_needed_columns_are_read(spark, folder):
    table = I.read_parquet_table(spark, folder, "t")
    schema = plan(C.melt(table, columns=[0, 3])).split("ReadSchema: ")[1]
    assert "id:bigint" in schema and "note:string" in schema and "name" not in schema and "price" not in schema


def test_source_filters_reach_the_scan(spark, folder):
    table = I.read_parquet_table(spark, folder, "t").where(F.col("c0") > 39_000)
    assert "GreaterThan(id,39000)" in plan(C.melt(table)).replace(" ", "")


def test_counts_do_not_melt(spark, folder):
    table = I.read_parquet_table(spark, folder, "t")
    text = plan(S.conversion_summary(table, V.TYPED))
    assert "Expand" not in text and "Generate" not in text
    counts = S.table_counts(table).first()
    assert counts.cells == C.melt(table).count()


def test_row_index_uses_all_partitions(spark):
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") * 7919 % 50_021).alias("k"), (F.col("id") % 3).alias("g"))
    numbered = I.with_row_index(df, ["g", "k"])
    assert "SinglePartition" not in plan(numbered.filter("row_index >= 0")).split("BroadcastExchange")[0]
    rows = [(r.g, r.k) for r in numbered.orderBy("row_index").collect()]
    assert rows == sorted(rows)
    assert numbered.agg(F.min("row_index"), F.max("row_index"), F.countDistinct("row_index")).first() == (0, 49_999, 50_000)


def test_row_index_with_one_value_in_a_third_of_rows(spark):
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"), "id")
    numbered = I.with_row_index(df, ["k", "id"])
    rows = [(r.k, r.id) for r in numbered.orderBy("row_index").collect()]
    assert rows == sorted(rows) and len(rows) == 30_000


def test_groups_are_bounded(spark):
    df = spark.range(0, 30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("s"), "id")
    sizes = split_groups(df, "s", ["id"], 500).groupBy("s", "part").count()
    assert sizes.agg(F.max("count")).first()[0] < 700
    assert sizes.agg(F.sum("count")).first()[0] == 30_000
    assert sizes.filter("s != 'hot' and part > 0").isEmpty()


def test_table_node_with_many_rows_comes_in_parts(spark):
    """In the plain profile the table's node has a triple per row."""
    df = spark.range(3000).select(F.col("id").alias("row_index"), "id")
    rows = E.row_triples(source_table(df, "t"), V.PLAIN)
    found = nodes(rows, limit=200)
    table = found.filter(F.col("s") == V.PLAIN.base + "table/t")
    assert 10 <= table.count() <= 20
    links = table.select(F.explode(F.from_json(F.get_json_object("node", "$['" + V.PLAIN.ontology + "row']"), "array<struct<`@id`:string>>")).alias("r"))
    assert links.select("r.@id").distinct().count() == 3000


def test_pages_gather_at_most_a_page(spark):
    df = spark.range(2500).select(F.col("id").alias("row_index"), "id")
    sizes = P.pages(P.page_rows(source_table(df, "t"), V.PLAIN), 100).select(F.size("rows").alias("n")).collect()
    assert len(sizes) == 25 and {r.n for r in sizes} == {100}


def test_rebuild_gives_the_table_back(spark, folder):
    table = I.read_parquet_table(spark, folder, "t", max_rows=3000)
    graph = convert(table, V.PLAIN)
    cells = graph.cell_triples(G.rebuild_predicates(V.PLAIN))
    back = G.rebuild(cells, table.names, V.PLAIN, graph.metadata)
    wanted = table.frame.select(
        F.concat(F.lit(V.PLAIN.base + "row/t/"), "row_index").alias("row_iri"),
        *[F.when(table.present(i), table.text(i)).alias(n) for i, n in enumerate(table.names)],
    )
    assert back.exceptAll(wanted).isEmpty() and wanted.exceptAll(back).isEmpty()


def test_census_without_and_with_repeats(spark, folder):
    graph = convert(I.read_parquet_table(spark, folder, "t", max_rows=1000), V.TYPED).triples()
    once = {r["class"]: r.instances for r in S.class_census(graph, unique=True).collect()}
    twice = {r["class"]: r.instances for r in S.class_census(graph.unionByName(graph)).collect()}
    assert once == twice and once[V.TYPED.term("Row")] == 1000


def test_one_row_is_read_from_its_file_only(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(4000).repartitionByRange(10, "id").sortWithinPartitions("id").withColumn("t", F.concat(F.lit("text "), "id")).write.parquet(path)
    table = I.read_parquet_table(spark, path, "t")
    one = table.at(2345)
    assert [tuple(r) for r in one.frame.collect()] == [(2345, 2345, "text 2345")]
    assert one.frame.rdd.getNumPartitions() == 1 and table.frame.rdd.getNumPartitions() > 1
    assert table.at(4000).frame.isEmpty()
    graph = convert(table, V.TYPED)
    found = graph.match(s=V.TYPED.base + "row/t/2345")
    assert found.count() == 3 and G.diff(found, G.match(graph.triples(), s=V.TYPED.base + "row/t/2345")).isEmpty()
    assert convert(I.read_parquet_table(spark, path, "t", max_rows=10), V.TYPED).match(s=V.TYPED.base + "row/t/2345").isEmpty()


def test_tasks_have_a_bounded_number_of_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40_000).coalesce(1).write.parquet(path)
    frame = I.read_parquet_table(spark, path, "t", task_rows=4096).frame
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 20_000 and sum(sizes) == 40_000
    assert frame.filter("row_index <> c0").isEmpty()
    assert "Exchange" not in plan(I.read_parquet_table(spark, path, "t", task_rows=40_000).frame)
