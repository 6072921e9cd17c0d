"""Joins with a key in most rows, and lookups of prefixes by ranges, beside plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from cellweave import session
from cellweave.operators import annotations as A
from cellweave.operators import graph as G
from cellweave.operators import hot
from cellweave.operators import prefixes as X


@pytest.fixture
def large_sides(spark, monkeypatch):
    """No side counts as small, and nothing is planned anew while it runs."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    rows = [x[0] for x in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(rows) / sum(rows)


def test_hot_keys_by_a_sketch(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 8, "b").otherwise(F.col("id").cast("string")).alias("k"))
    assert sorted(hot.hot_keys(df, "k")) == ["a", "b"] and hot.hot_keys(df.filter("false"), "k") == []
    assert hot.hot_keys(spark.range(1000).withColumnRenamed("id", "k"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_join_equals_a_plain_one(spark, large_sides, how):
    left = spark.range(5000).select("id", F.when(F.col("id") % 10 > 0, 7).when(F.col("id") % 100 > 0, F.col("id") % 50).alias("k"))
    right = spark.range(60).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    found, wanted = hot.skew_join(left, right, "k", how), left.join(right, "k", how)
    assert found.columns == wanted.columns
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_no_task_gets_a_hot_key_whole(spark, large_sides):
    most = F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    rows = spark.range(0, 20_000, 1, 8).withColumn("k", most)
    triples = rows.select(F.col("k").alias("s"), F.lit("p").alias("p"), F.col("id").cast("string").alias("o"))
    nodes = rows.select(F.col("k").alias("node"))
    assert largest_share(G.describe_all(triples, nodes)) < 0.2
    columns = rows.select(F.col("k").alias("column_name"), "id")
    lookup = rows.select(F.col("k").alias("column_name")).distinct().withColumn("annotation_iri", F.col("column_name"))
    assert largest_share(A.link_columns(columns, lookup)) < 0.2
    names = rows.select(F.concat("k", F.lit(":x"), "id").alias("name"))
    table = rows.select(F.col("k").alias("prefix")).distinct().withColumn("namespace", F.concat(F.lit("http://"), "prefix", F.lit("/")))
    found = X.expand_by_table(names, "name", table, "iri")
    assert largest_share(found) < 0.2 and found.filter(~F.col("iri").startswith("http://")).isEmpty() and found.count() == 20_000


@pytest.mark.parametrize("hot_text", [False, True])
def test_prefixes_by_ranges(spark, hot_text):
    r = random.Random(7)
    parts = ["a", "b", "é", "/", "a/", "\U0010FFFF", "ÿ"]
    word = lambda n: "".join(r.choice(parts) for _ in range(r.randint(0, n)))
    spaces = [(i, f"p{i}", word(4)) for i in range(60)]
    iris = [word(7) for _ in range(400)] + ["", None] + (["a/a/b"] * 3000 if hot_text else [])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(iris)], "n int, x string")
    table = spark.createDataFrame(spaces, "ordinal int, prefix string, namespace string")

    def short(x):
        for _, p, n in sorted(spaces):
            if x is not None and x.startswith(n):
                return f"{p}:{x[len(n):]}"
        return x

    found = {r["n"]: r["y"] for r in X.compact_by_table(df, "x", table, "y").collect()}
    assert found == {i: short(x) for i, x in enumerate(iris)}
    assert X.compact_by_table(df, "x", table.filter("false"), "y").filter("NOT (y <=> x)").isEmpty()
