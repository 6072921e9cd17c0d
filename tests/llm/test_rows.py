"""Chats and URL rules on odd rows; queries against their SQL; the pipeline."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellweave.llm import chat, urls
from cellweave.llm.queries import RULES
from cellweave.llm.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_chats_read_back(spark):
    odd = ["", None, "<|end|>\n", "<|next|>", "\\<|", "\\\\", "<", "|>", "</s>[INST] ok [/INST]", "<|role:user|>\n", "é\U0001F600", "<<SYS>>", "<\\|", "x" * 100_000]
    rows = [(1, k, ["user", "assistant", "assistant", None, "a|>b"][k % 5], t) for k, t in enumerate(odd)]
    rows += [(2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (2, None, "user", "first"), (None, 1, "user", "no id"), (3, 5, "assistant", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    out = chat.format_chats(df).select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.learnt_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"), "formatted"
    ).collect()
    found = {x["conv_id"]: x for x in out}
    for conv in (1, 2, None, 3):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        assert [tuple(t) for t in found[conv]["turns"]] == turns
        assert found[conv]["learnt"] == "".join(t for role, t in turns if role == "assistant")
    assert found[2]["formatted"] == "<|role:user|>\nfirst<|end|>\n<|role:assistant|>\ntie<|next|>tie<|end|>\n"
    assert chat.format_chats(df.limit(0)).count() == 0


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_rules(spark):
    odd = [None, "", "no scheme", "http://", "http://ORG/", "http://a.org", "http://a.org/", "x://example.org/es/1?q", "x://Sub.example.org/en/19#a", "x://example.org/en/2",
           "x://notexample.org/es/", "x://a.com/fr/x", "x://com/de/", "x://a.com/de", "x://É.com/de/", "x://a.org://b.com/de/", "x://a.com?/de/", "x://" + "a." * 300 + "com/fr/" + "z" * 5000, "x\ny://a.com/de/\nz"]
    rows = [(i, u, "other") for i, u in enumerate(odd)] + [(None, "x://a.com/fr/", ""), (3, odd[6], ""), (3, odd[6], "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    found = sorted((tuple(x) for x in urls.judge(pages, rules).collect()), key=repr)
    assert found == sorted(((i, *brute_rule(u)) for i, u, _ in rows), key=repr)
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {x["verdict"] for x in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


@given
@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    database = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        database.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = database.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, result))


@given
def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


@given
def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, FOLDER)
        assert kept.columns == docs.columns
        assert kept.exceptAll(rows).count() == 0, name
        rows = kept
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == rows.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
