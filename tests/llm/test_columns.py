"""Pipeline stages on documents whose other columns have odd names and types: rows go or stay, columns stay as they are."""

import random

import pytest

from cellweave.llm import language, near_duplicates, quality

EXTRA = "`a b` int, `x:y` string, `a.b` map<string,int>, _row_key long, `row` struct<q:int>, text_a array<string>, `key` int, `lang_pred` double"


@pytest.fixture
def rows(spark):
    r = random.Random(3)
    words = {"en": ["the", "and", "water", "house", "over"], "fi": ["talo", "vesi", "ja", "yli", "joki"]}
    out = []
    for i in range(60):
        lang = "en" if i % 2 else "fi"
        text = " ".join(r.choice(words[lang]) + r.choice(["", "n", "s", "a"]) for _ in range(40))
        out.append((i, text, lang, i, "x", {"k": i}, 7 * i, (i,), ["t"], -i, 0.5))
    out += [(100, out[3][1], "en", 1, None, None, 9, None, None, None, None), (101, None, None, None, None, None, None, None, None, None, None)]
    schema = f"doc_id long, text string, lang string, {EXTRA}"
    return out, spark.createDataFrame(out, schema)


@pytest.mark.parametrize("stage", ["language", "quality", "near duplicates"])
def test_columns_stay(spark, rows, stage):
    given, docs = rows
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    kept = {
        "language": lambda: language.keep_known(docs), "quality": lambda: quality.keep_good(docs, labels),
        "near duplicates": lambda: near_duplicates.keep_first(docs),
    }[stage]()
    assert kept.schema.names == docs.schema.names
    found = {x["doc_id"]: tuple(x) for x in kept.collect()}
    by_id = {x[0]: x for x in map(tuple, docs.collect())}
    assert len(found) >= 55 and all(by_id[i] == x for i, x in found.items())
    assert (100 in found) == (stage != "near duplicates") and (101 in found) == (stage == "near duplicates")
