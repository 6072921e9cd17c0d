from urllib.parse import quote

from pyspark.sql import functions as F

from cellweave.functions import terms

TEXTS = [
    "a b*~+é/?#", "%7E", "a%b", "日本", "", "plain", 'say "hi"', "two\nlines\r\n", "back\\slash", "\\n", '\\\\"', "tab\there",
    "\\\\\\n", "ends in \\",
]


def column(spark, expression, texts=TEXTS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_percent_encode(spark):
    assert column(spark, terms.percent_encode("x")) == [quote(t, safe="") for t in TEXTS]


def test_node_url(spark):
    assert column(spark, terms.node_url("x", "/index.html")) == ["/index.html?node=" + quote(f"<{t}>") for t in TEXTS]


def test_escape_and_back(spark):
    def escape(t):
        return t.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r")

    assert column(spark, terms.escape_literal("x")) == [escape(t) for t in TEXTS]
    assert column(spark, terms.unescape_literal(terms.escape_literal("x"))) == TEXTS


def test_unescape_unicode(spark):
    assert column(spark, terms.unescape_literal("x"), ["\\u0041\\n", "x\\ty"]) == ["A\n", "x\ty"]


def test_blank(spark):
    texts = [" ", "\t\n", "\u00a0", "\x1c", "\u3000 ", "a", " a ", "0", None]
    assert column(spark, terms.is_present("x"), texts) == [bool(t and t.strip()) for t in texts]


def test_names(spark):
    paths = ["/a/b.csv", "b.tar.gz", ".hidden", "plain", "x/y/"]
    assert column(spark, terms.file_stem("x"), paths) == ["b", "b.tar", ".hidden", "plain", ""]
    assert column(spark, terms.last_segment("x"), paths) == ["b.csv", "b.tar.gz", ".hidden", "plain", ""]
    names = ["Column Name!", "Column-Name", "a_b", "é"]
    assert column(spark, terms.safe_identifier("x"), names) == [
        "column_Column_Name_", "column_Column-Name", "column_a_b", "column__",
    ]


def test_part_names(spark):
    df = spark.range(1).select(terms.chunk_name(F.lit(7)).alias("c"), terms.chunk_name(F.lit(12345)).alias("d"), terms.page_name(F.lit(3)).alias("p"))
    assert tuple(df.first()) == ("chunk_0007", "chunk_12345", "page_3")
