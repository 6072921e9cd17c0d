"""Statements over several lines: parsing, splits, prefix scopes, rejects."""

import random

import pytest

from cellweave import vocab as V
from cellweave.sources import statements as S
from cellweave.sources import triples

X, RDF, XSD = "http://x/", V.RDF, V.XSD
TEXT = '''@prefix x: <http://x/> .   # first "quote" in a comment
@prefix : <http://empty/> .
PREFIX y: <http://y#>
@base <http://base/dir/file> .

x:a a x:Bird ; # it's one
    :name "tern" , """two
lines . "quoted" # no comment
end"""@en-GB ;
    y:b.c 1, -2.5 , 3e4, true ; ;
    x:of <other>, <#part>, <http://abs/olute?a=1#f> .
<http://s> <http://p> 'single \\'quote\\' \\u00e9 \\U0001F426' , \'\'\'it's
long\'\'\', "5"^^x:type, "t"^^<http://d> .
_:n1 x:list ( 1 x:two "three" ) , () ; x:in [ x:deep [ ] ; a x:Node ] .
[ x:alone "yes" ] . x:last x:on "one line" . x:and x:more _:n1.
'''
WANTED = [
    ("http://x/a", RDF + "type", "http://x/Bird", "iri", None, None),
    ("http://x/a", "http://empty/name", "tern", "literal", None, None),
    ("http://x/a", "http://empty/name", 'two\nlines . "quoted" # no comment\nend', "literal", None, "en-GB"),
    *[("http://x/a", "http://y#b.c", v, "literal", XSD + t, None) for v, t in (("1", "integer"), ("-2.5", "decimal"), ("3e4", "double"), ("true", "boolean"))],
    *[("http://x/a", "http://x/of", o, "iri", None, None) for o in ("http://base/dir/other", "http://base/dir/file#part", "http://abs/olute?a=1#f")],
    ("http://s", "http://p", "single 'quote' é \U0001F426", "literal", None, None),
    ("http://s", "http://p", "it's\nlong", "literal", None, None),
    ("http://s", "http://p", "5", "literal", "http://x/type", None),
    ("http://s", "http://p", "t", "literal", "http://d", None),
    ("_:n1", "http://x/list", RDF + "nil", "iri", None, None),
    ("http://x/last", "http://x/on", "one line", "literal", None, None),
    ("http://x/and", "http://x/more", "_:n1", "bnode", None, None),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["one split", "many"])
def splits(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    if request.param == "many":
        spark.conf.set(names[0], "48")
        spark.conf.set(names[1], "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_statements_over_lines(spark, tmp_path, splits):
    (tmp_path / "a.ttl").write_text(TEXT)
    found = S.read_statements(spark, str(tmp_path / "a.ttl"))
    assert found.rejects.count() == 0
    all_rows = rows(found.triples)
    nodes = [r for r in all_rows if r[0].startswith("_:f") or r[2].startswith("_:f")]
    assert sorted((r for r in all_rows if r not in nodes), key=repr) == sorted(WANTED, key=repr)
    # a list of three and three nested nodes, one of them without statements of its own
    firsts = [r[2] for r in nodes if r[1] == RDF + "first"]
    assert sorted(firsts) == ["1", "http://x/two", "three"] and sum(r[1] == RDF + "rest" for r in nodes) == 3
    heads = {r[2] for r in nodes if r[0] == "_:n1"}
    assert len(heads) == 2 and any(r[1] == "http://x/alone" and r[2] == "yes" for r in nodes)
    assert {r[2] for r in nodes if r[1] == "http://x/deep"} & {r[0] for r in nodes} == set()


def test_prefixes_hold_from_their_declaration_on(spark, tmp_path, splits):
    (tmp_path / "a.ttl").write_text(
        "x:early x:p 1 .\n@prefix x: <http://one/> .\nx:a x:b x:c .\n\n@prefix x: <http://two/> .\nx:a x:b x:c , z:lost .\n"
    )
    (tmp_path / "b.ttl").write_text("x:other x:p 1 .\nPREFIX x: <http://b/>\nx:a x:b \"\"\"x:c .\n\"\"\" .\n")
    found = S.read_statements(spark, str(tmp_path))
    assert rows(found.triples.select("s", "p", "o")) == [
        ("http://b/a", "http://b/b", "x:c .\n"), ("http://one/a", "http://one/b", "http://one/c"), ("http://two/a", "http://two/b", "http://two/c"),
    ]
    rejects = [(r["file"][-5:], r["line"], r["reason"]) for r in found.rejects.collect()]
    assert sorted(rejects) == [
        ("a.ttl", 1, "prefix not declared: x"), ("a.ttl", 6, "prefix not declared: z"), ("b.ttl", 1, "prefix not declared: x"),
    ]


def test_rejects_are_listed_with_file_and_line(spark, tmp_path, splits):
    (tmp_path / "a.nt").write_text(
        '<http://a> <http://b> "c" .\n# fine\n\nthis is no triple .\n<http://a> <http://b>\n  "d" .\n<http://a> "p" "o" .\n'
        '<http://a> <http://b> "bad \\q" .\n<http://a> <http://b> <http://e> .\n"s" <http://b> 1 .\n<http://a> <http://b> "never ended\n'
    )
    found = S.read_statements(spark, str(tmp_path))
    assert sorted(r[2] for r in rows(found.triples)) == ["c", "d", "http://e"]
    rejects = {r["line"]: r["text"] for r in found.rejects.collect()}
    assert sorted(rejects) == [4, 7, 8, 10, 11] and rejects[4] == "this is no triple ."
    assert S.read_statements(spark, str(tmp_path / "a.nt")).rejects.count() == 5


def test_states_agree_with_whole_texts():
    """Cutting a text into statements line by line gives the triples of the whole text."""
    r = random.Random(2)
    objects = ['"a . b"', "'# no'", '"""x\n. y"""', "'''\n'''", "<http://o#1>", "1.5", "x:a.b", "[ x:p 'q' ]", '"\\"" # end .\n', '""', "''"]
    for _ in range(400):
        text = "@prefix x: <http://x/> .\n"
        for _ in range(r.randint(1, 6)):
            text += "x:s" + r.choice([" ", "\n"]) + "x:p " + r.choice([" , ", ",\n"]).join(r.choice(objects) for _ in range(r.randint(1, 3))) + r.choice([" .\n", ".\n", " . # c\n", " . "])
        state, held, found = S.BETWEEN, [], []
        for line in text.split("\n"):
            if state == S.BETWEEN and (not line.strip() or line.strip().startswith("#")):
                continue
            held.append(line)
            state = S.after(line, state)
            if state == S.BETWEEN:
                found += S.Statement("\n".join(held), "n").triples
                held = []
        assert not held
        whole = S.Statement(text, "n").triples
        unnamed = lambda t: [x if not str(x).startswith("_:n") else "_" for x in t]
        assert [*map(unnamed, found)] == [*map(unnamed, whole)]


def test_lines_that_are_no_triples_raise_or_are_told(spark, tmp_path):
    (tmp_path / "a.nt").write_text('<http://a> <http://b> "c" .\n\n# fine\n<http://a> <http://b> "open .\nnonsense\n<http://a> <http://b> _:n .\n')
    (tmp_path / "b.nt").write_text('<http://a> <http://b> "\\U0001F426\\\\U0001F426 \\U0000005C \\u00e9\\t\\"" .\n')
    told = {(r["file"][-4:], r["line"]): r["text"] for r in triples.unreadable_lines(spark, str(tmp_path)).collect()}
    assert told == {("a.nt", 4): '<http://a> <http://b> "open .', ("a.nt", 5): "nonsense"}
    with pytest.raises(Exception, match="Not a triple"):
        triples.read_triples(spark, str(tmp_path)).collect()
    assert [r["o"] for r in triples.read_triples(spark, str(tmp_path / "b.nt")).collect()] == ['\U0001F426\\U0001F426 \\ é\t"']


def test_parts_of_a_line_are_worked_out_once(spark, tmp_path):
    """A filter on them is not put before them, where each of its uses would look for them again."""
    (tmp_path / "a.nt").write_text('<s> <p> "o"@en .\n\n# nothing\n  _:s\t<p>  <o>  .  \n<s> <p> "1 \\"2\\" 3"^^<d> .\n')
    found = triples.read_triples(spark, str(tmp_path / "a.nt"))
    assert found._jdf.queryExecution().executedPlan().toString().count("regexp_extract") == 3
    assert sorted(tuple(r) for r in found.select("s", "p", "o", "o_kind").collect()) == [
        ("_:s", "p", "o", "iri"), ("s", "p", '1 "2" 3', "literal"), ("s", "p", "o", "literal"),
    ]
