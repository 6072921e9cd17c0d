"""Literal types and number texts agree with reading the text by int() and float()."""

import random
import struct

from cellweave.functions import numbers

EDGES = [
    "1", " 12 ", "+5", "-0", "007", "1_000", "1__0", "_1", "1_", "1.0f", "12d", "٣٤", "٣.٥", "1e5", "1E-7", ".5", "5.", ".",
    "-.5e3", "inf", "-Infinity", "NaN", "nan ", "+nan", "-nan", "1e400", "-1e400", "0.0", "-0.0", "0x10", "1 2", "",
    "\u00a012\u00a0", "12345678901234567890", "9" * 30, "1.7976931348623157e308", "5e-324", "1e22", "1e16", "1e15", "0.0001",
    "0.00001", "2e-3", "2.220446049250313e-16", "9007199254740993", "9007199254740993.0", "1e23", "1_0.0_1e1_0", "1_.5",
    "1._5", "1_e5", "true", "abc", "1,000", "--1", "+-1", "1e", "e5", "100", "1.10", "-00012", "-000", "0e0", "1\n", "00.5",
    "5.50", "1234567.125", "12345678.125", "0.00012345678901234567", "1" * 4300, "1" * 4301, "1_" * 3000 + "1",
    "5" * 100_000 + "x", "62701", "01234", "\ufeff1", "infinit", "i", "n",
]


def expected(text):
    try:
        return "integer", str(int(text))
    except ValueError:
        pass
    try:
        return "decimal", str(float(text))
    except ValueError:
        return None, text


def rendered(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    typed = df.withColumn("t", numbers.infer_datatype("v"))
    typed = typed.withColumn("x", numbers.lexical_form("v", "t"))
    return {r.i: (r.t.rsplit("#", 1)[1] if r.t else None, r.x) for r in typed.collect()}


def test_edge_spellings(spark):
    found = rendered(spark, EDGES)
    wrong = [(EDGES[i][:40], found[i], expected(EDGES[i])) for i in found if found[i] != expected(EDGES[i])]
    assert not wrong


def test_random_decimals(spark):
    random.seed(7)
    texts = [f"{random.uniform(-1, 1) * 10 ** random.randint(-3, 15):.{random.randint(0, 20)}f}" for _ in range(3000)]
    texts += [repr(random.uniform(-1, 1) * 10 ** random.randint(-6, 15)) for _ in range(3000)]
    found = rendered(spark, texts)
    assert [texts[i] for i in found if found[i] != expected(texts[i])] == []


def test_any_double_keeps_its_value(spark):
    random.seed(8)
    doubles = [struct.unpack("d", struct.pack("Q", random.getrandbits(64)))[0] for _ in range(3000)]
    texts = [repr(d) for d in doubles if d == d]
    found = rendered(spark, texts)
    assert all(found[i][0] == "decimal" and float(found[i][1]) == float(texts[i]) for i in found)
    # The last digit of a few very large or small numbers may differ from the closest one.
    assert sum(found[i] != expected(texts[i]) for i in found) <= 3
