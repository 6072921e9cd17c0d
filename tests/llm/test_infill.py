"""Fill-in-middle against a version that cuts lists of units."""

import hashlib
import random
import re
from collections import Counter

import pytest

from cellweave.llm import infill

PARTS = ["abc", "Z", "é", "日本", "\U0001F600", " ", "\n", "1", "<P", "<P>", "<S>", "<M>", ">", "xyzzy", "-"]


def brute(doc, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def rows(monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice(PARTS[: 8 if i % 3 else 15]) for _ in range(r.randint(0, 40))) for i in range(200)]
    texts += ["word " * 3000, "a" * 700_000, "日" * 400_000, "é1" * 300_000, "<P>" * 2000, "ab" * 300_000 + "é" * 300_000]
    return [(i, t, "en") for i, t in enumerate(texts)] + [(901, None, None), (None, "no id here", "en"), (3, texts[3], "en"), (3, texts[3], "en"), (-5, "x y", "en")]


def test_outputs_and_restored_texts(docs, rows):
    pieces = infill.reorder(docs(rows))
    assert Counter(map(tuple, infill.restore(pieces).select("doc_id", "text").collect())) == Counter((i, t or "") for i, t, _ in rows)
    expected, told = Counter(), Counter()
    for i, t, _ in rows:
        n, form, p, m, out = brute(i, t)
        expected[(i, form, out)] += 1
        told[(i, n, form, p, m, digest(out), digest(t or ""))] += 1
    assert Counter(map(tuple, infill.outputs(pieces).collect())) == expected
    assert Counter(map(tuple, infill.digests(pieces).collect())) == told
    assert {form for _, form, _ in expected} == {"plain", "psm", "spm"}


def test_pieces_are_bounded_and_whole_units(docs):
    pieces = infill.reorder(docs([(1, "ab " * 20_000 + "c" * 600_000, "en"), (2, "", "en")])).collect()
    assert max(len(x["text"]) for x in pieces) <= infill.PIECE_BYTES
    by_form = [x for x in pieces if x["doc_id"] == 1]
    assert len(by_form) > 20 and [x["at"] for x in by_form] == sorted(x["at"] for x in by_form)
    assert [bytes(x["text"]) for x in pieces if x["doc_id"] == 2] == [b""]


def test_units_over_blocks(monkeypatch):
    monkeypatch.setattr(infill, "BLOCK", 7)
    monkeypatch.setattr(infill, "PIECE_UNITS", 3)
    for seed in range(300):
        r = random.Random(seed)
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 30)))
        u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        units = infill.Units(text.encode())
        assert units.n == len(u)
        a, b = sorted((r.randint(0, len(u)), r.randint(0, len(u))))
        assert b"".join(infill._cut(text.encode(), [*units.places(a, b)])).decode() == "".join(u[a:b])


def test_no_documents_and_one_shuffle(docs):
    assert infill.digests(infill.reorder(docs([]))).count() == 0
    plan = infill.digests(infill.reorder(docs([(1, "a b", "en")])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
