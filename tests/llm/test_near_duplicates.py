"""Links and components against all pairs compared by brute force."""

import random

import numpy as np
import pytest

from cellweave.llm import near_duplicates as near
from cellweave.llm import words


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent=80):
    sets = [shingle_set(t, size) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _, _) in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        component = min(ids) if ids else None
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=repr)


def edited(text, r, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("size", [2, 5])
def test_components_are_those_of_all_pairs(docs, size):
    r = random.Random(size)
    rows = []
    passage = " ".join(f"p{i}" for i in range(60))
    for group in range(6):
        base = " ".join(f"w{r.randrange(3000)}" for _ in range(150))
        rows += [(len(rows) + k, edited(base, r, r.choice([0, 0.01, 0.02, 0.04, 0.06])), "en") for k in range(12)]
    for _ in range(25):
        rows.append((len(rows), passage + " " + " ".join(f"q{r.randrange(10**6)}" for _ in range(r.choice([5, 10, 25]))), "en"))
    rows += [(1000, None, None), (1001, "", "en"), (1002, " \n\t", "en"), (1003, "One", "en"), (1004, "oNE ", "en"), (1005, "É é", None),
             (None, rows[0][1], "en"), (None, "nothing like it at all", "en"), rows[3], rows[3], (1006, "w " * 60_000, "en")]
    r.shuffle(rows)
    found = near.near_duplicates(docs(rows), size)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, size)


def test_empty_table(docs):
    assert near.near_duplicates(docs([]), 5).count() == 0
    assert near.keep_first(docs([])).count() == 0


def test_one_of_each_group_stays(docs):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text, "en"), (3, text.upper(), "de"), (3, text.upper(), "de"), (9, "", None), (8, None, None), (None, text, None), (None, "b c", None), (None, "b c", None)]
    kept = near.keep_first(docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    assert sorted((tuple(x) for x in kept.collect()), key=repr) == sorted(
        [(3, text.upper(), "de", 7), (9, "", None, 7), (8, None, None, 7), (None, "b c", None, 7)], key=repr
    )


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(f"word{i}" for i in range(2000)).encode() + b" " + b"y" * 900 + b" end"
    whole = words.word_hashes(text)[0]
    assert len(set(whole.tolist())) == 2002
    assert (words.word_hashes(b"  " + text)[0] == whole).all()
    monkeypatch.setattr(words, "CHUNK", 512)
    pieces = words.word_hashes(text)[0]
    long = 2000
    assert (np.delete(pieces, long) == np.delete(whole, long)).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {x["node"]: x["label"] for x in near.components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}
