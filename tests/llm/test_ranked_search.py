"""Ranked search against a version that scores every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import ranked_search as search

WORDS = ["tern", "Heron", "ÉTÉ", "été", "x1", "a-b", "日本", "the", "the", "the", "of", "reed", "REED", "q_r", "İ"]


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, k=10):
    counted = [(doc, Counter(terms(t))) for doc, t in docs if terms(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in {*terms(text)} if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def texts(n, seed):
    r = random.Random(seed)
    words = WORDS + [f"w{i}" for i in range(60)]
    return [r.choice([" ", ", ", "\n"]).join(r.choice(words) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.fixture(params=["one tree", "many"])
def sizes(request, monkeypatch):
    if request.param == "many":
        for name, value in (("TREE_ROWS", 40), ("LEAF", 4), ("FIRST", 16), ("BLOCK_ITEMS", 3), ("SPLIT", 9)):
            monkeypatch.setattr(search, name, value)


def test_results_by_brute_force(spark, docs, sizes):
    made = texts(300, 5)
    rows = [(i, t, "en") for i, t in enumerate(made)] + [(1000 + i, made[7], "en") for i in range(30)]
    rows += [(700, None, None), (701, "", "en"), (702, " -_- ", "en"), (None, made[3], "en"), (None, made[4], "en"), (3, made[3], "en"), (703, "tern " * 9000, "en")]
    items = [(i, t) for i, t in enumerate(texts(12, 9))] + [(50, None), (51, "..."), (4, made[7]), (4, made[7]), (None, "heron reed"), (52, "nowhere")]
    table = spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, rank string")
    found = search.search(docs(rows), table)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute([x[:2] for x in rows], items)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.search(docs([]), items).count() == 0
    assert search.search(docs([(1, "a b", "en")]), items.where("false")).count() == 0


def random_vectors(n, n_terms, seed):
    r = np.random.default_rng(seed)
    rows = [np.sort(r.choice(n_terms, r.integers(1, 9), replace=False)) for _ in range(n)]
    ptr = np.cumsum([0, *(len(x) for x in rows)])
    return search.Vectors(list(range(n)), ptr, np.concatenate(rows).astype(np.int32), r.integers(1, 10**10, int(ptr[-1])))


def test_bounds_hold_and_prune():
    # two hundred groups of alike documents: subtrees of other groups need no look
    rows = random_vectors(200, 500, 3)
    take = np.repeat(np.arange(200), 20)
    np.random.default_rng(4).shuffle(take)
    lists = [(rows.terms[rows.ptr[i] : rows.ptr[i + 1]], rows.values[rows.ptr[i] : rows.ptr[i + 1]]) for i in take]
    many = search.Vectors(list(range(4000)), np.cumsum([0, *(len(t) for t, _ in lists)]), np.concatenate([t for t, _ in lists]), np.concatenate([v for _, v in lists]))
    tree = search.BallTree(many, 500)
    r, mark, scored = np.random.default_rng(1), np.zeros(500, np.int64), 0
    for trial in range(40):
        item = lists[int(r.integers(4000))][0] if trial % 2 else np.sort(r.choice(500, 6, replace=False))
        scores = np.array([int(v[np.isin(t, item)].sum()) for t, v in lists])
        ball, best = tree.bounds(item), []
        for node, (a, b) in enumerate(tree.ranges):
            assert scores[tree.order[a:b]].max() <= ball[node]
        mark[item] = 1

        def offer(found, at):
            best.extend(zip(found, at, strict=True))
            best.sort(reverse=True)
            del best[10:]
            return best[-1][0] if len(best) == 10 else 0

        scored += tree.search(item, mark, 0, offer)
        mark[item] = 0
        assert [s for s, _ in best] == [s for s in np.sort(scores)[::-1][:10].tolist() if s > 0]
    assert scored < 40 * 4000 / 4
