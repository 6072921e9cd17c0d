"""Languages, quality rules, phrase fingerprints, licences: against brute force, labels and held-out documents."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import fingerprints, language, licences, quality

WORDS = {"en": "the of and that with from there which could would".split(), "fr": "le la dans que avec pour était leçon être où".split(), "de": "der die und nicht über für straße größe wird auch".split()}


def sentence(lang, r, n=30):
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


def language_rows():
    r = random.Random(4)
    rows = [(i, sentence(lang, r), lang) for i in range(240) for lang in [r.choice([*WORDS])]]
    return rows + [(1000, None, "en"), (1001, "12 34 !!", "fr"), (1002, "", None), (None, sentence("de", r), None), (1003, sentence("fr", r, 9000), None)]


def test_language_of_held_out_documents(docs):
    rows = language_rows()
    found = language.identify(docs(rows)).collect()
    truth = {i: lang for i, t, lang in rows if t and lang and i < 1000}
    assert len(found) == len(rows)
    for x in found:
        held = x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1
        assert x["held_out"] == held and 0 <= x["score"] <= 1
        if x["doc_id"] in truth:
            assert x["lang_pred"] == truth[x["doc_id"]]
    special = {x["doc_id"]: x["lang_pred"] for x in found if x["doc_id"] not in truth}
    assert special == {1000: "und", 1001: "und", 1002: "und", None: "de", 1003: "fr"}
    kept = language.keep_known(docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.count() == len(rows) - 3
    assert kept.where("score = 7").count() == kept.count()


def test_languages_written_without_spaces(docs):
    r = random.Random(12)
    letters = {"ja": "のをはがにでとしてるいたなもこれあり", "th": "กขคงจชดตทนบปพมยรลวสหอ", "en": "the and "}
    rows = [(i, "".join(r.choice(letters[lang]) for _ in range(200)), lang) for i in range(240) for lang in [r.choice([*letters])]]
    found = {x["doc_id"]: x for x in language.identify(docs(rows)).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows)
    assert any(x["held_out"] for x in found.values())


def plain_probabilities(net, text):
    """Position by position, gate by gate; means over all positions of all pieces."""
    sigmoid = lambda a: 1 / (1 + np.exp(-a))
    total, n, k = 0, 0, net.u.shape[1]
    for piece in language.pieces(text):
        codes = b" %s " % piece
        logits = [net.c.astype(float).copy() for _ in codes]
        for d in range(2):
            h = np.zeros(k)
            for t in range(len(codes)) if d == 0 else reversed(range(len(codes))):
                a, b = net.x[d][codes[t]].astype(float), h @ net.u[d].astype(float)
                z, reset = sigmoid(a[:k] + b[:k]), sigmoid(a[k : 2 * k] + b[k : 2 * k])
                candidate = np.tanh(a[2 * k :] + reset * b[2 * k :])
                h = (1 - z) * candidate + z * h
                logits[t] += h @ net.v[d]
        for x in logits:
            total = total + np.exp(x) / np.exp(x).sum()
            n += 1
    return total / n


def test_reading_by_brute_force(monkeypatch):
    r = random.Random(8)
    net = language.train([(lang, sentence(lang, r)) for lang in WORDS for _ in range(20)], steps=30)
    texts = [sentence(lang, r).encode() for lang in WORDS] + ["straße".encode() * 40, b"x", "日本語の文".encode() * 30]
    reader = language.Reader(net)
    for trial in range(3):  # from memory, then with a part of it
        if trial == 2:
            monkeypatch.setattr(language, "KEPT", 5)
            reader.forget()
            assert len(reader.known) == len(reader.sums) == 5
        assert np.allclose(reader.probabilities(texts), [plain_probabilities(net, x) for x in texts], atol=1e-4)


def test_language_without_anything_to_learn(docs):
    assert [x["lang_pred"] for x in language.identify(docs([(1, "word", None)])).collect()] == ["und"]
    assert language.identify(docs([])).count() == 0


def test_gradients_by_differences():
    r = np.random.default_rng(1)
    f = lambda *shape: r.standard_normal(shape)
    net = language.Network(["a", "b"], f(2, 257, 9), f(2, 3, 9), f(2, 3, 2), f(2))
    codes = language.windows([b"ab", b"c", b"abcd"], 4)
    labels = np.array([0, 1, 1])
    _, grads = language.gradients(net, codes, labels)
    for a, g in zip(net.arrays(), grads, strict=True):
        for _ in range(12):
            at = tuple(r.integers(0, n) for n in a.shape)
            if a is net.x and r.random() < 0.8:
                at = (at[0], int(r.choice(codes[codes < 256])), at[2])
            keep, eps = a[at], 1e-3
            a[at] = keep + eps
            up = language.gradients(net, codes, labels)[0]
            a[at] = keep - eps
            down = language.gradients(net, codes, labels)[0]
            a[at] = keep
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-3


def brute_counts(s):
    w = re.findall(r"[^\x20\x09-\x0D]+", s)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    again = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in s.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(again)


def quality_rows():
    r = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        w = [f"w{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}" for _ in range(r.randint(20, 200))]
        bad = i % 10 == 0
        rows.append((i, " ".join(x + "***" if bad else x for x in w), "en"))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_counts_by_brute_force(docs):
    r = random.Random(6)
    parts = ["a ", "b ", "é#", "a b c d e ", "\n", " \n", "\t", "x|y ", "\x0b", "\x85", "\u2028", "日本 ", "<>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(300)] + ["", "w " * 40_000, "z" * 300_000]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(None, None, None), (5, texts[5], None)]
    found = Counter(tuple(x)[:6] + (x["base_failed"],) for x in quality.rule_counts(docs(rows)).collect())
    expected = Counter()
    for i, t, _ in rows:
        c = brute_counts(t or "")
        expected[(i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert found == expected


def test_forest_finds_bad_documents_and_keeps_good_ones(spark, docs):
    rows, labels = quality_rows()
    rows += [(900, None, None), (901, "too short", "en"), (None, rows[1][1], "en")]
    table = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, quality int")
    found = {x["doc_id"]: x["kept"] for x in quality.judge(docs(rows), table).collect()}
    assert sum(found[i] for i, q in labels if q == 1) >= 359 and not any(found[i] for i, q in labels if q == 0)
    assert not found[900] and not found[901] and found[None]
    kept = quality.keep_good(docs(rows), table)
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    assert {x["doc_id"] for x in kept.collect()} == {i for i, k in found.items() if k}


def test_quality_without_labels_or_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows, _ = quality_rows()
    assert all(x["kept"] for x in quality.judge(docs(rows), none).collect())
    assert quality.judge(docs([]), none).count() == 0 and quality.keep_good(docs([]), none).count() == 0


def brute_phrases(text):
    known, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def brute_mark(text):
    known = brute_phrases(text)
    cuts, at = [], 0
    while at < len(text):  # phrases in order, each the shortest new one
        end = at + 1
        seen = {text[a:b] for a, b in zip([0, *cuts], cuts, strict=False)}
        while end <= len(text) and text[at:end] in seen:
            end += 1
        if end > len(text):
            break
        cuts.append(end)
        at = end
    assert {text[a:b] for a, b in zip([0, *cuts], cuts, strict=False)} == known
    return fingerprints.text_of(fingerprints.smallest(fingerprints.hashes(text, cuts)))


def check_fingerprints(df, rows):
    """Rows in any order of equal ids: neighbours follow from what is found for other rows."""
    found = sorted(map(tuple, fingerprints.fingerprint_documents(df).collect()), key=repr)
    mark = fingerprints_order(df)
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0, mark[x[1]]))
    expected = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        edited = t[: len(t) - n] + following[:n]
        own, changed, after = brute_mark(t), brute_mark(edited), brute_mark(following)
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, changed, like(own, changed), like(own, after)))
    assert found == sorted(expected, key=repr)


def fingerprints_order(df):
    return {t or "": h for t, h in df.selectExpr("text", "xxhash64(coalesce(text, ''))").collect()}


def test_fingerprints_by_brute_force(docs):
    r = random.Random(9)
    ids = r.sample(range(10**6), 40)
    texts = ["".join(r.choice("abé日 ") for _ in range(r.choice([0, 1, 3, 50, 400]))) for _ in ids]
    rows = [(i, t, None) for i, t in zip(ids, texts, strict=True)] + [(10**7, None, None), (None, "first of all", None), (ids[0], texts[0], None)]
    check_fingerprints(docs(rows), rows)


@pytest.mark.parametrize("shape", ["far", "random", "one range", "one id", "nulls"])
def test_fingerprints_of_any_ids(spark, docs, shape):
    r = random.Random(1)
    n = 120
    ids = {
        "far": [0, 4 * 10**18, -(2**63), 2**63 - 1, 7], "random": [r.randrange(-(2**63), 2**63) for _ in range(n)],
        "one range": [*range(n - 1), 2**62], "one id": [5] * (n - 2) + [1, 9], "nulls": [None] * (n - 3) + [1, 2, 3],
    }[shape]
    rows = [(i, "".join(r.choice("ab ") for _ in range(30)), None) for i in ids]
    # many ranges, not joined again because they are small
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_fingerprints(docs(rows), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def like(a, b):
    a, b = ({x[i : i + 8] for i in range(0, len(x), 8)} for x in (a, b))
    both = sorted(a | b)[: fingerprints.HASHES]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def test_one_document_is_its_own_next(docs):
    assert [x["near_next"] for x in fingerprints.fingerprint_documents(docs([(5, "abc", None)])).collect()] == [1.0]
    assert fingerprints.fingerprint_documents(docs([])).count() == 0


@pytest.mark.parametrize("text, licence, notices", [
    ("RELEASED under the MIT licence!", "MIT", "MIT"),
    ("Copyright 2020 Somebody\n(c) others\n\nreleased under\tthe MIT-license", "MIT", "MIT"),
    ("Some text.\nReleased under the MIT License.\nAll rights reserved", None, "MIT,reserved"),
    ("Released under the MIT License and others", None, ""),
    ("Licensed under Creative Commons Attribution-NonCommercial 4.0", "CC-BY-NC-4.0", "CC-BY-NC-4.0"),
    ("", None, ""), (None, None, ""), ("...\nCopyright", None, ""), ("x " * 100_000 + "\nAll rights reserved.", None, "reserved"),
])
def test_licences(spark, docs, text, licence, notices):
    row = licences.scan(docs([(1, text, None)]), licences.known_licences(spark)).collect()
    assert [(x["licence"], x["notices"]) for x in row] == [(licence, notices)]
    assert (row[0]["digest"] is None) == (text is None)


def test_repeated_and_empty_licence_tables(spark, docs):
    rows = docs([(1, "All rights reserved", None)] * 2 + [(None, "All rights reserved", None)])
    assert licences.scan(rows, licences.known_licences(spark)).where("licence = 'reserved'").count() == 3
    assert licences.scan(rows, licences.known_licences(spark).limit(0)).where("licence IS NULL").count() == 3
    assert licences.scan(docs([]), licences.known_licences(spark)).count() == 0
