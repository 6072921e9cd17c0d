"""Encoders, token counts, packing and the lexicon against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from cellweave.llm import encode, lexicon, packing, token_counts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "THE", "é", "É", "e\u0301", " ", "  ", "\n", "\t", "\x1c", "\xa0", "\u3000", "'s", "'", "<|endoftext|>", "<|startoftext|>", "<", ">",
         "|", "Σ", "ΑΣ", "ß", "12", "½", "ﬁ", "Ⅷ", "日本", "\U0001F600", "!!", "***", ".", "İ", "ǅ", "can't", "\u200b", "\u00ad", "\r\n", "wordy", "aaaaaaa", "ababab"]


def odd_texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)] + ["", "x" * 5000, "word " * 3000]


@pytest.mark.parametrize("path, kind", [(WORD, encode.DroppedSpaces), (BYTE, encode.KeptSpaces)])
def test_ids_equal_the_library(path, kind):
    texts = odd_texts(3000)
    found = encode.Remembering(kind(path)).encode(texts)
    expected = encode.tokenizer(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(b"".join(x), "<u4").tolist() for x in found] == [e.ids for e in expected]


def table(docs):
    texts = odd_texts(60, seed=8)
    return docs([(i, t, "en") for i, t in enumerate(texts)] + [(900, None, None), (None, "no id", "en"), (3, texts[3], "en")]), [*texts, "", "no id", texts[3]]


def test_round_trip(docs):
    df, texts = table(docs)
    t = encode.tokenizer(BYTE)
    expected = []
    for doc, text in zip([*range(len(texts) - 3), 900, None, 3], texts, strict=True):
        ids = t.encode(text, add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, lexicon.round_trip(df, BYTE).collect()), key=repr) == sorted(expected, key=repr)
    assert lexicon.round_trip(docs([]), BYTE).count() == 0


def test_lexicon_shares_endings_and_keeps_every_word(tmp_path):
    words = {f"{a}{b}ing".encode(): bytes([i, j, 0, 0]) for i, a in enumerate("abcdefgh") for j, b in enumerate(["walk", "talk", "s", ""])}
    words |= {b"walk": b"\1\0\0\0", b"": b"", "é".encode(): b"\2\0\0\0\3\0\0\0"}
    parts = lexicon.compile_words(words)
    assert len(parts["final"]) < 40  # a tree would have some 200 states
    lexicon.write(parts, str(tmp_path / "words"))
    book = lexicon.Lexicon(str(tmp_path / "words"))
    assert book.lookup([*words]) == [*words.values()]
    assert book.lookup([b"wal", b"walks", b"zzz", b"aing\0"]) == [None] * 4
    assert sorted(book.entries(sorted(words)).tolist()) == list(range(len(words)))


def test_equal_counts_stay_or_go_together(docs):
    df = docs([(i, " a a b c", "en") for i in range(4)])
    assert lexicon.frequent_words(df, 3) == [" a", " b", " c"]
    assert lexicon.frequent_words(df, 2) == [" a"] and lexicon.frequent_words(df, 0) == []
    assert lexicon.frequent_words(docs([]), 3) == []


def test_histogram_answers_every_limit(docs):
    df, texts = table(docs)
    n = sorted(len(encode.tokenizer(BYTE).encode(x, add_special_tokens=False).ids) for x in texts)
    hist = token_counts.histogram(token_counts.lengths(df, BYTE))
    for x in hist.collect():
        assert x["n_docs"] == Counter(n)[x["length"]] and x["docs_total"] == len(n)
        assert x["docs_at_least"] == sum(k >= x["length"] for k in n) and x["tokens_at_least"] == sum(k for k in n if k >= x["length"])
        assert x["truncated_tokens"] == sum(min(k, x["length"]) for k in n) and x["rank"] == sum(k <= x["length"] for k in n)
    limits = [0, 1, 7, 1500, 10**6]
    found = {x["context"]: (x["docs_over"], x["truncated_tokens"]) for x in token_counts.at_limits(hist, limits).collect()}
    assert found == {m: (sum(k > m for k in n), sum(min(k, m) for k in n)) for m in limits}
    assert {x["share"]: x["length"] for x in token_counts.quantiles(hist, [0.5, 1.0]).collect()} == {0.5: n[(len(n) + 1) // 2 - 1], 1.0: n[-1]}
    assert token_counts.histogram(token_counts.lengths(docs([]), BYTE)).count() == 0


def test_pieces_and_packing(docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 40)
    df, texts = table(docs)
    packed = packing.pack(packing.pieces(df, WORD, 64), 64).collect()
    expected = Counter()
    for doc, text in zip([*range(len(texts) - 3), 900, None, 3], texts, strict=True):
        ids = np.array([*encode.tokenizer(WORD).encode(text, add_special_tokens=False).ids, 0], "<u4")
        expected.update((doc, k // 64, k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes())) for k in range(0, len(ids), 64))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in packed) == expected
    rows = {}
    for x in packed:
        rows.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for places in rows.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= 64
    assert len(rows) <= 1.05 * sum(x["length"] for x in packed) / 64 + 1
    assert packing.pack(packing.pieces(docs([]), WORD)).count() == 0


def test_evolution_beats_its_start():
    # pairs fill a bin exactly; best fit in falling order does not find all of them
    r = np.random.default_rng(5)
    a = r.integers(20, 80, 300)
    sizes = np.concatenate([a, (100 - a) // 2, 100 - a - (100 - a) // 2])
    island = packing.Island(sizes, 100, 3)
    start = island.fresh(0)
    end = island.evolve([])
    assert island.fitness(end) <= island.fitness(start)
    for solution in (end, island.cross(start, island.fresh(0.25)), island.mutate(start)):
        assert sorted(i for b in solution for i in b) == list(range(len(sizes)))
        assert island.used(solution).max() <= 100
