"""Byte-pair encoding by a lexicon of frequent words, and exact merges for the rest.

The lexicon is a minimal acyclic transducer: an automaton over bytes in which equal endings share their states. Each arc adds a
number, and the sum along a word's path is the word's entry in a table of ids. Tasks map its file into memory, so that all
workers of a machine share it, and walk it for many words at once.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm import encode, tables

# Words the lexicon holds at most; it bounds the file, not the result: other words are merged.
ENTRIES = 60_000
# A word must occur at least this often.
LEAST_COUNT = 3
# Longer chunks are left to the merges.
LONGEST = 64
# Distinct chunks that a task counts before it hands their counts on.
COUNTED = 400_000


def compile_words(words: dict[bytes, bytes]) -> dict[str, np.ndarray]:
    """The transducer of ``words`` (each with its ids): arcs sorted by (state, byte), final states, ids by entry."""
    register: dict[tuple, int] = {}
    below: list[int] = []  # words that can still be completed from a frozen state, itself included
    frozen: list[tuple] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        state = register.get(key)
        if state is None:
            state = register[key] = len(frozen)
            frozen.append(key)
            below.append(node[0] + sum(below[t] for _, t in node[1]))
        return state

    ordered = sorted(words)
    path: list[list] = [[0, []]]  # open nodes: final?, arcs of frozen targets
    last = b""
    for word in ordered:
        common = len(os.path.commonprefix([last, word]))
        while len(path) > common + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        path += [[0, []] for _ in word[common:]]
        path[-1][0] = 1
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(node)))
    start = freeze(path[0])
    keys, targets, adds = [], [], []
    for state, (final, arcs) in enumerate(frozen):
        passed = final
        for byte, target in arcs:
            keys.append(state * 256 + byte), targets.append(target), adds.append(passed)
            passed += below[target]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    ids = [words[w] for w in ordered]
    return {
        "keys": np.array(keys, np.int64)[order], "targets": np.array(targets, np.int64)[order], "adds": np.array(adds, np.int64)[order],
        "final": np.array([f for f, _ in frozen], np.int64), "start": np.array([start], np.int64),
        "ends": np.cumsum([0, *(len(x) for x in ids)]).astype(np.int64), "ids": np.frombuffer(b"".join(ids).ljust(8, b"\0"), np.uint8),
    }


def write(parts: dict[str, np.ndarray], path: str) -> None:
    """All arrays behind each other, each at a multiple of 64 bytes, after a line that says where."""
    head, at, blobs = [], 4096, []
    for name, a in parts.items():
        head.append(f"{name} {a.dtype.str} {at} {len(a)}")
        raw = a.tobytes()
        blobs.append(raw + b"\0" * (-len(raw) % 64))
        at += len(blobs[-1])
    with open(path, "wb") as f:
        f.write("\n".join(head).encode().ljust(4096))
        f.writelines(blobs)


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        for line in raw[:4096].tobytes().decode().split("\n"):
            name, kind, at, n = line.split()
            size = np.dtype(kind).itemsize * int(n)
            setattr(self, name, raw[int(at) : int(at) + size].view(kind))
        self.held = self.ids.tobytes()

    def entries(self, words: list[bytes]) -> np.ndarray:
        """The entry of each word, -1 for words that are not in the lexicon. All words step at once."""
        n = len(words)
        if not n or not len(self.keys):
            return np.full(n, -1)
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        size = np.fromiter(map(len, words), np.int64, n)
        begin = np.cumsum(size) - size
        out = np.full(n, -1)
        rows, state, entry = np.arange(n), np.full(n, self.start[0]), np.zeros(n, np.int64)
        step = 0
        while len(rows):
            ended = size[rows] == step
            if ended.any():
                full = ended & (self.final[state] == 1)
                out[rows[full]] = entry[full]
                rows, state, entry = rows[~ended], state[~ended], entry[~ended]
            key = state * 256 + data[begin[rows] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            rows, at, entry = rows[known], at[known], entry[known]
            state, entry = self.targets[at], entry + self.adds[at]
            step += 1
        return out

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word, None where it is not in the lexicon."""
        e = self.entries(words)
        low, high = self.ends[np.maximum(e, 0)].tolist(), self.ends[np.maximum(e, 0) + 1].tolist()
        return [self.held[a:b] if k >= 0 else None for k, a, b in zip(e.tolist(), low, high, strict=True)]


def frequent_words(docs: DataFrame, entries: int = ENTRIES) -> list[str]:
    """The most frequent chunks of all texts, at most ``entries``; equal counts stay or go together.

    Tasks count what they read before anything is shuffled, chunks of at most LONGEST characters only. The least count comes from a
    histogram of counts, so that only the chunks found go to the driver, not the best of each partition.
    """
    encoder_chunks = encode.KeptSpaces.chunks

    def told(counts: Counter) -> pa.RecordBatch:
        kept = [c for c in counts if len(c) <= LONGEST]
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([counts[c] for c in kept], pa.int64())], ["chunk", "n"])

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for i in range(0, batch.num_rows, tables.SLICE_ROWS):
                for text in tables.texts(batch["text"].slice(i, tables.SLICE_ROWS)):
                    counts.update(encoder_chunks(None, text))
                if len(counts) > COUNTED:
                    yield told(counts)
                    counts.clear()
        yield told(counts)
        counts.clear()
        tables.give_back()

    tables.workers_find_package(docs.sparkSession)
    counted = docs.mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    counted = tables.settle(counted.where(F.col("n") >= LEAST_COUNT), "chunks")
    # One row per distinct count goes through this window.
    running = F.sum("words").over(Window.orderBy(F.desc("n")))
    sizes = counted.groupBy("n").agg(F.count("*").alias("words")).withColumn("running", running)
    least = sizes.where(F.col("running") <= entries).agg(F.min("n")).first()[0]
    if least is None:
        return []
    return [x[0] for x in counted.where(F.col("n") >= least).orderBy(F.desc("n"), "chunk").collect()]


def build(spark: SparkSession, docs: DataFrame, tokenizer: str, entries: int = ENTRIES) -> str:
    """Compile the lexicon of ``docs`` and hand its file to all executors; the name under which tasks find it."""
    found = frequent_words(docs, entries)
    ids = encode.KeptSpaces(tokenizer).ids(found)
    parts = compile_words({w.encode(): x for w, x in zip(found, ids, strict=True)})
    name = f"lexicon-{hashlib.sha256(b''.join(a.tobytes() for a in parts.values())).hexdigest()[:16]}"
    path = os.path.join(SparkFiles.getRootDirectory(), f"made-{name}")
    if not os.path.exists(path):
        write(parts, path)
        target = os.path.join(os.path.dirname(path), name)
        os.replace(path, target)
        spark.sparkContext.addFile(target)
    return name


class Decoder:
    """Bytes of ids by the byte-level vocabulary; what is not UTF-8 becomes U+FFFD."""

    def __init__(self, path: str):
        t = encode.tokenizer(path)
        byte = {x: b for b, x in enumerate(encode._byte_letters())}
        vocab = t.get_vocab(with_added_tokens=True)
        told = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            told[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.size = np.array([len(x) for x in told])
        self.start, self.data = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(told), np.uint8)

    def bytes_of(self, parts: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids, all looked up at once; bytes of a text are those of its parts behind each other."""
        ids = np.frombuffer(b"".join(parts), "<u4")
        size = self.size[ids]
        ends = np.cumsum(size)
        take = np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        held = self.data[take].tobytes()
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *(len(x) // 4 for x in parts)])].tolist()
        return [held[a:b] for a, b in zip(cuts, cuts[1:])]


class Codec:
    """Encodes by the lexicon, merges what it does not hold, and decodes."""

    def __init__(self, lexicon: str, tokenizer: str):
        self.encoder, self.lexicon, self.decoder = encode.KeptSpaces(tokenizer), Lexicon(lexicon), Decoder(tokenizer)
        self.memory = encode.Remembering(self, value=tuple)

    def chunks(self, text: str) -> list[str]:
        return self.encoder.chunks(text)

    def ids(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each chunk, and the bytes that they decode to."""
        found = self.lexicon.lookup([c.encode() for c in chunks])
        rest = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(rest, self.encoder.ids([chunks[i] for i in rest]), strict=True):
            found[i] = ids
        return [*zip(found, self.decoder.bytes_of(found), strict=True)]

    def round_trip(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids of each text, and the text that they decode to."""
        read = ([x for x in zip(*parts)] or [(), ()] for parts in self.memory.encode(texts))
        return [(b"".join(ids), b"".join(data).decode("utf-8", "replace")) for ids, data in read]


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row (doc_id, text): encoded and decoded again.

    Null and empty texts have no tokens. Ids are digested as little-endian unsigned 32-bit integers, texts as UTF-8.
    """
    picked = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    name = build(docs.sparkSession, picked.select("text"), tokenizer)
    codecs: list[Codec] = []

    def run(batch: pa.RecordBatch) -> pa.Table:
        if not codecs:
            codecs.append(Codec(SparkFiles.get(name), tokenizer))
        found = codecs[0].round_trip(tables.texts(batch["text"]))
        return pa.table({
            "doc_id": batch["doc_id"], "n_tokens": pa.array([len(x) // 4 for x, _ in found], pa.int64()),
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x, _ in found],
            "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for _, x in found],
        })

    return tables.map_batches(picked, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", codecs)
