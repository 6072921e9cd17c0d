"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads the bytes of each word, with a space before and after, in both directions and gives every position a
probability of each language; a document's probabilities are the means over all positions of all its words. Words longer
than WINDOW bytes, as in texts without spaces, are read in pieces. Since what a word adds depends on its bytes alone, equal
words are read once while a task remembers them. The network is trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm import tables
from cellweave.llm.encode import Numbers

WINDOW = 62
UNITS = 12
# Training excerpts: at most about SAMPLE per language, each of at most EXCERPT characters, chosen by a hash over all
# documents that may be learnt from.
SAMPLE = 1500
EXCERPT = 400
STEPS = 400
BATCH = 512
RATE = 0.02
LANES = 1024
# Words are trained on in pieces of so many bytes; in texts without spaces all is pieces.
TRAINED_WIDTH = 18
# Words that a task remembers before it forgets all but the most used ones.
REMEMBERED = 100_000
KEPT = 30_000
UNKNOWN = "und"
# Texts in none of the languages, which no language fits, score lower.
LEAST_SCORE = 0.3


@dataclass
class Network:
    """Weights of both directions; gates z and r come first, then the candidate. ``languages`` are sorted."""

    languages: list[str]
    x: np.ndarray  # 2 x 257 x 3 units: what each byte adds (256 is padding)
    u: np.ndarray  # 2 x units x 3 units
    v: np.ndarray  # 2 x units x languages
    c: np.ndarray  # languages

    def arrays(self) -> list[np.ndarray]:
        return [self.x, self.u, self.v, self.c]

    def position_logits(self, codes: np.ndarray) -> np.ndarray:
        """Logits of each position of ``codes`` (positions x windows)."""
        steps, n = codes.shape
        k = self.u.shape[1]
        out = np.tile(self.c, (steps, n, 1))
        for d in range(2):
            # sigmoid(a) = (1 + tanh(a / 2)) / 2, so the halves are put into the weights of the gates
            gates_x, gates_u = self.x[d][:, : 2 * k] * np.float32(0.5), self.u[d][:, : 2 * k] * np.float32(0.5)
            cand_x, cand_u = self.x[d][:, 2 * k :].copy(), self.u[d][:, 2 * k :].copy()
            h = np.zeros((n, k), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                gates = gates_x[codes[t]]
                gates += h @ gates_u
                np.tanh(gates, out=gates)
                gates += 1
                gates *= 0.5
                cand = h @ cand_u
                cand *= gates[:, k:]
                cand += cand_x[codes[t]]
                np.tanh(cand, out=cand)
                h -= cand
                h *= gates[:, :k]
                h += cand
                out[t] += h @ self.v[d]
        return out


def _softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(-1, keepdims=True))
    return a / a.sum(-1, keepdims=True)


def gradients(net: Network, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over positions that are not padding, and its gradients by backpropagation through time."""
    steps, n = codes.shape
    k = net.u.shape[1]
    kept, logits = [], np.tile(net.c, (steps, n, 1))
    for d in range(2):
        order = range(steps) if d == 0 else range(steps - 1, -1, -1)
        h, states = np.zeros((n, k), np.float32), {}
        for t in order:
            g, hu = net.x[d][codes[t]], h @ net.u[d]
            gates = 1 / (1 + np.exp(-(g[:, : 2 * k] + hu[:, : 2 * k])))
            z, r = gates[:, :k], gates[:, k:]
            cand = np.tanh(g[:, 2 * k :] + r * hu[:, 2 * k :])
            new = cand + z * (h - cand)
            states[t] = (h, z, r, cand, hu[:, 2 * k :], new)
            h = new
            logits[t] += h @ net.v[d]
        kept.append(states)
    real = (codes != 256)[..., None]
    p = _softmax(logits)
    total = max(int(real.sum()), 1)
    loss = float(-(np.log(np.take_along_axis(p, labels[None, :, None].repeat(steps, 0), 2) + 1e-9) * real).sum() / total)
    dl = p.copy()
    dl[:, np.arange(n), labels] -= 1
    dl *= real / total
    gx, gu, gv, gc = (np.zeros_like(a) for a in net.arrays())
    gc += dl.sum((0, 1))
    for d in range(2):
        back = range(steps - 1, -1, -1) if d == 0 else range(steps)
        dh = np.zeros((n, k), np.float32)
        for t in back:
            h, z, r, cand, hun, new = kept[d][t]
            dh = dh + dl[t] @ net.v[d].T
            gv[d] += new.T @ dl[t]
            da = dh * (1 - z) * (1 - cand * cand)
            dz = dh * (h - cand) * z * (1 - z)
            dr = da * hun * r * (1 - r)
            dg = np.concatenate([dz, dr, da], 1)
            dhu = np.concatenate([dz, dr, da * r], 1)
            np.add.at(gx[d], codes[t], dg)
            gu[d] += h.T @ dhu
            dh = dh * z + dhu @ net.u[d].T
    # padding adds nothing, so that what a word reads does not depend on the words beside it
    gx[:, 256] = 0
    return loss, [gx, gu, gv, gc]


def pieces(text: bytes, width: int = WINDOW) -> list[bytes]:
    """Words of a text; longer ones in pieces of ``width`` bytes."""
    found = text.split()
    if max(map(len, found), default=0) > width:
        found = [w[i : i + width] for w in found for i in range(0, len(w), width)]
    return found


def windows(found: list[bytes], width: int) -> np.ndarray:
    """Pieces of at most ``width`` bytes with a space before and after, padded with 256: positions x pieces."""
    codes = np.full((len(found), width + 2), 256, np.int16)
    for row, piece in zip(codes, found, strict=True):
        row[: len(piece) + 2] = np.frombuffer(b" %s " % piece, np.uint8)
    return np.ascontiguousarray(codes.T)


def train(rows: list[tuple[str, str]], steps: int = STEPS, seed: int = 11) -> Network | None:
    """A network learnt from (language, excerpt); None without usable rows. Languages have equal weight."""
    rows = sorted((a, b) for a, b in rows if a and b)
    languages = sorted({a for a, _ in rows})
    if not languages:
        return None
    r = np.random.default_rng(seed)
    found = [(languages.index(a), w) for a, b in rows for w in pieces(b.encode(), TRAINED_WIDTH)]
    codes, label = windows([w for _, w in found], TRAINED_WIDTH), np.array([i for i, _ in found], np.int64)
    pools = [p for i in range(len(languages)) if len(p := np.flatnonzero(label == i))]
    if not pools:
        return None
    f = lambda *shape: (r.standard_normal(shape) * 0.3).astype(np.float32)
    net = Network(languages, f(2, 257, 3 * UNITS), f(2, UNITS, 3 * UNITS), f(2, UNITS, len(languages)), np.zeros(len(languages), np.float32))
    net.x[:, 256] = 0
    first, second = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()]
    for step in range(1, steps + 1):
        pick = np.concatenate([r.choice(p, max(1, BATCH // len(pools))) for p in pools])
        _, grads = gradients(net, codes[:, pick], label[pick])
        rate = RATE * (1 - step / (steps + 1)) + 0.001
        for a, g, m, v in zip(net.arrays(), grads, first, second, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


class Reader:
    """Reads texts by a network; remembers, for each word, the sums of its positions' probabilities and their number."""

    def __init__(self, net: Network):
        self.net, self.known = net, Numbers()
        self.sums = np.zeros((0, len(net.languages) + 1), np.float32)
        self.used = np.zeros(0, np.int64)

    def learn(self) -> None:
        """Read the words that are new."""
        new, first = self.known.new, len(self.sums)
        order = sorted(range(len(new)), key=lambda i: len(new[i]))
        sums, at = np.zeros((len(new), self.sums.shape[1]), np.float32), 0
        while at < len(new):
            part = order[at : at + LANES]
            codes = windows([new[i] for i in part], len(new[part[-1]]))
            real = codes != 256
            p = _softmax(self.net.position_logits(codes)) * real[..., None]
            sums[part, :-1], sums[part, -1] = p.sum(0), real.sum(0)
            at += len(part)
        self.sums = np.concatenate([self.sums, sums])
        self.used = np.concatenate([self.used, np.zeros(len(self.sums) - first, np.int64)])
        new.clear()

    def forget(self) -> None:
        """All words but the KEPT most used ones."""
        words, kept = [*self.known], np.sort(np.argsort(-self.used, kind="stable")[:KEPT])
        self.known, self.sums, self.used = Numbers(), self.sums[kept], self.used[kept] // 2
        for i in kept.tolist():
            self.known[words[i]] = len(self.known)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; rows of texts without words are zero."""
        if len(self.known) > REMEMBERED:
            self.forget()
        number, out = self.known.__getitem__, np.zeros((len(texts), len(self.net.languages)))
        found = [np.array([*map(number, pieces(x))], np.int64) for x in texts]
        self.learn()
        self.used += np.bincount(np.concatenate([*found, np.zeros(0, np.int64)]), minlength=len(self.sums))
        for i, words in enumerate(found):
            if len(words):
                total = self.sums[words].sum(0, dtype=np.float64)
                out[i] = total[:-1] / total[-1]
        return out


def excerpts(docs: DataFrame, size: int = SAMPLE) -> list[tuple[str, str]]:
    """About ``size`` excerpts of each language; which part of a text is taken follows from its hash."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return []
    share = F.create_map(*[F.lit(y) for x in counts for y in (x["lang"], int(min(1.0, size / x["count"]) * (1 << 20)) + 1)])
    mark = F.xxhash64("doc_id", "lang")
    start = F.pmod(F.shiftright(mark, 20), F.greatest(F.length("text") - EXCERPT, F.lit(1))).cast("int") + 1
    picked = known.where(F.pmod(mark, F.lit(1 << 20)) < share[F.col("lang")])
    return [(x[0], x[1]) for x in picked.select("lang", F.substring("text", start, F.lit(EXCERPT))).collect()]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. Null texts and texts without a letter are ``und`` with score 0."""

    readers: list[Reader] = []  # one per task

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = tables.texts(batch["text"])
        letters = [any(map(str.isalpha, x)) and net is not None for x in texts]
        if not readers and net is not None:
            readers.append(Reader(net))
        p = readers[0].probabilities([x.encode() for x, ok in zip(texts, letters, strict=True) if ok]) if any(letters) else np.zeros((0, 1))
        best, found, k = [UNKNOWN] * len(texts), np.zeros(len(texts)), 0
        for i in np.flatnonzero(letters):
            best[i], found[i] = net.languages[int(p[k].argmax())], min(1.0, float(p[k].max()))
            k += 1
        return batch.append_column("lang_pred", pa.array(best, pa.string())).append_column("score", pa.array(np.round(found, 5)))

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return tables.map_batches(docs, run, T.StructType([*docs.schema, *added]), readers)


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learnt from: crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, text, held_out, lang_pred, score`` of each row, learnt from the rows that are not held out.

    Null ids are learnt from; repeated rows count as often as they come; without any known language all are ``und``.
    """
    picked = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    return predict(picked.select("doc_id", "text", held_out().alias("held_out")), learn(docs))


def learn(docs: DataFrame) -> Network | None:
    return train(excerpts(docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where(~held_out())))


def keep_known(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose language is found with a score of at least ``least``.

    Null texts and texts without letters go. Repeated rows go or stay together; an empty table gives an empty one.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    found = predict(rows, learn(docs))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
