"""Token ids of whole texts by a tokenizer file.

Texts are parted into chunks at white space where the tokenizer parts them too; equal chunks are encoded once while a task
remembers them. Plain chunks (Latin letters and punctuation) go through merges done for many words at once in numpy; all
others through the tokenizers library, which also defines the result.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np

# Chunks that a task remembers before it starts anew.
REMEMBERED = 500_000
_WIDTHS = (6, 10, 16, 32)
_AT_ONCE = 16_384
# Merges are ordered by rank and place in one number; from NO_RULE on there is none.
_PLACES = 64
NO_RULE = np.int32(1 << 30)
_SPACE_BESIDE_SPACE = re.compile(r"\s |^ | $| \s")
# White space other than blanks and line feeds.
_ODD_SPACES = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Bytes of plain chunks: a blank, letters (ASCII or À to ÿ, of two bytes that begin with C3), marks. Not the apostrophe, which starts
# contractions, nor <, which starts special tokens.
_OTHER, _BLANK, _LETTER, _MARK, _LEAD, _REST = range(6)
_KIND = np.zeros(256, np.uint8)
_KIND[0x20] = _BLANK
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[x for x in range(0x21, 0x7F) if not chr(x).isalnum() and chr(x) not in "'<"]] = _MARK
_KIND[0xC3] = _LEAD
_KIND[0x80:0xC0] = _REST
_KIND[[0x97, 0xB7]] = _OTHER  # the signs of multiplication and division


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Merges:
    """Byte-pair merges of many words at once: in each round every word makes its first merge of lowest rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        letters = _byte_letters()
        self.size = max(vocab.values()) + 1
        # ids of the bytes inside words, then of the bytes at the end of words
        self.bytes = np.array([vocab[x] for x in letters] + [vocab[x + end] for x in letters], np.int32)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32) * _PLACES
        inner, last = np.repeat(self.bytes[:256], 512), np.tile(self.bytes, 256)
        self.of_bytes = self.rank(inner, last).reshape(256, 512)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, times _PLACES; NO_RULE where there is none or b is padding (-1)."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0), self.ranks[at], NO_RULE)

    def ids(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words ``data[start:start + size]``, all in a row, and how many each has. No word is longer than the last
        of _WIDTHS; empty ones have none."""
        counts, blocks, low = np.zeros(len(size), np.int64), [], 0
        for width in _WIDTHS:
            rows = np.flatnonzero((size > low) & (size <= width))
            low = width
            for at in range(0, len(rows), _AT_ONCE):
                part = rows[at : at + _AT_ONCE]
                made = self._merge(data, start[part], size[part], width)
                counts[part] = (made >= 0).sum(0)
                blocks.append((part, made))
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, "<u4")
        for part, made in blocks:
            first = ends[part] - counts[part]
            for place in range(len(made)):
                real = made[place] >= 0
                out[first[real] + place] = made[place, real]
        return out, counts

    def _merge(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
        """Ids (places x words), -1 behind the last."""
        n, place = len(start), np.arange(width, dtype=np.int32)[:, None]
        raw = data[np.minimum(start + place, len(data) - 1)].astype(np.int32) + 256 * (place == size - 1)
        symbols = np.full((width + 1, n), -1, np.int32)
        symbols[:-1] = np.where(place < size, self.bytes[raw], -1)
        ranks = np.full((width, n), NO_RULE, np.int32)
        ranks[:-1] = np.where(place[1:] < size, self.of_bytes[raw[:-1] & 255, raw[1:]], NO_RULE)
        ranks += place
        done, which = np.full((width, n), -1, np.int32), np.arange(n)
        while len(which):
            least = ranks.min(0)
            live = least < NO_RULE // 2
            if not live.all():
                done[:, which[~live]] = symbols[:-1, ~live]
                symbols, ranks, least, which = symbols[:, live], ranks[:, live], least[live], which[live]
            at, rows = least % _PLACES, np.arange(len(which))
            symbols[at, rows] = self.made[least // _PLACES]
            moved = place > at
            symbols[:-1] = np.where(moved, symbols[1:], symbols[:-1])
            ranks[:-1] = np.where(moved[:-1], ranks[1:] - 1, ranks[:-1])
            ranks[-1] = NO_RULE + width
            ranks[at, rows] = self.rank(symbols[at, rows], symbols[at + 1, rows]) + at
            before = np.flatnonzero(at > 0)
            left = at[before] - 1
            ranks[left, before] = self.rank(symbols[left, before], symbols[left + 1, before]) + left
        return done


@cache
def merges(path: str) -> Merges:
    return Merges(path)


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of flags in each run of bytes that ends at one of ``ends``."""
    total = np.concatenate([[0], np.cumsum(flags)])[ends]
    return np.diff(total, prepend=0)


class ChunkEncoder:
    """Encodes chunks of texts exactly as the tokenizers library does, without its special tokens around."""

    lower_case = False

    def __init__(self, path: str):
        self.path, self.tokenizer, self.merges = path, tokenizer(path), merges(path)

    def chunks(self, text: str) -> list[str]:
        raise NotImplementedError

    def ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian unsigned 32-bit integers.

        A plain chunk is letters (with the blank before them), then marks (with the blank if there are no letters): two words.
        """
        if not chunks:
            return []
        encoded = [x.encode() for x in chunks]
        data = np.frombuffer(b"".join(encoded) + b"\0", np.uint8)
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ends = np.cumsum(size)
        start = ends - size
        kind = _KIND[data]
        after_lead = np.concatenate([[False], kind[:-1] == _LEAD])
        rest = (kind == _REST) & after_lead
        letter, mark = (kind == _LETTER) | (kind == _LEAD) | rest, kind == _MARK
        first = np.zeros(len(data), bool)
        first[start] = True
        blank = (kind == _BLANK) & first
        wrong = ~(letter | mark | blank) | (after_lead & ~rest)
        wrong[1:] |= letter[1:] & mark[:-1] & ~first[1:]
        blanks, letters, marks = (_sums(x[:-1], ends) for x in (blank, letter, mark))
        one = blanks + np.where(letters > 0, letters, marks)
        two = np.where(letters > 0, marks, 0)
        plain = (_sums(wrong[:-1], ends) == 0) & (np.maximum(one, two) <= _WIDTHS[-1])
        if self.lower_case:
            capital = ((data >= 65) & (data <= 90)) | (rest & (data < 0x9F))
            data = data + (capital * np.uint8(32)).astype(np.uint8)
        of = np.flatnonzero(plain)
        words = np.stack([start[of], start[of] + one[of]], 1).ravel()
        ids, counts = self.merges.ids(data, words, np.stack([one[of], two[of]], 1).ravel())
        cuts = (4 * np.concatenate([[0], np.cumsum(counts.reshape(-1, 2).sum(1))])).tolist()
        held, out = ids.tobytes(), [b""] * len(chunks)
        for i, a, b in zip(of.tolist(), cuts, cuts[1:]):
            out[i] = held[a:b]
        others = np.flatnonzero(~plain).tolist()
        for i, e in zip(others, self.tokenizer.encode_batch_fast([chunks[i] for i in others], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out


class DroppedSpaces(ChunkEncoder):
    """For lower-casing tokenizers whose pre-tokenizer drops white space: what lies between spaces is encoded on its own.

    Texts are parted at spaces and line feeds only; any other white space is left to the library. Strings of special tokens
    hold no white space, so they stay whole.
    """

    lower_case = True

    def chunks(self, text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")


class KeptSpaces(ChunkEncoder):
    """For byte-level tokenizers that put one space before a word into it.

    A space between characters that are not white space starts a new word whatever stands before it, and a line feed between such
    characters is a word of its own. Texts with other white space, or with white space side by side, are parted only at spaces
    between other characters.
    """

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        single = text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in ("  ", "\n\n", " \n", "\n "))
        if not single or any(x in text for x in _ODD_SPACES):
            if _SPACE_BESIDE_SPACE.search(text):
                return re.split(r"(?<=\S)(?= \S)", text)
            first, *rest = text.split(" ")
            return [first, *[" " + x for x in rest]]
        out: list[str] = []
        for line in text.split("\n"):
            if out:
                out.append("\n")
            first, *rest = line.split(" ")
            out.append(first)
            out += [" " + x for x in rest]
        return out


class Numbers(dict):
    """Numbers chunks in the order in which they are first asked for; ``new`` holds those that came last."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class Remembering:
    """Encodes texts chunk by chunk and remembers ``value`` of each chunk's ids."""

    def __init__(self, encoder: ChunkEncoder, value=bytes):
        self.encoder, self.value = encoder, value
        self.clear()

    def clear(self) -> None:
        self.known, self.values = Numbers(), []

    def encode(self, texts: list[str]) -> list[list]:
        """For each text the values of its chunks, in order."""
        if len(self.values) > REMEMBERED:
            self.clear()
        number = self.known.__getitem__
        found = [[*map(number, self.encoder.chunks(x))] for x in texts]
        self.values += map(self.value, self.encoder.ids(self.known.new))
        self.known.new.clear()
        value = self.values.__getitem__
        return [[*map(value, x)] for x in found]
