"""Ids of whole texts under a word-level BPE tokenizer file, as the tokenizers library gives them.

Most words of a corpus come again and again, and the rest are short. So ids are
remembered by word, and new words are merged many at a time in arrays, from the
merges of the tokenizer file. Whatever this does not cover goes through the
library itself: texts with characters outside U+0000-U+02FF (where
normalisation or letter classes are not plain), with a special token's
beginning, and very long words. A test holds both ways against each other.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import regex
from tokenizers import Tokenizer

from tidemark.llm.common import Table

KNOWN = 400_000  # words that a worker remembers
TOGETHER = 5_000_000  # characters of texts whose words are held at once
LONGEST = 48  # bytes of a word that is merged in arrays
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte that byte-level tokenizers use: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merger:
    """BPE of many words at once: in each round every word merges its first pair of lowest rank."""

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.uint64)
        keys, first = np.unique(keys, return_index=True)
        self.table = Table(keys)
        self.rank = np.append(first, NONE).astype(np.int32)  # row -1, no merge, reads the last place
        self.made = np.array([vocab[a + b] for a, b in (pairs[i] for i in first)] + [0], np.int32)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.table.find(a.astype(np.uint64) << np.uint64(20) | b.astype(np.uint64))

    def ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, as little-endian unsigned 32-bit bytes."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if w:
                by_size.setdefault(len(w), []).append(i)
        for size, rows in by_size.items():
            data = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(-1, size)
            ids = self.inner[data]
            ids[:, -1] = self.last[data[:, -1]]
            count = np.full(len(ids), size)
            if size > 1:
                row = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), size - 1)
                live = np.arange(len(ids))
                while len(live):
                    rank = self.rank[row]
                    at = rank.argmin(1)
                    go = rank[np.arange(len(at)), at] != NONE
                    live, row, at = live[go], row[go], at[go]
                    if not len(live):
                        break
                    part, n = ids[live], np.arange(len(live))
                    part[n, at] = self.made[row[n, at]]
                    shift = np.arange(size - 1) + (np.arange(size - 1) > at[:, None])
                    part[:, :-1] = np.take_along_axis(part, shift, 1)
                    ids[live] = part
                    count[live] -= 1
                    # Pair j of a word joins places j and j + 1; what lies behind the last place is no pair.
                    gone = np.arange(size - 2) + (np.arange(size - 2) > at[:, None]) if size > 2 else np.zeros((len(live), 0), int)
                    row = np.concatenate([np.take_along_axis(row, gone, 1), np.full((len(live), 1), -1, row.dtype)], 1)
                    left, right = np.flatnonzero(at > 0), np.flatnonzero(at < count[live] - 1)
                    row[left, at[left] - 1] = self.pairs(part[left, at[left] - 1], part[left, at[left]])
                    row[right, at[right]] = self.pairs(part[right, at[right]], part[right, at[right] + 1])
                    last = np.flatnonzero(at == count[live] - 1)
                    row[last, at[last]] = -1
            flat = ids[np.arange(size) < count[:, None]].astype("<u4").tobytes()
            ends = (4 * np.cumsum(count)).tolist()
            for i, a, b in zip(rows, [0, *ends], ends):
                out[i] = flat[a:b]
        return out


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.merger = Merger(spec["model"])
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.starts = sorted({t["content"][:2] for t in spec["added_tokens"]})
        self.mark = re.compile(r"[^\w\s](?<=[^\W\d_].)").sub
        self.odd = re.compile("[\u0130\u0300-\U0010ffff]").search
        self.known: dict[str, bytes] = {}

    def by_library(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    def plain(self, text: str) -> bool:
        return not any(x in text for x in self.starts) and (text.isascii() or not self.odd(text))

    def learn(self, words: list[str]) -> None:
        """Remember the ids of lower-case words without white space."""
        known, split = self.known, self.split
        mixed = [(w, split(w)) for w in words if not w.isalpha()]
        new = [w for w in words if w.isalpha()]
        new += {p for _, parts in mixed for p in parts if p not in known}.difference(new)
        data = [p.encode() for p in new]
        known.update(zip(new, self.merger.ids([d if len(d) <= LONGEST else b"" for d in data])))
        long = [p for p, d in zip(new, data) if len(d) > LONGEST]
        known.update(zip(long, self.by_library(long)))
        for w, parts in mixed:
            known[w] = b"".join([known[p] for p in parts])

    def words(self, text: str) -> list[str]:
        """A text's words in lower case. Letters end a piece of their own wherever another character follows, so
        marks behind letters are parted from them and a word is remembered once, not with each mark again."""
        return self.mark(r" \g<0>", text.lower().replace("\n", " ")).split(" ")

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit bytes."""
        out, begin, size = [], 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= TOGETHER or i + 1 == len(texts):
                out += self.together(texts[begin : i + 1])
                begin, size = i + 1, 0
        return out

    def together(self, texts: list[str]) -> list[bytes]:
        """As above, for texts whose words are held at once: new ones are merged in few, large arrays."""
        words = [self.words(t) if self.plain(t) else None for t in texts]
        known, seen = self.known, set()
        for ws in words:
            seen.update(ws or ())
        self.learn([w for w in seen if w not in known])
        get = known.__getitem__
        out = [b"".join(map(get, ws)) if ws is not None else self.by_library([t])[0] for t, ws in zip(texts, words)]
        if len(known) > KNOWN:  # frequent words are in this batch too
            self.known = {w: known[w] for w in seen}
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker."""
    return Encoder(path)
