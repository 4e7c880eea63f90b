"""Byte-level BPE: merges from a priority queue over a doubly linked symbol list; decoding by vocabulary strings."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T

#: Fixed value: the pattern that cuts text before merging. L and N are the letters and numbers of Unicode, S its white space.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"

#: Pieces whose tokens a Python worker remembers in each of two generations, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64

OUTPUTS = {"ids": T.ArrayType(T.IntegerType()), "n_tokens": "long", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next ones from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def cuts() -> re.Pattern:
    """The pattern with its classes spelled out as ranges, which the standard library matches faster than properties."""
    ranges: dict[str, list[list[int]]] = {"L": [], "N": [], "S": []}
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        kind = "S" if c.isspace() and not 28 <= point <= 31 else unicodedata.category(c)[0].replace("S", "")
        if kind in ranges:
            known = ranges[kind]
            if known and known[-1][1] == point - 1:
                known[-1][1] = point
            else:
                known.append([point, point])
    spelled = {k: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in v) for k, v in ranges.items()}
    return re.compile(re.sub("[LNS]", lambda m: spelled[m[0]], CUTS))


class Codec(dict):
    """Tokens of pieces. As a dictionary it remembers pieces: token ids as text, their number, the bytes they stand for."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks: dict[str, dict[str, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            self.ranks.setdefault(left, {})[right] = rank
        self.older: dict[str, tuple[str, int, bytes]] = {}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.letters = byte_letters()
        self.bytes_of = {letter: b for b, letter in enumerate(self.letters)}
        self.cuts = cuts()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None

    def merge(self, piece: str) -> list[int]:
        """Token ids of one piece."""
        symbols: list[str] = [self.letters[b] for b in piece.encode()]
        n, ranks, none = len(symbols), self.ranks, {}
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i], none).get(symbols[i + 1])
            if rank is not None:
                queue.append((rank, i, symbols[i], symbols[i + 1]))
        heapify(queue)
        while queue:
            _, i, left, right = heappop(queue)
            j = after[i]
            if j >= n or symbols[i] != left or symbols[j] != right:  # stale: one of them has merged since
                continue
            made = symbols[i] = left + right
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(made, none).get(symbols[k])
                if rank is not None:
                    heappush(queue, (rank, i, made, symbols[k]))
            h = before[i]
            if h >= 0:
                rank = ranks.get(symbols[h], none).get(made)
                if rank is not None:
                    heappush(queue, (rank, h, symbols[h], made))
        vocab = self.vocab
        return [vocab[s] for s in symbols if s]

    def text_bytes(self, ids: list[int]) -> bytes:
        """The bytes that the tokens' vocabulary strings, concatenated, stand for."""
        of = self.bytes_of
        return bytes([of[c] for c in "".join([self.strings[i] for i in ids])])

    def __missing__(self, piece: str) -> tuple[str, int, bytes]:
        made = self.older.get(piece)
        if made is None:
            ids = self.merge(piece)
            made = (",".join(map(str, ids)), len(ids), self.text_bytes(ids))
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= self.remembered:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made

    def parts(self, text: str | None) -> list[tuple[str, int, bytes]]:
        """Remembered forms of all pieces of a text. Special tokens in the text count as such."""
        if not text:
            return []
        if self.specials is None or not self.specials.search(text):
            return [self[p] for p in self.cuts.findall(text)]
        out = []
        for k, stretch in enumerate(self.specials.split(text)):
            if k % 2:
                out.append((str(self.special[stretch]), 1, self.text_bytes([self.special[stretch]])))
            else:
                out += [self[p] for p in self.cuts.findall(stretch)]
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for part in self.parts(text) for i in part[0].split(",")]

    def decode(self, ids: list[int]) -> str:
        return self.text_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, remembered: int = REMEMBERED) -> Codec:
    return Codec(path, remembered)


def encode(docs: DataFrame, path: str, text: str = "text", outputs: tuple[str, ...] = ("ids", "n_tokens"), remembered: int = REMEMBERED) -> DataFrame:
    """``docs`` with the chosen outputs: ``ids``, ``n_tokens``, ``ids_sha256`` (of the decimal ids, joined by commas), ``decoded``,
    ``decoded_sha256`` (of the decoded text in UTF-8). ``path`` names a tokenizer file that every executor has. A worker
    remembers the tokens of up to twice ``remembered`` pieces, some 300 bytes each, also after its task; fewer cost time, never a token.

    Repeated rows each have their row, texts of any length are encoded whole, and an empty table gives no rows. Null and empty texts have no tokens and decode to the empty text. Columns named as an output are replaced.
    """
    columns = [c for c in docs.columns if c not in outputs]
    schema = docs.select(*columns).schema
    for name in outputs:
        schema = schema.add(name, OUTPUTS[name])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path, remembered)
        for pdf in batches:
            made: dict[str, list] = {name: [] for name in outputs}
            for t in pdf[text]:
                parts = own.parts(t)
                ids = ",".join([p[0] for p in parts])
                for name, values in made.items():
                    if name == "n_tokens":
                        values.append(sum([p[1] for p in parts]))
                    elif name == "ids":
                        values.append(np.fromiter(map(int, ids.split(",") if ids else ()), np.int32))
                    elif name == "ids_sha256":
                        values.append(hashlib.sha256(ids.encode()).hexdigest())
                    else:
                        decoded = b"".join([p[2] for p in parts]).decode("utf-8", "replace")
                        values.append(decoded if name == "decoded" else hashlib.sha256(decoded.encode()).hexdigest())
            yield pdf.assign(**made)

    return docs.select(*columns).mapInPandas(scan, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each row's token ids; null ids give the empty text. An id outside the vocabulary is an error."""
    columns = [c for c in docs.columns if c != out]
    schema = docs.select(*columns).schema.add(out, "string")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        for pdf in batches:
            yield pdf.assign(**{out: [own.decode([int(i) for i in x]) if x is not None else "" for x in pdf[ids]]})

    return docs.select(*columns).mapInPandas(scan, schema)
