"""Token counts: greedy longest-match word pieces by a linear automaton that never builds a piece."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from candlewick.llm.bpe import byte_letters, cuts

#: Distinct pieces of text whose counts a Python worker remembers.
REMEMBERED = 400_000


class PieceCounter(dict):
    """Vocabulary trie with failure links. ``popped[v]`` tokens are complete when the automaton leaves node ``v`` by its failure link.

    Every single symbol is in the vocabulary, so that any word can be cut. As a dictionary it remembers counts.
    """

    def __init__(self, vocabulary: list[str], symbols: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        ends, parent, label = [False], [0], [""]
        for piece in {*vocabulary, *symbols}:
            node = 0
            for c in piece:
                to = self.next[node].get(c)
                if to is None:
                    to = self.next[node][c] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                    parent.append(node)
                    label.append(c)
                node = to
            ends[node] = True
        self.fail, self.popped = [0] * len(self.next), [0] * len(self.next)
        queue = list(self.next[0].values())
        for v in queue:  # by depth
            queue.extend(self.next[v].values())
            if ends[v]:  # the whole string is one piece, nothing is left over
                self.fail[v], self.popped[v] = 0, 1
                continue
            # The longest piece along the parent's failures is complete; what follows goes on from there.
            u, count = self.fail[parent[v]], self.popped[parent[v]]
            while label[v] not in self.next[u]:
                u, count = self.fail[u], count + self.popped[u]
            self.fail[v], self.popped[v] = self.next[u][label[v]], count

    def count(self, symbols: str) -> int:
        """Number of pieces that greedy longest match gives, in time linear in the length."""
        node, total = 0, 0
        for c in symbols:
            while c not in self.next[node]:
                total += self.popped[node]
                node = self.fail[node]
            node = self.next[node][c]
        while node:
            total += self.popped[node]
            node = self.fail[node]
        return total


class TextCounter(dict):
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.letters = byte_letters()
        self.automaton = PieceCounter(list(vocabulary), self.letters)

    def __missing__(self, piece: str) -> int:
        n = self.automaton.count("".join([self.letters[b] for b in piece.encode()]))
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n

    def count(self, text: str | None) -> int:
        return sum([self[p] for p in cuts().findall(text)]) if text else 0


@lru_cache(maxsize=2)
def counter(path: str) -> TextCounter:
    return TextCounter(path)


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of word pieces of each whole text: pieces between cuts are matched greedily, longest first, over the
    vocabulary of the tokenizer file at ``path``. Null and empty texts have none. A column named as the result is replaced."""
    columns = [c for c in docs.columns if c != out]
    schema = docs.select(*columns).schema.add(out, "long")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(path)
        for pdf in batches:
            yield pdf.assign(**{out: [own.count(t) for t in pdf[text]]})

    return docs.select(*columns).mapInPandas(scan, schema)
