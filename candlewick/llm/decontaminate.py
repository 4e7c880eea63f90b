"""Benchmark passages in documents: one Aho-Corasick automaton over normalised questions and answers."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from candlewick.llm.common import WORD_BYTES, plain_words

#: Most characters of benchmark text in one automaton; a larger benchmark is dealt to several that scan in turn.
AUTOMATON_CHARS = 400_000

FOUND = "words long, hits array<struct<start:int,end:int>>, items array<string>"


@lru_cache(maxsize=4)
def automaton(items: tuple[tuple[str, str], ...], window: int) -> ahocorasick.Automaton | None:
    """Automaton over every window of the items, each between blanks; it yields the window's words and items."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        words = plain_words(text)
        for at in range(max(len(words) - window + 1, min(len(words), 1))):
            owners.setdefault(b" ".join(words[at : at + window]), set()).add(item)
    if not owners:
        return None
    built = ahocorasick.Automaton()
    for passage, ids in owners.items():
        built.add_word(f" {passage.decode('latin-1')} ", (passage.count(b" ") + 1, tuple(ids)))
    built.make_automaton()
    return built


def scan_text(text: str | None, built: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Number of words; merged word ranges inside occurrences of a window; items whose windows occur."""
    words = plain_words(text)
    if not words or built is None:
        return len(words), [], []
    line = " " + b" ".join(words).decode("latin-1") + " "  # one character a byte, so that offsets are those of bytes
    blanks: list[int] = []
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    for end, (length, ids) in built.iter(line):
        if not blanks:
            blanks = [i for i, c in enumerate(line) if c == " "]
        last = bisect_left(blanks, end)  # words before this blank
        ranges.append((last - length, last))
        items.update(ids)
    return len(words), merged(ranges), sorted(items)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def character_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character ranges of the original text."""
    raw = text.encode()
    plain = raw.translate(WORD_BYTES)
    starts, ends, at = [], [], 0
    for word in plain.split():
        at = plain.index(word, at)
        starts.append(at)
        at += len(word)
        ends.append(at)
    opened = [i for i, b in enumerate(raw) if b & 0xC0 != 0x80]  # bytes that begin a character
    place = lambda byte: bisect_right(opened, byte) - 1
    return [(place(starts[a]), place(ends[b - 1] - 1) + 1) for a, b in ranges]


def _shards(benchmark: DataFrame, most_chars: int) -> list[tuple[tuple[str, str], ...]]:
    """The items in parts of bounded size. The number of parts follows from the benchmark's measured size."""
    items = benchmark.filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // most_chars)
    if parts <= 1:
        chosen = [items] * parts
    else:
        part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
        chosen = [items.filter(part == k) for k in range(parts)]
    return [tuple(sorted({(r.item, r.text) for r in c.collect()})) for c in chosen]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    spans: bool = False,
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """``docs`` with ``words`` (their number), ``hits`` (word ranges inside a benchmark window, merged), ``items`` (sorted ids as
    strings) and, if asked for, ``spans`` (the ranges as characters of the original text).

    A window is ``window`` consecutive words of an item, or a shorter item whole. Null and empty texts have no words and
    no hits; null items and items without words are never found; a null item id counts as the empty string. Repeated
    items count once. Columns of ``docs`` named as the four are replaced, others stay.
    """
    columns = [c for c in docs.columns if c not in ("words", "hits", "items", "spans")]
    named = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    shards = _shards(named, automaton_chars) or [()]
    base = docs.select(*columns)
    out = base.select("*", F.expr("0L").alias("words"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"))
    if spans:
        out = out.withColumn("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"))
    schema = out.schema

    def scanner(items: tuple[tuple[str, str], ...], last: bool):
        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            built = automaton(items, window)
            for pdf in batches:
                rows = []
                for t, before, known in zip(pdf[text], pdf["hits"], pdf["items"], strict=True):
                    n, ranges, ids = scan_text(t, built)
                    if len(before):
                        ranges = merged([*ranges, *((h["start"], h["end"]) for h in before)])
                    rows.append((n, ranges, sorted({*ids, *known})))
                new = {"words": [r[0] for r in rows], "hits": [_structs(r[1]) for r in rows], "items": [r[2] for r in rows]}
                if spans and last:
                    new["spans"] = [_structs(character_spans(t, r[1])) if r[1] else [] for t, r in zip(pdf[text], rows, strict=True)]
                yield pdf.assign(**new)

        return scan

    for k, items in enumerate(shards):
        out = out.mapInPandas(scanner(items, k == len(shards) - 1), schema)
    return out


def _structs(ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "end": b} for a, b in ranges]


def hit_words() -> F.Column:
    """Number of words inside the ranges of ``hits``."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + (h["end"] - h["start"]))


def without_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents that hold no benchmark window, with their columns; clean documents all stay."""
    if {"words", "hits", "items", "spans", "__text"} & {*docs.columns}:  # their own columns of these names come back
        return _beside(docs, benchmark, window)
    marked = find_passages(docs.withColumn("__text", F.col("text")), benchmark, text="__text", window=window)
    return marked.filter(F.size("hits") == 0).select(*docs.columns)


def _beside(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("__text"))
    return find_passages(packed, benchmark, text="__text", window=window).filter(F.size("hits") == 0).select("row.*")
