"""SimHash near-duplicates, found through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from candlewick.llm.common import kept, release
from candlewick.llm.components import connected

#: Random references of the distance table, and cells with more fingerprints than CELL are divided further.
REFERENCES, CELL, SEED = 16, 32, 42


def fingerprint(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles, each counted as often as it occurs; zero for a text without words."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths + 1) - 1
        spans = zip((ends - lengths)[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, len(parts) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        octets = hashes[at : at + 16384].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, out: str = "simhash") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit column. A null text counts as empty; other columns stay."""
    columns = [c for c in docs.columns if c != out]
    schema = docs.select(*columns).schema.add(out, "long")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = [fingerprint(t, words) for t in pdf[text]]
            yield pdf.assign(**{out: np.array(values, np.uint64).view(np.int64)})

    return docs.select(*columns).mapInPandas(scan, schema)


def _references(n: int, bits: int, seed: int) -> list[int]:
    rng = np.random.default_rng(seed)
    return [int.from_bytes(rng.bytes(8), "big") & ((1 << bits) - 1) for _ in range(n)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _table(value: Column, bits: int, n: int, seed: int) -> list[Column]:
    """Hamming distances of a value to ``n`` references, as the table of distances holds them."""
    return [F.bit_count(value.bitwiseXOR(F.lit(_signed(r)))) for r in _references(n, bits, seed)]


def _divided(rows: DataFrame, width: int) -> DataFrame:
    """Each row once per pair of blocks among the four that its ``rest`` of ``width`` bits has.

    Fingerprints that differ in at most two bits agree in at least two of four blocks. A cell is named by the
    distances, within its two blocks, to as many references as a block has bits: equal blocks have equal
    distances, so linked fingerprints share a cell.
    """
    part = width // 4
    mask = F.lit((1 << part) - 1).cast("long")
    block = [F.shiftrightunsigned("rest", part * k).bitwiseAND(mask) for k in range(4)]
    tables = [F.array(*_table(b, part, part, part)) for b in block]
    choices = []
    for i, j in combinations(range(4), 2):
        free = [k for k in range(4) if k not in (i, j)]
        left = F.shiftleft(block[free[1]], part).bitwiseOR(block[free[0]])
        choices.append(F.struct(F.xxhash64("cell", F.lit(i * 4 + j), tables[i], tables[j]).alias("cell"), left.alias("rest")))
    return rows.select("fp", F.explode(F.array(*choices)).alias("c")).select("fp", "c.cell", "c.rest")


def _links(cells: DataFrame, most: int, references: int) -> DataFrame:
    """Links within cells of bounded size: pairs whose distances to a reference differ by more than ``most`` are
    discarded, the others verified."""
    member = F.struct("fp", F.array(*[d.cast("byte") for d in _table(F.col("fp"), 64, references, SEED)]).alias("table"))
    listed = cells.groupBy("cell").agg(F.collect_list(member).alias("members"))

    def near(a: Column, b: Column) -> Column:
        apart = F.zip_with(a["table"], b["table"], lambda x, y: F.abs(x.cast("int") - y.cast("int")))
        return (b["fp"] > a["fp"]) & (F.array_max(apart) <= most) & (F.bit_count(a["fp"].bitwiseXOR(b["fp"])) <= most)

    pairs = F.transform(
        "members",
        lambda a: F.transform(F.filter("members", lambda b: near(a, b)), lambda b: F.struct(a["fp"].alias("a"), b["fp"].alias("b"))),
    )
    return listed.select(F.inline(F.flatten(pairs)))


def links_within(fps: DataFrame, most: int = 2, cell: int = CELL, references: int = REFERENCES) -> DataFrame:
    """All pairs ``a`` < ``b`` of distinct fingerprints (column ``fp``) that differ in at most two bits.

    Cells with more than ``cell`` fingerprints are divided by the bits that they don't share yet, up to four times; then
    four bits are left, so that a cell can't hold more than 16. No pair is lost and no large group is ever paired.
    """
    if most > 2:
        raise ValueError("cells of two blocks out of four hold all links of at most two bits only")
    rows = fps.select("fp", F.lit(0).cast("long").alias("cell"), F.col("fp").alias("rest"))
    found = []
    for width in (64, 32, 16, 8):
        rows = _divided(rows, width)
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = kept(rows.join(sizes, "cell"), "cells")
        small = F.col("n") <= (cell if width > 8 else max(cell, 16))  # the last cells can't be divided and needn't be
        found.append(kept(_links(sized.filter(small), most, references), "near"))
        rows = sized.filter(~small).select("fp", "cell", "rest")
        if rows.isEmpty():
            break
    return reduce(DataFrame.union, found).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, most: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``simhash`` (signed long), ``component_id``: the smallest ``doc_id`` that links reach.

    Fingerprints link at ``most`` or fewer differing bits. Equal fingerprints are one node, so a large group of copies costs
    one row. Texts without words, null ones too, have fingerprint zero and link as any other. A null ``doc_id``
    never is a component's name unless it has no other document. Repeated rows each get their row; no rows give none.
    """
    spark = docs.sparkSession
    marked = kept(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), words=words).drop("text"), "fingerprints")
    nodes = marked.groupBy(F.col("simhash").alias("fp")).agg(F.min("doc_id").alias("first"))
    roots = connected(links_within(nodes, most), "a", "b")
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = kept(placed, "placed")
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    component = placed.join(names, "root").select(F.col("fp").alias("simhash"), "component_id")
    release(spark)
    return marked.join(component, "simhash").select("doc_id", "simhash", "component_id")
