"""Quality classifier: a factorisation machine over hashed words and structure statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows that the model is fitted on at most; hashed word features; width of the pairwise interactions.
FIT_ROWS, BINS, RANK = 6_000, 1 << 14, 8

_CLASSES = np.zeros(256, np.int8)
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:'\"()-", b"!?")):
    _CLASSES[list(_bytes)] = _kind + 1
_CLASSES[128:] = 8
STATISTICS = 26


def statistics(text: str, words: list[str], counts: Counter) -> np.ndarray:
    """Shape of a text: shares of kinds of characters, lengths, repetition, lines; each about 0 to 1."""
    out = np.zeros(STATISTICS, np.float32)
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        out[0] = 1.0
        return out
    out[1:10] = np.bincount(_CLASSES[raw], minlength=9)[:9] / len(raw)
    n, upper, letters = max(len(words), 1), sum(map(str.isupper, words)), sum(map(str.isalpha, words))
    plain = sum(w[-1] in ".,;:" for w in words)
    lines = [x for x in text.split("\n") if x.strip()]
    out[10] = upper / n
    out[11] = letters / n
    out[12] = plain / n
    out[13] = len(counts) / n
    out[14] = (counts.most_common(1)[0][1] / n) if counts else 0
    out[15] = sum(c for c in counts.values() if c > 1) / n
    out[16] = min(sum(map(len, words)) / n / 12, 2)
    out[17] = min(np.log1p(n) / 10, 2)
    out[18] = len(set(lines)) / max(len(lines), 1)
    out[19] = min(np.log1p(n / max(len(lines), 1)) / 6, 2)
    out[20] = sum(len(w) == 1 and not w.isalnum() for w in words) / n
    out[21] = sum(w[-1] in "!?#$%&*" for w in words) / n
    out[22] = sum(map(str.isdigit, words)) / n
    out[23] = sum(map(str.istitle, words)) / n
    out[24] = min(text.count("http") / n * 10, 2)
    out[25] = len(set(zip(words, words[1:], strict=False))) / n
    return out


def features(text: str | None, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: hashed words of a text by damped frequency, of length one in all, then its statistics."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    hashed = Counter()
    for word, n in counts.items():
        hashed[crc32(word.lower().encode()) % bins] += n
    index = np.fromiter(hashed, np.int32, len(hashed))
    value = np.sqrt(np.fromiter(hashed.values(), np.float32, len(hashed)))
    if len(value):
        value /= np.linalg.norm(value)
    shape = statistics(text, words, counts)
    return np.concatenate([index, np.arange(bins, bins + STATISTICS, dtype=np.int32)]), np.concatenate([value, shape])


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    bins: int

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        """Bias, single weights and all pairwise interactions, in linear time: (square of sums - sum of squares) / 2."""
        scaled = self.factors[index] * value[:, None]
        sums = scaled.sum(0)
        return self.bias + float(self.weights[index] @ value) + 0.5 * float(sums @ sums - (scaled * scaled).sum())

    def score(self, text: str | None) -> float:
        margin = min(max(self.margin(*features(text, self.bins)), -30.0), 30.0)
        return 1.0 / (1.0 + np.exp(-margin))


def fit_machine(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bins: int = BINS, rank: int = RANK,
    passes: int = 6, rate: float = 0.08, decay: float = 2e-5, batch: int = 64, seed: int = 7,
) -> FactorisationMachine:
    """Logistic loss, mini-batches, per-weight step sizes. Without rows, or with one label only, the scores are that share."""
    rng = np.random.default_rng(seed)
    size = bins + STATISTICS
    w, v = np.zeros(size), rng.normal(0, 0.02, (size, rank))
    share = float(labels.mean()) if len(labels) else 0.5
    bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not 0 < share < 1:
        return FactorisationMachine(bias, w.astype(np.float32), np.zeros((size, rank), np.float32), bins)
    seen_w, seen_v, seen_b = np.full(size, 1e-4), np.full((size, rank), 1e-4), 1e-4
    for _ in range(passes):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            index = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen]).astype(np.float64)
            lengths = [len(rows[i][0]) for i in chosen]
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            owner = np.repeat(np.arange(len(chosen)), lengths)
            scaled = v[index] * value[:, None]
            sums = np.add.reduceat(scaled, starts)
            margin = bias + np.add.reduceat(w[index] * value, starts) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((scaled**2).sum(1), starts))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            step = error[owner] * value
            touched, where = np.unique(index, return_inverse=True)
            grad_w = np.bincount(where, step, len(touched)) + decay * w[touched]
            each = step[:, None] * (sums[owner] - scaled)
            grad_v = np.stack([np.bincount(where, each[:, k], len(touched)) for k in range(rank)], 1) + decay * v[touched]
            seen_w[touched] += grad_w**2
            seen_v[touched] += grad_v**2
            seen_b += error.sum() ** 2
            w[touched] -= rate * grad_w / np.sqrt(seen_w[touched])
            v[touched] -= rate * grad_v / np.sqrt(seen_v[touched])
            bias -= rate * error.sum() / np.sqrt(seen_b)
    return FactorisationMachine(float(bias), w.astype(np.float32), v.astype(np.float32), bins)


def held_out(doc_id: str | Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 2 when divided by 4. Null ids aren't held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS, bins: int = BINS) -> FactorisationMachine:
    """Fit on at most ``fit_rows`` labelled documents (those whose id hashes lowest) that aren't held out.

    The sample is a documented bound: ids and labels of it are broadcast, and its hashed features reach the driver. Labels
    that are null, or given twice with different values, are left out.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    single = usable.groupBy("doc_id").agg(F.min(label).alias("__label"), F.max(label).alias("__most")).filter("__label = __most")
    sample = single.select("doc_id", "__label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [features(t, bins) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["__label"], "index": [m[0].astype("<i4").tobytes() for m in made], "value": [m[1].astype("<f2").tobytes() for m in made]})

    rows = chosen.mapInPandas(scan, "doc_id long, label int, index binary, value binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r["index"])))
    pairs = [(np.frombuffer(r["index"], "<i4"), np.frombuffer(r["value"], "<f2").astype(np.float32)) for r in rows]
    return fit_machine(pairs, np.array([float(r["label"] == 1) for r in rows]), bins)


def scored(docs: DataFrame, machine: FactorisationMachine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1. Null and empty texts score alike."""
    columns = [c for c in docs.columns if c != out]
    schema = docs.select(*columns).schema.add(out, "double")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: [float(machine.score(t)) for t in pdf[text]]})

    return docs.select(*columns).mapInPandas(scan, schema)
