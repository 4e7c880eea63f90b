"""Two tokenizers side by side: groups of tokens that end together, links of overlapping tokens, and how often each link occurs in the corpus."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from candlewick.llm.bpe import byte_letters, cuts
from candlewick.llm.common import kept

#: Characters aligned at a time; segments whose tokens a worker remembers in each of two generations, and the longest of them.
CHUNK, REMEMBERED, REMEMBERED_CHARS = 2_000_000, 200_000, 48
#: Links with the highest counts that are broadcast (16 bytes each); documents meet the others in a join.
BROADCAST = 1_000_000

PAIRS = T.ArrayType(T.StructType().add("pair", "long").add("n", "long"))
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Pair:
    """Both tokenizers of a worker, and the tokens of segments seen lately.

    A segment is text that neither tokenizer looks beyond: it ends where a space or line feed follows something else than white space.
    The byte-level one cuts there before it merges; no piece of the other goes on behind a space or holds a line feed, which
    its file is checked for. Else a text is one segment.
    """

    def __init__(self, first: str, second: str) -> None:
        with open(first, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, letters = model["vocab"], {c: b for b, c in enumerate(byte_letters())}
        merged = [vocab[m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("tokens have to be numbered in the order of their merges")
        made = {*merged, *(vocab[c] for c in letters)}
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            a_bytes[number] = bytes(letters[c] for c in token) if number in made else token.encode()
        self.merges = tiktoken.Encoding("merges", pat_str="(?s:.+)", mergeable_ranks={a_bytes[i]: i for i in made}, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=second)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        apart = all(re.fullmatch("▁*[^▁\n]*", p) for p in names)
        self.segment = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*|\s+" if apart else r"(?s:.+)")
        self.cut = re.compile(r"(?<=\S)[ \n]") if apart else None
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.n_b = len(names)
        ends = [(len(a_bytes), b","), (len(a_bytes), b"|"), (len(names), b","), (len(names), b";")]
        self.written = pa.array([str(i).encode() + end for n, end in ends for i in range(n)], pa.large_binary())
        self.starts = np.cumsum([0, *(n for n, _ in ends)])
        self.pieces_of = cuts()
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("i", ids).tobytes()

    def tokens(self, segments: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Tokens of each segment by both."""
        young, old, encode, cut, packed = self.young, self.old, self.merges.encode_ordinary, self.pieces_of.findall, self._packed
        found = [young.get(s) or old.get(s) for s in segments]
        missing = [k for k, f in enumerate(found) if f is None]
        # The second tokenizer puts a space before a text that isn't empty: taken off here, or hidden before a line feed.
        new = [segments[k] for k in missing]
        led = [len(s) > 1 and s[0] == " " for s in new]
        seconds = self.pieces.encode([s[1:] if own else "\n" + s for s, own in zip(new, led, strict=True)], num_threads=1) if new else []
        for k, s, own, second in zip(missing, new, led, seconds, strict=True):
            if own and s[1:].isalpha():  # letters behind a space are one piece
                first = encode(s)
            else:
                first = [i for piece in cut(s) for i in encode(piece)]
            found[k] = (packed(first), packed(second if own else second[2:]))
        young.update(zip(segments, found, strict=True) if max(map(len, segments), default=0) <= REMEMBERED_CHARS else ((s, f) for s, f in zip(segments, found, strict=True) if len(s) <= REMEMBERED_CHARS))
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return _lists([f[0] for f in found]), _lists([f[1] for f in found])


@lru_cache(maxsize=2)
def _loaded(first: str, second: str) -> Pair:
    return Pair(first, second)


def _lists(values: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(values), np.int32)))


def _ends(tokens: pa.ListArray, lengths: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and id of each token, and the byte of its parent at which it ends: a running sum, less what it was before the parent."""
    parents, ids = pc.list_parent_indices(tokens).to_numpy(), pc.list_flatten(tokens)
    running = pc.cumulative_sum(pc.take(lengths, ids)).to_numpy()
    before = np.concatenate([[0], running])[tokens.offsets.to_numpy()[:-1]]
    return parents, ids.to_numpy(), running - before[parents]


def _joined(values: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All bytes of an array just taken, one value behind the other, and where each value begins and the last ends."""
    _, offsets, data = values.buffers()
    wide = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    return memoryview(data or b"").cast("B"), np.frombuffer(offsets, wide, len(values) + 1) if len(values) else np.zeros(1, wide)


def _same(tokens: pa.ListArray, entries: pa.Array, texts: pa.Array) -> np.ndarray:
    """Whether the bytes of each list's tokens are its text."""
    flat, at = _joined(pc.take(entries, pc.list_flatten(tokens)))
    at = at[tokens.offsets.to_numpy()]
    raw, of = _joined(texts)
    if np.array_equal(at, of) and flat[: at[-1]] == raw[: of[-1]]:
        return np.ones(len(texts), bool)
    pairs = zip(at[:-1].tolist(), at[1:].tolist(), of[:-1].tolist(), of[1:].tolist(), strict=True)
    return np.fromiter((flat[a:b] == raw[c:d] for a, b, c, d in pairs), bool, len(texts))


@dataclass
class Aligned:
    """Segments with what they add to a text: counts, links as pairs of ids, and groups as written out."""

    right: np.ndarray
    counts: dict[str, np.ndarray]
    links: pa.ListArray
    written: pa.Array


def align(both: Pair, segments: pa.Array) -> Aligned:
    """Alignment of each segment.

    Tokens of both kinds meet in a full outer hash join on segment and end. In order of the ends, each row is one link: the
    first token of either kind that ends there or later covers the bytes up to it. Rows found on both sides end a group.
    """
    first, second = both.tokens(segments.to_pylist())
    raw = pc.take(segments.cast(pa.large_binary()), pa.array(np.arange(len(segments))))
    right = _same(first, both.a_bytes, raw) & _same(second, both.b_bytes, raw)
    if not right.all():  # nothing of them is counted, and their documents have no tokens
        keep = pa.array(right)
        empty = pa.scalar([], pa.list_(pa.int32()))
        first, second = (pc.if_else(keep, x, empty) for x in (first, second))
    sides = []
    for name, tokens, entries in (("a", first, both.a_bytes), ("b", second, both.b_bytes)):
        parents, ids, ends = _ends(tokens, pc.binary_length(entries).cast(pa.int64()))
        sides.append((parents, ids, (parents.astype(np.int64) << 32) | ends, name))
    tables = [pa.table({"end": key, name: ids.astype(np.int64)}) for _, ids, key, name in sides]
    joined = tables[0].join(tables[1], keys="end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    end = joined["end"].to_numpy()
    shared = pc.and_(pc.is_valid(joined["a"]), pc.is_valid(joined["b"])).to_numpy()
    a, b = (pc.fill_null_backward(joined[c]).to_numpy() for c in "ab")
    n = len(segments)
    parent = end >> 32
    n_links = np.bincount(parent, minlength=n)
    links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_links)]).astype(np.int32)), pa.array(a * both.n_b + b))
    cuts_at = end[shared]
    codes, groups = [], []
    for side, (parents, ids, key, _) in enumerate(sides):
        group = np.searchsorted(cuts_at, key)
        last = cuts_at[group] == key if len(key) else np.empty(0, bool)
        codes.append(ids + both.starts[2 * side + last.astype(np.int64)])
        groups.append(group * 2 + side)
    order = np.argsort(np.concatenate(groups), kind="stable")
    flat, at = _joined(pc.take(both.written, pa.array(np.concatenate(codes)[order])))
    counts = {"n_a": pc.list_value_length(first).to_numpy(), "n_b": pc.list_value_length(second).to_numpy(), "n_groups": np.bincount(parent[shared], minlength=n), "n_links": n_links}
    counts = {k: v.astype(np.int64) for k, v in counts.items()}
    bounds = at[np.concatenate([[0], np.cumsum(counts["n_a"] + counts["n_b"])])]
    written = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat)])
    return Aligned(right, counts, links, written)


@dataclass
class Document:
    """What the parts of a text have added so far."""

    counts: np.ndarray = field(default_factory=lambda: np.zeros(len(_COUNTS), np.int64))
    right: bool = True
    held: bytes = b""
    digest: object = field(default_factory=hashlib.sha256)
    pairs: list[np.ndarray] = field(default_factory=list)

    def result(self) -> tuple[np.ndarray, str, np.ndarray]:
        if not self.right or not self.counts[0]:
            return np.zeros(len(_COUNTS), np.int64), "", np.empty((2, 0), np.int64)
        self.digest.update(self.held[:-1])  # without the mark behind the last group
        return self.counts, self.digest.hexdigest(), np.concatenate(self.pairs, axis=1)


def _parts(text: str, cut: re.Pattern | None) -> Iterator[str]:
    """A long text in parts that end where a segment ends."""
    at = 0
    while cut and len(text) - at > CHUNK and (found := cut.search(text, at + CHUNK)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _chunks(texts: list[str | None], cut: re.Pattern | None) -> Iterator[list[tuple[int, str]]]:
    """Parts of texts with the text's number, about CHUNK characters at a time."""
    chunk, size = [], 0
    for k, text in enumerate(texts):
        for part in _parts(" " + text, cut) if text else [""]:
            if chunk and size + len(part) > CHUNK:
                yield chunk
                chunk, size = [], 0
            chunk.append((k, part))
            size += len(part)
    if chunk:
        yield chunk


def _add(both: Pair, parts: list[tuple[int, str]], documents: dict[int, Document]) -> None:
    """Add parts of texts to their documents."""
    cut = [both.segment.findall(part) for _, part in parts]
    listed = pa.array([s for c in cut for s in c], pa.large_string()).dictionary_encode()
    found = align(both, listed.dictionary)
    index = listed.indices.to_numpy()
    stops = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
    sums = {name: np.concatenate([[0], np.cumsum(v[index])]) for name, v in found.counts.items()}
    wrong = np.concatenate([[0], np.cumsum(~found.right[index])])
    flat, at = _joined(pc.take(found.written, listed.indices))
    part_of = np.repeat(np.arange(len(parts)), np.diff(sums["n_links"][stops]))
    width = len(both.a_bytes) * both.n_b
    key = part_of * width + pc.list_flatten(pc.take(found.links, listed.indices)).to_numpy()
    counted = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
    keys, times = counted["key"].to_numpy(), counted["count_all"].to_numpy()
    owner = (keys // width).astype(np.uint16 if len(parts) < 1 << 16 else np.int64)
    order = np.argsort(owner, kind="stable")
    keys, times = keys[order], times[order]
    bounds = np.searchsorted(owner[order], np.arange(len(parts) + 1))
    for p, (k, _) in enumerate(parts):
        doc = documents.setdefault(k, Document())
        lo, hi = stops[p], stops[p + 1]
        doc.counts += [sums[name][hi] - sums[name][lo] for name in _COUNTS]
        doc.right &= bool(wrong[hi] == wrong[lo])
        doc.digest.update(doc.held)
        doc.held = bytes(flat[at[lo] : at[hi]])
        own = slice(bounds[p], bounds[p + 1])
        doc.pairs.append(np.stack([keys[own] - p * width, times[own]]))


def _scanned(batch: pa.RecordBatch, both: Pair) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with their alignment, as soon as no part of them is left."""
    row, doc_id, text = (batch.column(k) for k in range(3))
    documents: dict[int, Document] = {}
    done = 0
    for parts in [*_chunks(text.to_pylist(), both.cut), []]:
        last = parts[0][0] if parts else batch.num_rows
        if last > done:
            results = [documents.pop(k).result() for k in range(done, last)]
            counts = np.stack([r[0] for r in results])
            pairs = np.concatenate([r[2] for r in results], axis=1)
            offsets = np.concatenate([[0], np.cumsum([r[2].shape[1] for r in results])]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["pair", "n"])
            yield pa.RecordBatch.from_arrays(
                [row.slice(done, last - done), doc_id.slice(done, last - done), *(pa.array(c) for c in counts.T), pa.array([r[1] for r in results]), pa.ListArray.from_arrays(pa.array(offsets), structs)],
                ["row", "doc_id", *_COUNTS, "groups_sha256", "pairs"],
            )
            done = last
        if parts:
            _add(both, parts, documents)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs of each batch."""
    for batch in batches:
        flat = pc.list_flatten(batch.column(0))
        counted = pa.table({"pair": pc.struct_field(flat, 0), "n": pc.struct_field(flat, 1)}).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        yield from counted.select(["pair", "n_sum"]).rename_columns(["pair", "n"]).to_batches()


def aligned(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text", broadcast: int = BROADCAST) -> tuple[DataFrame, DataFrame]:
    """Documents with their alignment, and all links with their counts.

    The first holds one row per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``; the
    second ``a``, ``b``, ``count``, ``best`` (no link of that ``b`` has a higher count). ``first`` is the file of a byte-level merge
    tokenizer, ``second`` that of a sentence-piece model; workers read both. A text that is null or empty, or that the joined tokens of either don't give back,
    has no tokens: zeros and ''. Long texts are taken in parts; repeated rows each have a row; null ids stay; other columns are left out. An
    empty table gives no rows.

    Texts are tokenized once. Each document keeps its distinct links with their number; their sums by tasks are merged by Spark. The ``broadcast`` most
    frequent links go to all tasks; a link beyond them, rare by then, meets its count in a join.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded(first, second)
        for batch in batches:
            yield from _scanned(batch, both)

    schema = rows.select("row", "doc_id").schema
    for name in _COUNTS:
        schema = schema.add(name, "long")
    marked = kept(rows.mapInArrow(scan, schema.add("groups_sha256", "string").add("pairs", PAIRS)), "aligned")
    merged = marked.select("pairs").mapInArrow(_partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("count"))
    n_b = sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()
    merged = kept(merged.select("pair", F.floor(F.col("pair") / n_b).alias("a"), (F.col("pair") % n_b).alias("b"), "count"), "links")
    most = merged.groupBy("b").agg(F.max("count").alias("most"))
    links = kept(merged.join(most, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "counts")

    value = links.select("pair", "count", "best")
    top = value.orderBy(F.desc("count"), "pair").limit(broadcast)
    met = marked.select("row", F.inline("pairs")).join(F.broadcast(top), "pair", "left")
    found = [met.filter("count is not null")]
    if links.count() > broadcast:
        found.append(met.filter("count is null").drop("count", "best").join(value, "pair").select(*met.columns))
    sums = [f.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")) for f in found]
    total = sums[0] if len(sums) == 1 else sums[0].union(sums[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return marked.join(total, "row", "left").select("doc_id", *_COUNTS, *zero, "groups_sha256"), links.drop("pair")
