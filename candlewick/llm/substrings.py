"""Repeated passages: confirmed by hashes, then located by sharded Aho-Corasick automata over their phrases."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from candlewick.llm.common import discard, hash_words, kept, release, window_hashes
from candlewick.llm.decontaminate import merged

#: Words of the phrase that anchors a window; stretches of text in one shard's automaton and scan, about.
ANCHOR, SHARD_STRETCHES = 8, 40_000
#: Bytes of text searched at once, about.
SEARCHED_BYTES = 1_000_000
#: Windows of one batch on their way to Spark, about.
BATCH_WINDOWS = 500_000


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return text.encode().split() if text else []


def anchors(hashes: np.ndarray, window: int, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the place of its anchor: the phrase of ``anchor`` words in it with the least hash, the leftmost of equal ones;
    and the hashes of all phrases. Equal windows have equal anchors."""
    phrases = window_hashes(hashes, anchor)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), phrases
    return _leftmost_least(phrases, window - anchor + 1)[:n], phrases


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least of each run of ``width`` values, from runs of doubled width, the last two overlapping."""
    least, place, run = values, np.arange(len(values)), 1
    while run < width:
        step = min(run, width - run)
        right = least[step:]
        lower = right < least[: len(right)]
        least = np.where(lower, right, least[: len(right)])
        place = np.where(lower, place[step:], place[: len(right)])
        run += step
    return place


def _anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``row``, ``hash``, ``place`` (arrays, one entry for each anchor of the text)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, hashed, placed = [], [], []
            for row, text in zip(pdf["row"], pdf["text"], strict=True):
                place, phrases = anchors(hash_words(split_words(text)), window, anchor)
                if len(place):
                    place = np.unique(place)
                    rows.append(row)
                    hashed.append(phrases[place].view(np.int64))
                    placed.append(place.astype(np.int32))
            yield pd.DataFrame({"row": rows, "hash": hashed, "place": placed})

    return docs.select("row", "text").mapInPandas(scan, "row binary, hash array<long>, place array<int>")


def _windows(held: DataFrame, window: int, anchor: int) -> DataFrame:
    """Hash, document, start and row's key of each window whose anchor occurs elsewhere too, with the anchor's hash."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made, size = [], 0
            for doc, key, text, places in zip(pdf["doc"], pdf["key"], pdf["text"], pdf["places"], strict=True):
                hashes = hash_words(split_words(text))
                place, phrases = anchors(hashes, window, anchor)
                start = np.flatnonzero(np.isin(place, places))
                made.append((window_hashes(hashes, window)[start], np.full(len(start), doc, np.int64), start.astype(np.int32), np.full(len(start), key, np.int64), route(phrases[place[start]])))
                size += len(start)
                if size >= BATCH_WINDOWS:
                    yield _frame(made)
                    made, size = [], 0
            if made:
                yield _frame(made)

    return held.select("doc", F.col("number").alias("key"), "text", "places").mapInPandas(scan, "hash long, doc long, start int, key long, anchor int")


def route(phrases: np.ndarray) -> np.ndarray:
    """Half of an anchor's hash, which decides its shard."""
    return (phrases >> np.uint64(33)).astype(np.int32)


def _frame(made: list[tuple]) -> pd.DataFrame:
    hashed, doc, start, key, anchor = (np.concatenate(column) for column in zip(*made, strict=True))
    return pd.DataFrame({"hash": hashed.view(np.int64), "doc": doc, "start": start, "key": key, "anchor": anchor})


def _stretches(held: DataFrame, shards: int, window: int, anchor: int) -> DataFrame:
    """The parts of each text to search: for each shard, runs of consecutive windows whose anchor belongs to it."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for row, doc, text, places in zip(pdf["row"], pdf["doc"], pdf["text"], pdf["places"], strict=True):
                words = split_words(text)
                place, phrases = anchors(hash_words(words), window, anchor)
                start = np.flatnonzero(np.isin(place, places))
                shard = route(phrases[place[start]]) % shards
                out += [(int(shard[a]), row, doc, int(start[a]), b" ".join(words[start[a] : start[b] + window])) for a, b in _runs(start, shard)]
            yield pd.DataFrame(out, columns=["shard", "row", "doc", "at", "words"])

    return held.mapInPandas(scan, "shard long, row binary, doc long, at int, words binary")


def _runs(start: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last index of each run of consecutive starts in one shard."""
    if len(start):
        ends = np.flatnonzero((np.diff(start) != 1) | (np.diff(shard) != 0))
        yield from zip([0, *(ends + 1).tolist()], [*ends.tolist(), len(start) - 1], strict=True)


def _passages(held: DataFrame, firsts: DataFrame, shards: int, window: int) -> DataFrame:
    """Recurring passages where they occur first: runs of consecutive confirmed windows of one text and shard."""
    listed = firsts.groupBy("key").agg(F.collect_list(F.struct("start", "anchor")).alias("firsts"))  # at most one for each word of the text

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for doc, text, found in zip(pdf["doc"], pdf["text"], pdf["firsts"], strict=True):
                words = split_words(text)
                start = np.array([f["start"] for f in found], np.int64)
                order = np.argsort(start, kind="stable")
                start, shard = start[order], np.array([f["anchor"] for f in found], np.int32)[order] % shards
                out += [(int(shard[a]), b"", doc, int(start[a]), b" ".join(words[start[a] : start[b] + window])) for a, b in _runs(start, shard)]
            yield pd.DataFrame(out, columns=["shard", "row", "doc", "at", "words"])

    # Several texts may have one document number, null ones above all; a passage is cut from the text in which it was confirmed.
    joined = held.withColumnRenamed("number", "key").join(listed, "key").select("doc", "text", "firsts")
    return joined.mapInPandas(scan, "shard long, row binary, doc long, at int, words binary")


#: Stands between texts searched together. White space separates words, so no word is a line feed.
BETWEEN = b" \n "


class _Words:
    """Texts one after another: their words, where each word lies among the bytes, and where each text's words begin."""

    def __init__(self, texts: list[bytes], window: int) -> None:
        self.text, self.window = BETWEEN.join(texts), window
        parts = self.text.split(b" ")
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.blank = np.cumsum(lengths + 1)  # place of the blank after each word, when a blank is put before the text
        self.byte = self.blank - lengths - 1
        self.hashes = window_hashes(hash_words(parts), window)
        self.sizes = np.fromiter((t.count(b" ") + 1 for t in texts), np.int64, len(texts))
        self.begin = np.cumsum(self.sizes + 1) - self.sizes - 1

    def whole(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of windows at these words the ones within one text, the text, and the window's place in it."""
        owner = np.searchsorted(self.begin, places, "right") - 1
        local = places - self.begin[owner]
        inside = local + self.window <= self.sizes[owner]
        return places[inside], owner[inside], local[inside]

    def cut(self, first: int, last: int) -> bytes:
        """The bytes of the windows from one to another."""
        return self.text[self.byte[first] : self.blank[last + self.window - 1] - 1]


class PhraseAutomaton:
    """Aho-Corasick automaton over the phrases of a shard's passages, and where each of their windows occurs first.

    A window that starts anywhere in a passage holds one of the phrases cut off it one after another.
    """

    def __init__(self, window: int) -> None:
        self.window, self.phrase = window, (window + 1) // 2
        self.passages: list[tuple[int, int, bytes]] = []
        self.built: ahocorasick.Automaton | None = None

    def add(self, doc: int, at: int, words: bytes) -> None:
        self.passages.append((doc, at, words))

    def _build(self) -> None:
        self.built = ahocorasick.Automaton()
        for _, _, words in self.passages:
            parts = words.split(b" ")
            for k in range(0, len(parts) - self.phrase + 1, self.phrase):
                self.built.add_word(" " + b" ".join(parts[k : k + self.phrase]).decode("latin-1") + " ", self.phrase)
        self.built.make_automaton()
        self.known = _Words([words for _, _, words in self.passages], self.window)
        place, owner, local = self.known.whole(np.arange(len(self.known.hashes)))
        doc = np.array([d for d, _, _ in self.passages], np.int64)[owner]
        at = np.array([a for _, a, _ in self.passages], np.int64)[owner] + local
        hashes = self.known.hashes[place]
        order = np.lexsort((at, doc, hashes))
        first = order[np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0)]
        self.hashes, self.doc, self.at, self.place = hashes[first], doc[first], at[first], place[first]
        self.passages = []

    def repeats(self, doc: np.ndarray, at: np.ndarray, texts: list[bytes]) -> list[tuple[int, int, int]]:
        """Of stretches of text: which one, and its word ranges covered by windows that also start earlier."""
        if self.built is None:
            if not self.passages:
                return []
            self._build()
        new = _Words(texts, self.window)
        n = len(new.hashes)
        found = np.fromiter((end for end, _ in self.built.iter(" " + new.text.decode("latin-1") + " ")), np.int64)
        if not len(found) or not n:
            return []
        begin = np.searchsorted(new.blank, found) - self.phrase + 1  # the phrase's first word
        change = np.bincount(np.maximum(begin - (self.window - self.phrase), 0), minlength=n + self.window)
        change = change - np.bincount(begin + 1, minlength=len(change))[: len(change)]
        place, owner, local = new.whole(np.flatnonzero(np.cumsum(change)[:n] > 0))
        slot = np.minimum(np.searchsorted(self.hashes, new.hashes[place]), len(self.hashes) - 1)
        mine_doc, mine_at = doc[owner], at[owner] + local
        earlier = (self.doc[slot] < mine_doc) | ((self.doc[slot] == mine_doc) & (self.at[slot] < mine_at))
        same = np.flatnonzero((self.hashes[slot] == new.hashes[place]) & earlier)
        place, owner, mine_at, there = place[same], owner[same], mine_at[same], self.place[slot[same]]
        # Windows one after another in both texts are compared at once.
        ends = np.flatnonzero((np.diff(place) != 1) | (np.diff(there) != 1))
        out: list[tuple[int, int, int]] = []
        for a, b in zip([0, *(ends + 1).tolist()], [*ends.tolist(), len(place) - 1], strict=True) if len(place) else ():
            if new.cut(place[a], place[b]) == self.known.cut(there[a], there[b]):
                runs = [(a, b)]
            else:  # equal hashes of different words
                runs = [(k, k) for k in range(a, b + 1) if new.cut(place[k], place[k]) == self.known.cut(there[k], there[k])]
            for c, d in runs:
                start, end = int(mine_at[c]), int(mine_at[d]) + self.window
                if out and out[-1][0] == owner[c] and start <= out[-1][2]:
                    out[-1] = (out[-1][0], out[-1][1], end)
                else:
                    out.append((int(owner[c]), start, end))
        return out


def _located(passages: DataFrame, stretches: DataFrame, window: int, shard_stretches: int) -> DataFrame:
    """Every stretch past the automaton of its shard. A shard with many stretches is dealt to several tasks, each with a copy of the shard's
    passages; within a task the rows of a shard come passages first, and only one automaton is held."""
    sizes = stretches.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / shard_stretches).cast("int").alias("copies"))
    searched = stretches.join(sizes, "shard").select("shard", F.pmod(F.xxhash64("row", "at"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("kind"), "row", "doc", "at", "words")
    copied = passages.join(sizes, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), "row", "doc", "at", "words")
    dealt = copied.union(searched).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, automaton = None, PhraseAutomaton(window)
        for pdf in batches:
            out: list[tuple] = []
            shard, copy, kind, doc, at = (pdf[c].to_numpy() for c in ("shard", "copy", "kind", "doc", "at"))
            row, words = pdf["row"].tolist(), pdf["words"].tolist()
            size = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) // SEARCHED_BYTES
            changes = [np.diff(x) != 0 for x in (shard, copy, kind, size)]
            ends = [*(np.flatnonzero(np.logical_or.reduce(changes)) + 1).tolist(), len(words)] if len(words) else []
            for a, b in zip([0, *ends], ends, strict=False):
                if (shard[a], copy[a]) != current:
                    current, automaton = (shard[a], copy[a]), PhraseAutomaton(window)
                if kind[a] == 0:
                    for k in range(a, b):
                        automaton.add(int(doc[k]), int(at[k]), words[k])
                else:
                    out += [(row[a + k], start, end) for k, start, end in automaton.repeats(doc[a:b], at[a:b].astype(np.int64), words[a:b])]
            yield pd.DataFrame(out, columns=["row", "start", "end"])

    return dealt.mapInPandas(scan, "row binary, start int, end int")


def repeated_ranges(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, anchor: int = ANCHOR, shard_stretches: int = SHARD_STRETCHES
) -> DataFrame:
    """``row`` (md5 of id and text), ``ranges`` (word ranges, may touch) for each distinct row with a word to remove: a word covered by a
    window of ``window`` words whose word sequence also starts earlier, at a smaller id or earlier in the same text.

    Null ids sort first, and count as one id. Of the texts of one id, windows at smaller places are the earlier ones; equal rows
    are one. Texts of fewer words than a window, empty and null ones have no windows.

    Exact copies need no search: all windows of a later copy repeat. Of the other texts, the anchors (about two in fourteen words) are counted,
    windows around recurring anchors are confirmed by hash, and only stretches of text around those are searched.
    """
    spark = docs.sparkSession
    raw = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(text).alias("text")).filter(F.length("text") > 0)
    named = raw.select("doc", "text", row_key("doc", "text").alias("row"))
    copies = named.groupBy(F.unhex(F.md5("text")).alias("same")).agg(F.min("doc").alias("first"))
    # Rows of the first document with a text; equal rows collapse by their key. Their anchors, many a row, carry a number for the key.
    original, number = (F.col("doc") == F.col("first")).alias("original"), F.monotonically_increasing_id().alias("number")
    ids = kept(named.select("row", "doc", F.unhex(F.md5("text")).alias("same")).distinct().join(copies, "same").select("row", "doc", original, number), "rows")
    originals = ids.filter("original").select("row", "number")
    anchored = kept(_anchor_rows(named, window, anchor).join(originals, "row").select("number", "hash", "place"), "anchors")
    release(spark)
    spread = anchored.select("number", F.explode(F.arrays_zip("hash", "place")).alias("a")).select("number", "a.hash", "a.place")
    recurring = spread.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash")
    places = kept(spread.join(recurring, "hash").groupBy("number").agg(F.collect_set("place").alias("places")), "places")  # at most one for each word of the text
    discard(anchored)
    release(spark)
    held = kept(named.join(places.join(originals, "number"), "row").dropDuplicates(["row"]).select("row", "number", "doc", "text", "places"), "held")
    discard(places)
    release(spark)
    confirmed = _windows(held, window, anchor).groupBy("hash").agg(F.min(F.struct("doc", "start", "key")).alias("first"), F.count(F.lit(1)).alias("n"), F.max("anchor").alias("anchor"))
    firsts = kept(confirmed.filter("n > 1").select("first.key", "first.start", "anchor"), "firsts")
    release(spark)
    total = firsts.count()
    shards = max(1, -(-total // shard_stretches))
    passages = kept(_passages(held, firsts, shards, window), "passages")
    discard(firsts)
    release(spark)
    stretches = kept(_stretches(held, shards, window, anchor), "stretches")
    discard(held)  # texts and the shuffle that met them with their passages are gone before the search shuffles its own
    found = _located(passages, stretches, window, shard_stretches)
    ranges = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))
    whole = ids.filter("not original").select("row", F.array(F.struct(F.lit(0).alias("start"), F.lit(2**31 - 1).alias("end"))).alias("ranges"))
    out = kept(ranges.union(whole), "ranges")
    discard(passages, stretches, ids)
    release(spark)
    return out


def row_key(doc: str, text: str) -> F.Column:
    """Binary name of a row: the same for equal rows only. A null id counts as the smallest."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc).cast("long"), F.lit(-(2**63))).cast("string"), F.lit(":"), F.col(text))))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, **options: int) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space) for each row, repeated rows included.

    A null text has no words. Columns of ``docs`` of these names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept", "__ranges", "__row")]
    ranges = repeated_ranges(docs, doc_id, text, window, **options).select(F.col("row").alias("__row"), F.col("ranges").alias("__ranges"))
    joined = docs.select(*columns, row_key(doc_id, text).alias("__row")).join(ranges, "__row", "left").drop("__row")
    schema = docs.select(*columns).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            total, gone, left = [], [], []
            for t, found in zip(pdf[text], pdf.pop("__ranges"), strict=True):
                words = split_words(t)
                total.append(len(words))
                if found is not None and len(words) >= window:
                    spans = merged([(r["start"], min(r["end"], len(words))) for r in found])
                    at, stay = 0, []
                    for a, b in spans:
                        stay += words[at:a]
                        at = b
                    words = stay + words[at:]
                gone.append(total[-1] - len(words))
                left.append(b" ".join(words).decode())
            yield pdf.assign(n_words=total, n_removed=gone, kept=left)

    return joined.mapInPandas(scan, schema)
