"""Any number of literal words looked up in many texts at once, on their bytes.

A word is filed under the eight bytes of it that are rarest, or under all of its bytes if there are fewer. A table of hashes rules out most places of
a text, and the remaining bytes of the word decide. The work per byte of text does not depend on the number of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of a window, places looked at together, and windows of a word among which the rarest is chosen.
WIDE, BLOCK, CHOICE = 8, 1 << 17, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, with zeros behind them, and where each text begins and the last one ends. NULL is an empty text."""
    plain = texts.cast(pa.large_binary()).fill_null(b"")
    places = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    size = int(places[-1] - places[0]) if len(plain) else 0
    data = np.zeros(size + WIDE, np.uint8)
    if size:
        data[:size] = np.frombuffer(plain.buffers()[2], np.uint8)[places[0] : places[-1]]
    return data, places - places[0] if len(plain) else np.zeros(1, np.int64)


def windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number; a view."""
    return np.ndarray((len(data) - WIDE + 1,), "<u8", data, strides=(1,))


def ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the range that each is of."""
    of = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[of], of


def distinct(numbers: np.ndarray) -> np.ndarray:
    """In order, each once; ``np.unique`` hashes, which takes several times as long."""
    numbers.sort()
    return numbers[np.diff(numbers, prepend=-1) != 0]


@dataclass
class Class:
    """Words of one length, or all of eight bytes and more: distinct grams, and the words and their gram's place in them, by gram."""

    mask: np.uint64
    grams: np.ndarray
    first: np.ndarray
    words: np.ndarray
    places: np.ndarray


class WordIndex:
    """Words are numbered as in the list given; they are distinct and not empty. ``sample`` are texts in which windows are counted to tell rare ones."""

    def __init__(self, words: pa.Array, sample: pa.Array | None = None):
        self.data, self.starts = buffers(words)
        self.lengths = np.diff(self.starts)
        self.classes = []
        at = windows(self.data)
        for n in range(1, WIDE):
            of = np.flatnonzero(self.lengths == n)
            if len(of):
                mask = np.uint64((1 << 8 * n) - 1)
                self.classes.append(self._filed(mask, at[self.starts[of]] & mask, of, np.zeros(len(of), np.int64)))
        of = np.flatnonzero(self.lengths >= WIDE)
        if len(of):
            counts = np.minimum(self.lengths[of] - WIDE + 1, CHOICE)
            places, word = ranges(np.zeros(len(of), np.int64), counts)
            grams = at[self.starts[of][word] + places]
            every, which, shared = np.unique(grams, return_inverse=True, return_counts=True)
            seen = np.zeros(len(every), np.int64)
            if sample is not None and len(sample):
                found = windows(buffers(sample)[0])
                i = np.minimum(np.searchsorted(every, found), len(every) - 1)
                seen = np.bincount(i[every[i] == found], minlength=len(every))
            order = np.lexsort((places, shared[which], seen[which], word))
            best = order[np.cumsum(counts) - counts]
            self.classes.append(self._filed(np.uint64(2**64 - 1), grams[best], of, places[best]))

    @staticmethod
    def _filed(mask: np.uint64, grams: np.ndarray, words: np.ndarray, places: np.ndarray) -> Class:
        order = np.argsort(grams, kind="stable")
        every, first = np.unique(grams[order], return_index=True)
        return Class(mask, every, np.append(first, len(order)), words[order], places[order])

    def tables(self) -> list[tuple[np.uint64, np.ndarray, np.ndarray]]:
        """For each class: which hashes its grams have, at least eight places for each, and a gram of each hash."""
        out = []
        for c in self.classes:
            bits = min(23, max(12, int(len(c.grams) * 8).bit_length()))
            shift = np.uint64(64 - bits)
            taken, one = np.zeros(1 << bits, bool), np.zeros(1 << bits, np.int32)
            hashes = (c.grams * _MIX) >> shift
            taken[hashes], one[hashes] = True, np.arange(len(c.grams))
            out.append((shift, taken, one))
        return out

    def find(self, texts: pa.Array, tables: list, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of text and word found in it, by text. With ``inside``, which tells of each byte whether it belongs to a
        letter, digit or ``_``, only words without such bytes before and behind them."""
        data, starts = buffers(texts)
        at, mine, n_words = windows(data), windows(self.data), max(1, len(self.lengths))
        pairs = [np.empty(0, np.int64)]
        for low in range(0, int(starts[-1]), BLOCK):
            here = at[low : min(low + BLOCK, int(starts[-1]))].copy()
            for c, (shift, taken, one) in zip(self.classes, tables, strict=True):
                keys = here & c.mask
                hashes = (keys * _MIX) >> shift
                some = np.flatnonzero(taken[hashes])
                keys, i = keys[some], one[hashes[some]]
                hit = c.grams[i] == keys
                other = np.flatnonzero(~hit)
                i[other] = np.minimum(np.searchsorted(c.grams, keys[other]), len(c.grams) - 1)
                hit[other] = c.grams[i[other]] == keys[other]
                some, i = some[hit], i[hit]
                entry, of = ranges(c.first[i], c.first[i + 1] - c.first[i])
                word, begin = c.words[entry], some[of] + low - c.places[entry]
                text = np.searchsorted(starts, some[of] + low, "right") - 1
                size = self.lengths[word]
                keep = (begin >= starts[text]) & (begin + size <= starts[text + 1])
                word, begin, text, size = word[keep], begin[keep], text[keep], size[keep]
                left, k = np.flatnonzero(size >= WIDE), 0
                good = np.ones(len(word), bool)
                while len(left):  # eight bytes of each word at a time, the last eight at its end
                    o = np.minimum(WIDE * k, size[left] - WIDE)
                    same = at[begin[left] + o] == mine[self.starts[word[left]] + o]
                    good[left[~same]] = False
                    k += 1
                    left = left[same & (size[left] > WIDE * k)]
                if inside is not None:
                    end = begin + size
                    good &= ((begin == starts[text]) | ~inside[np.maximum(begin - 1, 0)]) & ((end == starts[text + 1]) | ~inside[np.minimum(end, len(inside) - 1)])
                pairs.append(distinct(text[good] * n_words + word[good]))
        return np.divmod(distinct(np.concatenate(pairs)), n_words)


def inside_words(texts: pa.Array, masks: pa.Array) -> np.ndarray:
    """Of each byte of the texts, whether its character is one of a word, from texts of as many characters that hold ``w`` for these."""
    data, starts = buffers(texts)
    flags, _ = buffers(masks)
    begins = (data[: starts[-1]] & 0xC0) != 0x80
    out = np.zeros(len(data), bool)
    out[: starts[-1]] = (flags == ord("w"))[np.minimum(np.cumsum(begins) - 1, len(flags) - 1)]
    return out


def loose_ends(texts: pa.Array, inside: np.ndarray) -> np.ndarray:
    """Of each text, whether it has a place with no character of a word on either side: what an empty word finds."""
    data, starts = buffers(texts)
    split = (data & 0xC0) == 0x80  # inside a character
    before = np.concatenate([[False], inside[: starts[-1]]])
    after = np.concatenate([inside[: starts[-1]], [False]])
    out = np.empty(len(starts) - 1, bool)
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        left, right = before[a : b + 1].copy(), after[a : b + 1].copy()
        left[0] = right[-1] = False  # ends of the text
        out[i] = bool((~left & ~right & ~split[a : b + 1]).any()) if a < b else True
    return out
