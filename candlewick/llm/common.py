"""What the operators share: tables kept in the shared folder, column guards, word splitting, hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from candlewick.session import discard, release, shared_dir  # noqa: F401  (the operators take them from here)

#: ASCII to lower case, and every byte that is no digit, letter or part of a longer character to a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read from there: cuts lineage, and outlives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters (lower-cased), digits and any longer characters."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_FOLD = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words, from doubled runs. Empty if there are too few words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed, run, done, out = hashes, 1, 0, None
    power = _FOLD
    with np.errstate(over="ignore"):
        while True:
            if length & run:
                part = mixed[done : done + n]
                out = part.copy() if out is None else out * power + part
                done += run
            if done == length:
                break
            mixed = mixed[: len(mixed) - run] * power + mixed[run:]
            power = power * power
            run *= 2
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out
