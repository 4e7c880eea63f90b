"""Mergeable states of a stream as a folder of pieces: one per micro-batch, merged in the background into ever larger runs.

``merge`` has to be associative and commutative, so pieces may be read together in any number and order. A manifest, numbered
and never changed, lists the runs and says up to which batch they hold everything; readers take its runs and the batches beyond. A batch that is
written again after a failure replaces its own piece, or is not looked at any more if a run holds it already. Pieces that a
manifest no longer lists are deleted with the next one, so a reader of the manifest before still finds them.

One stream writes a store at a time; any number of sessions may read it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.functions.numeric import all_of
from candlewick.functions.timefn import bucket_start, month_key
from candlewick.operators.candles import CANDLE, merge_partials, month_number, partials, quote_partials
from candlewick.sinks.layers import clustered

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Manifest:
    """``runs``: name to level; ``through``: the last batch they hold; ``dropped``: pieces to delete with the next manifest."""

    version: int = 0
    through: int = -1
    runs: dict[str, int] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()


class PieceStore:
    """States in pieces below ``path``. ``part`` names and computes the partition column within a piece; ``sort`` orders its rows."""

    def __init__(self, spark: SparkSession, path: str, merge: Merge, part: tuple[str, Column], sort: Sequence[str], fan: int = 8) -> None:
        if fan < 2:
            raise ValueError("runs of a level are merged two at a time at least")
        self.spark, self.path, self.merge, self.part, self.sort, self.fan = spark, path.rstrip("/"), merge, part, tuple(sort), fan

    # --- folders ---------------------------------------------------------------------------------------

    def _file(self, name: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), at

    def _names(self, folder: str) -> list[str]:
        fs, at = self._file(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _delete(self, name: str) -> None:
        fs, at = self._file(name)
        fs.delete(at, True)

    def manifest(self) -> Manifest:
        names = [n for n in self._names("manifests") if n.endswith(".json")]
        if not names:
            return Manifest()
        text = self.spark.read.text(f"{self.path}/manifests/{names[-1]}", wholetext=True).first()[0]
        found = json.loads(text)
        return Manifest(found["version"], found["through"], found["runs"], tuple(found["dropped"]))

    def _commit(self, new: Manifest) -> None:
        """Write the manifest under another name, then give it its own: nobody sees half of it."""
        body = json.dumps({"version": new.version, "through": new.through, "runs": new.runs, "dropped": new.dropped})
        fs, draft = self._file(f"manifests/draft-{new.version:012d}")
        out = fs.create(draft, True)
        out.write(body.encode())
        out.close()
        if not fs.rename(draft, self._file(f"manifests/{new.version:012d}.json")[1]):
            raise RuntimeError(f"manifest {new.version} exists already: another stream writes this store")

    def batches(self) -> list[int]:
        """Batches whose piece is complete."""
        found = []
        for name in self._names("pieces"):
            kind, _, number = name.removeprefix("piece=").partition("-")
            fs, done = self._file(f"pieces/{name}/_SUCCESS")
            if kind == "b" and fs.exists(done):
                found.append(int(number))
        return found

    # --- pieces ----------------------------------------------------------------------------------------

    def _write(self, states: DataFrame, piece: str) -> None:
        name, value = self.part
        out = clustered(states.withColumn(name, value), [name]).sortWithinPartitions(name, *self.sort)
        out.write.mode("overwrite").partitionBy(name).parquet(f"{self.path}/pieces/piece={piece}")

    def _read(self, pieces: Sequence[str]) -> DataFrame:
        base = f"{self.path}/pieces"
        return self.spark.read.option("basePath", base).parquet(*[f"{base}/piece={p}" for p in pieces]).drop("piece")

    def live(self) -> list[str]:
        """The pieces that hold everything, each row once. A batch without rows has an empty piece, which is left out."""
        now, (part, _) = self.manifest(), self.part
        pieces = [*now.runs, *(f"b-{b:012d}" for b in self.batches() if b > now.through)]
        return [p for p in pieces if any(n.startswith(f"{part}=") for n in self._names(f"pieces/piece={p}"))]

    def states(self, where: Column | None = None) -> DataFrame:
        """All states, merged. ``where`` is applied to the stored rows, so a condition on the partition column prunes folders."""
        pieces = self.live()
        if not pieces:
            raise ValueError(f"nothing is stored yet in {self.path}")
        stored = self._read(pieces)
        chosen = stored if where is None else stored.filter(where)
        return self.merge(chosen.drop(self.part[0]))

    def sink(self, build: Merge) -> Callable[[DataFrame, int], None]:
        """Write the states that ``build`` makes of each micro-batch, then merge what has gathered before it."""

        def each(batch: DataFrame, batch_id: int) -> None:
            if batch_id > self.manifest().through:
                self._write(build(batch), f"b-{batch_id:012d}")
            self.compact(batch_id)

        return each

    def compact(self, before: int) -> None:
        """Merge batches older than ``before``, which no failure repeats any more, as soon as ``fan`` of them wait; then ``fan`` runs of a level into one
        of the next. A state so is written once per level; a store has at most ``2 fan`` pieces of batches and of each level."""
        now = self.manifest()
        waiting = [b for b in self.batches() if now.through < b < before]
        if len(waiting) < self.fan:
            return
        runs, version, through, gone = dict(now.runs), now.version + 1, waiting[-1], [f"b-{b:012d}" for b in waiting]
        merged, level = list(gone), 1
        while len(same := [r for r, at in runs.items() if at == level]) >= self.fan - 1:
            merged += same
            gone += same
            runs = {r: at for r, at in runs.items() if r not in same}
            level += 1
        run = f"r-{version:012d}"
        full = [p for p in merged if len(self._names(f"pieces/piece={p}")) > 1]  # an empty piece holds its mark of completion only
        if full:
            self._write(self.merge(self._read(full).drop(self.part[0])), run)
            runs[run] = level
        self._commit(Manifest(version, through, runs, tuple(gone)))
        for piece in now.dropped:
            self._delete(f"pieces/piece={piece}")
        self._delete(f"manifests/{version - 2:012d}.json")


# --- candles ----------------------------------------------------------------------------------------------


class CandleStore(PieceStore):
    """Candle states by month. Late ticks add states; reading merges them, however late."""

    def __init__(self, spark: SparkSession, path: str, width: str = "minute", seq: str | None = "seq", quotes: bool = False, fan: int = 8) -> None:
        super().__init__(spark, path, merge_partials, ("ym", month_key(F.col("time_bucket"))), ["symbol", "time_bucket"], fan)
        self.width, self._build = width, quote_partials if quotes else partials
        self._seq = seq

    def candle_sink(self) -> Callable[[DataFrame, int], None]:
        return self.sink(lambda batch: self._build(batch, self.width, self._seq))

    def candles(self, start: str | None = None, end: str | None = None, symbol: str | None = None) -> DataFrame:
        """Stored candles, or those of a symbol and of the buckets from that of ``start`` to that of ``end``. Only folders of those months are read."""
        bucket, tests = F.col("time_bucket"), []
        if start is not None:
            tests += [F.col("ym") >= month_number(start), bucket >= bucket_start(F.lit(start).cast("timestamp"), self.width)]
        if end is not None:
            tests += [F.col("ym") <= month_number(end), bucket <= bucket_start(F.lit(end).cast("timestamp"), self.width)]
        if symbol is not None:
            tests.append(F.col("symbol") == symbol)
        where = all_of(tests) if tests else None
        return self.states(where).select(*CANDLE)


# --- current state ------------------------------------------------------------------------------------------


class StateStore(PieceStore):
    """The last change of each key, whatever the order in which changes arrive. Deletes stay as tombstones, so that an older change can't bring a
    row back; they take the room of a key each."""

    def __init__(self, spark: SparkSession, path: str, key: str, at: Sequence[str], slots: int = 16, fan: int = 8) -> None:
        slot = F.pmod(F.xxhash64("_key"), F.lit(slots)).cast("int")
        super().__init__(spark, path, _newest, ("slot", slot), ["_key"], fan)
        self.key, self.at = key, tuple(at)

    def change_sink(self) -> Callable[[DataFrame, int], None]:
        return self.sink(lambda batch: _newest(changes(batch, self.key, self.at)))

    def current(self) -> DataFrame:
        """The rows that are there now."""
        alive = self.states().filter((F.col("op") != "d") & F.col("after").isNotNull())
        return alive.select("after.*")


def changes(envelopes: DataFrame, key: str, at: Sequence[str]) -> DataFrame:
    """``_key``, ``_at`` (what orders changes, column by column), ``op``, ``after``; deletes carry their key in the before image. Changes
    without a key have no place and are left out."""
    keyed = F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")).alias("_key")
    return envelopes.select(keyed, F.struct(*at).alias("_at"), "op", "after").filter("_key is not null")


def _newest(states: DataFrame) -> DataFrame:
    last = F.max(F.struct("_at", "op", "after")).alias("_last")  # of changes at one moment the larger, the same in any order
    return states.groupBy("_key").agg(last).select("_key", "_last._at", "_last.op", "_last.after")
