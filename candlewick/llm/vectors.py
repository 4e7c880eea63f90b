"""Near-duplicate vectors by an inverted multi-index: two codebooks, a grid of cells, traversal in order of distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from candlewick.llm.common import kept, release
from candlewick.llm.components import connected

#: Vectors that the codebooks are fitted on at most; vectors of a cell aimed at; centroids of a codebook at most.
FIT_ROWS, CELL_ROWS, MOST_CENTROIDS = 20_000, 200, 1_024
#: Share of links to be found on pairs made at all cosines between the threshold and one; least share of the sample around a ball's centre.
RECALL, BALL_SHARE = 0.95, 0.002
#: Vectors of one block of a cell; sample vectors compared with the whole sample at a time, which bounds the driver's memory.
BLOCK, STRIP = 2_000, 256


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] + (centroids**2).sum(1) - 2 * points @ centroids.T, 0)


def codebook(points: np.ndarray, size: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds from random points."""
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), min(size, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(points, centroids).argmin(1)
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


@dataclass
class MultiIndex:
    """Codebooks for the first and second half of unit vectors, how far beyond the nearest cell to look, and dense balls."""

    first: np.ndarray
    second: np.ndarray
    reach: float
    balls: np.ndarray
    ball_cosine: float

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return _distances(units[:, :cut], self.first), _distances(units[:, cut:], self.second)

    def traverse(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells in order of distance, from a queue over the two sorted sequences, as far as ``reach`` beyond the nearest."""
        order1, order2 = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        limit = first[order1[0]] + second[order2[0]] + self.reach
        queue, seen, cells = [(first[order1[0]] + second[order2[0]], 0, 0)], {(0, 0)}, []
        while queue:
            distance, i, j = heappop(queue)
            if distance > limit:
                break
            cells.append(int(order1[i]) * len(self.second) + int(order2[j]))
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(order1) and b < len(order2) and (a, b) not in seen:
                    seen.add((a, b))
                    heappush(queue, (first[order1[a]] + second[order2[b]], a, b))
        return cells

    def place(self, units: np.ndarray) -> tuple[np.ndarray, list[list[int]], np.ndarray]:
        """Home cells; the later cells that each vector visits; its ball or -1."""
        d1, d2 = self.halves(units)
        home = d1.argmin(1) * len(self.second) + d2.argmin(1)
        visits = [[c for c in self.traverse(a, b) if c > h] for a, b, h in zip(d1, d2, home.tolist(), strict=True)]
        if not len(self.balls):
            return home, visits, np.full(len(units), -1)
        near = units @ self.balls.T
        best = near.argmax(1)
        return home, visits, np.where(near[np.arange(len(units)), best] >= self.ball_cosine, best, -1)


def fit_index(sample: np.ndarray, rows: int, threshold: float, recall: float = RECALL, seed: int = 5) -> MultiIndex:
    """Codebooks on a sample for about ``rows`` vectors, with the reach that finds ``recall`` of pairs.

    Pairs to calibrate on are sample vectors and copies turned from them, at cosines evenly between the threshold and
    one, and all linked pairs among 4,000 sample vectors and the sample; of the latter 0.999 have to be found. A pair is
    found if the vector of the lower cell visits the other's cell.

    Balls: all vectors within half the threshold's angle of one centre are linked, so dense regions need no pairs.
    """
    units = unit(sample)
    size = int(np.clip(round(np.sqrt(max(rows, 1) / CELL_ROWS)), 2, MOST_CENTROIDS))
    cut = max(units.shape[1] // 2, 1)
    index = MultiIndex(codebook(units[:, :cut], size, seed), codebook(units[:, cut:], size, seed + 1), 0.0, np.empty((0, units.shape[1])), 1.0)
    rng = np.random.default_rng(seed)
    base = units[rng.choice(len(units), min(4000, len(units)), replace=False)]
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(1, keepdims=True) * base
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
    cosine = rng.uniform(threshold, 1, len(base))[:, None]
    made = cosine * base + np.sqrt(1 - cosine**2) * turn
    places = [np.nonzero(base[at : at + STRIP] @ units.T >= threshold) for at in range(0, len(base), STRIP)]
    a = np.concatenate([p[0] + k * STRIP for k, p in enumerate(places)])
    b = np.concatenate([p[1] for p in places])
    parts = range(0, len(a), 4096)
    real = [_beyond(index, base[a[at : at + 4096]], units[b[at : at + 4096]]) for at in parts]  # not all pairs' vectors at once
    needed = [(_beyond(index, base, made), recall), (np.concatenate(real) if real else np.empty(0), 0.999)]
    index.reach = max(float(np.quantile(e, share, method="higher")) for e, share in needed if len(e)) + 1e-9
    index.ball_cosine = float(np.cos(np.arccos(threshold) / 2)) + 1e-6
    index.balls = _dense(units, index.ball_cosine)
    return index


def _beyond(index: MultiIndex, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How far beyond its nearest cell the lower vector of each pair has to look to visit the other's."""
    out = []
    for at in range(0, len(left), 4096):
        (l1, l2), (r1, r2) = index.halves(left[at : at + 4096]), index.halves(right[at : at + 4096])
        k, n2 = np.arange(len(l1)), len(index.second)
        a1, a2, b1, b2 = l1.argmin(1), l2.argmin(1), r1.argmin(1), r2.argmin(1)
        forward = l1[k, b1] + l2[k, b2] - l1.min(1) - l2.min(1)
        backward = r1[k, a1] + r2[k, a2] - r1.min(1) - r2.min(1)
        out.append(np.where(a1 * n2 + a2 <= b1 * n2 + b2, forward, backward))
    return np.concatenate(out) if out else np.empty(0)


def _dense(units: np.ndarray, cosine: float) -> np.ndarray:
    """Centres of balls with at least ``BALL_SHARE`` of the sample (and 10 vectors), greedily the fullest first."""
    least = max(10, int(BALL_SHARE * len(units)))
    count = np.concatenate([(units[at : at + STRIP] @ units.T >= cosine).sum(1) for at in range(0, len(units), STRIP)])
    free, centres = np.ones(len(units), bool), []
    for k in np.argsort(-count, kind="stable"):
        if count[k] < least:
            break
        if free[k]:
            inside = units @ units[k] >= cosine
            if (inside & free).sum() >= least:
                centres.append(units[k])
                free &= ~inside
    return np.array(centres).reshape(len(centres), units.shape[1])


def _fine(embedding: str) -> Column:
    """Whether a vector can link: neither null, empty, zero nor with null or non-finite components."""
    value = F.col(embedding)
    number = lambda x: x.cast("double")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(number(x)) | (F.abs(number(x)) == float("inf")))
    return F.coalesce(~bad & F.exists(value, lambda x: x != 0), F.lit(False))


def _keyed(usable: DataFrame) -> DataFrame:
    """Name of the vector (equal vectors share it) beside its bytes."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = [(np.asarray(v, np.float64) + 0.0).tobytes() for v in pdf["vector"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "key": [hashlib.md5(r).digest() for r in raw], "vector": [_packed(r) for r in raw]})

    return usable.select("vec_id", "vector").mapInPandas(scan, "vec_id long, key binary, vector binary")


def _packed(raw: bytes) -> bytes:
    """Doubles as they are, or at half the size where no digit is lost; told apart by the first byte."""
    wide = np.frombuffer(raw)
    with np.errstate(over="ignore"):
        narrow = wide.astype(np.float32)
    return b"4" + narrow.tobytes() if np.array_equal(narrow, wide) else b"8" + raw


def _unpacked(values: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(v[1:], np.float32 if v[:1] == b"4" else np.float64) for v in values]).astype(np.float64)


def _block_links(home: pd.DataFrame, visit: pd.DataFrame, inner: bool, threshold: float) -> pd.DataFrame:
    """Links of one block: for each vector the number of vectors linked (copies counted), and one edge to the least vector it hangs together with here."""
    rows = pd.concat([home, visit], ignore_index=True)
    units = unit(_unpacked(rows["vector"].tolist()))
    n, ids, weight, ball = len(home), rows["rep"].to_numpy(), rows["n"].to_numpy(), rows["ball"].to_numpy()
    near = units[:n] @ units.T >= threshold
    near[np.arange(n), np.arange(n)] = False
    if not inner:
        near[:, :n] = False
    near &= ~((ball[:n, None] == ball[None, :]) & (ball[:n, None] >= 0))
    count = np.zeros(len(rows), np.int64)
    count[:n] += near @ weight
    count[n:] += near[:, n:].T @ weight[:n]
    label = ids.copy()
    a, b = np.nonzero(near)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        if np.array_equal(before, label):
            break
    out = count > 0
    return pd.DataFrame({"rep": ids[out], "links": count[out], "least": label[out]})


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9, fit_rows: int = FIT_ROWS, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links`` (other vectors with cosine of at least ``threshold``), ``component_id`` (smallest
    ``vec_id`` reachable), ``kept`` (it is its own component's name).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different lengths: each
    length has an index of its own. Null ids are named null unless linked to others. Rows
    with equal vectors are one node that counts as many; repeated ids each count. Every link reported has been verified in
    double precision; ``recall`` is the share that the index aims at. An empty table gives no rows.

    The codebooks are fitted on at most ``fit_rows`` vectors, those whose ids hash lowest; every vector is indexed.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("vector")).withColumns({"length": F.size("vector"), "fine": _fine("vector")})
    usable = rows.filter("fine")
    alone = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    lengths = [r[0] for r in usable.select("length").distinct().collect()]  # as many as there are kinds of vectors
    found = [_linked(usable.filter(F.col("length") == n).select("vec_id", "vector"), threshold, fit_rows, recall) for n in sorted(lengths)]
    return reduce(DataFrame.union, found, alone)


def _linked(usable: DataFrame, threshold: float, fit_rows: int, recall: float) -> DataFrame:
    """The rows of ``near_vectors`` for vectors of one length."""
    spark = usable.sparkSession
    keyed = _keyed(usable)
    reps = keyed.groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    # Vectors are named by their md5; in joins and links by a number each, given once in a kept table.
    reps = kept(reps.select("key", F.monotonically_increasing_id().alias("rep"), "least", "n", "vector"), "vectors")
    release(spark)
    chosen = reps.orderBy(F.xxhash64("key"), "key").limit(fit_rows).select("vector").collect()
    index = fit_index(_unpacked([bytes(r.vector) for r in chosen]), reps.count(), threshold, recall)
    sums = _verified(reps, index, threshold)
    roots = connected(sums.select("rep", F.explode("edges").alias("least")), "rep", "least")
    named = reps.select("key", "rep", "least").join(sums.select("rep", "links"), "rep").join(roots, F.col("rep") == F.col("node"), "left")
    named = kept(named.select("key", "least", "links", F.coalesce("root", "rep").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = named.join(least, "root").select("key", "links", "component_id")
    release(spark)
    return keyed.select("vec_id", "key").join(by_key, "key").select("vec_id", F.col("links").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _coded(reps: DataFrame, index: MultiIndex) -> DataFrame:
    """``rep``, ``n``, ``ball``, home ``cell`` and ``block`` within cell and ball, visited cells."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            home, visits, ball = index.place(unit(_unpacked(pdf["vector"].tolist())))
            yield pd.DataFrame({"rep": pdf["rep"], "n": pdf["n"], "ball": ball.astype(np.int32), "cell": home.astype(np.int64), "visits": [np.array(v, np.int64) for v in visits]})

    return kept(reps.select("rep", "n", "vector").mapInPandas(scan, "rep long, n long, ball int, cell long, visits array<long>"), "codes")


def _verified(reps: DataFrame, index: MultiIndex, threshold: float) -> DataFrame:
    """``rep``, ``links`` and ``edges`` (enough of them to connect what hangs together).

    A unit is a block of bounded size of the members that a cell has in one ball, or in none. Members of a unit meet each other
    and the unit's visitors: vectors of other cells whose traversal comes here, and members of the cell's later units.
    Vectors inside one ball are linked without meeting. Many visitors are dealt to groups, each with a copy of the unit.
    """
    codes = _coded(reps, index)
    sizes = codes.groupBy("cell", "ball").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = codes.join(sizes, ["cell", "ball"]).select("rep", "n", "ball", "cell", F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int").alias("block"))
    members = kept(members, "members")
    units = sizes.select("cell", F.col("ball").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))
    apart = (F.col("ball") != F.col("of")) | (F.col("ball") < 0)
    later = F.struct("of", "part") < F.struct("ball", "block")
    inner = members.join(units, "cell").filter(apart & later).select("rep", "cell", "of", "part")
    outer = codes.select("rep", "ball", F.explode("visits").alias("cell")).join(units, "cell").filter(apart).select("rep", "cell", "of", "part")
    visits = kept(inner.union(outer), "visits")
    crowds = visits.groupBy("cell", "of", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("groups"))
    at = ["cell", "of", "part"]
    home = members.select("rep", "cell", F.col("ball").alias("of"), F.col("block").alias("part")).join(crowds, at, "left")
    home = home.select(*at, F.explode(F.sequence(F.lit(0), F.coalesce("groups", F.lit(1)) - 1)).alias("group"), F.lit(True).alias("home"), "rep")
    guests = visits.join(crowds, at).select(*at, F.pmod(F.xxhash64("rep", F.lit(1)), F.col("groups").cast("long")).cast("int").alias("group"), F.lit(False).alias("home"), "rep")
    data = reps.select("rep", "n", "vector").join(codes.select("rep", "ball"), "rep")
    meetings = home.union(guests).join(data, "rep")

    def search(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _block_links(pdf[pdf["home"]], pdf[~pdf["home"]], keys[3] == 0, threshold)

    found = meetings.groupBy(*at, "group").applyInPandas(search, "rep long, links long, least long")
    single = found.groupBy("rep").agg(F.sum("links").alias("links"), F.collect_set("least").alias("edges"))
    inside = codes.filter("ball >= 0").groupBy("ball").agg(F.sum("n").alias("mass"), F.min("rep").alias("centre"))  # a row for each ball
    counted = codes.select("rep", "n", "ball").join(single, "rep", "left").join(inside, "ball", "left")
    none = F.array().cast("array<long>")
    links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("mass") - F.col("n"), F.lit(0)) + F.col("n") - 1
    edges = F.array_distinct(F.concat(F.coalesce("edges", none), F.when(F.col("centre").isNotNull(), F.array("centre")).otherwise(none)))
    return kept(counted.select("rep", links.alias("links"), edges.alias("edges")), "verified")
