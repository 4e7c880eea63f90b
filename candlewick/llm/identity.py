"""Exact copies: every text gets one integer name that no other text has, from names of its blocks and of pairs of names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.llm.common import kept

#: Bytes of a block; rows of a naming bucket aimed at; rows that a key has at least to count as common (and over a thousandth of all rows).
BLOCK, BUCKET, COMMON = 2_048, 1_000, 200
_NONE = -(1 << 63)  # stands for the missing neighbour of the last of an odd number of names


def lowered(text: str) -> Column:
    """The text with A-Z in lower case and nothing else changed; null counts as empty. Plain ASCII takes the faster function."""
    value = F.coalesce(F.col(text), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(value) == F.length(value), F.lower(value)).otherwise(F.translate(value, upper, upper.lower()))


def _common_keys(rows: DataFrame, key: list[str], common: int) -> tuple[int, list[int]]:
    """Number of rows, and the hashes that over a thousandth of them (and over ``common``) share: fewer than a thousand hashes."""
    counts = rows.groupBy(F.xxhash64(*key).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "hash").limit(1_000)
    both = top.union(counts.agg(F.lit(None).cast("long").alias("hash"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))).collect()
    total = next(r["n"] for r in both if r["hash"] is None)
    return total, [r["hash"] for r in both if r["hash"] is not None and r["n"] > common and r["n"] * 1_000 > total]


def _named(rows: DataFrame, key: list[str], spread: list[str], common: int) -> DataFrame:
    """``rows`` with an integer ``name`` in place of the key columns: equal keys have equal names, different keys different ones.

    Keys are dealt to buckets by hash and sorted there; a name is the place among the bucket's distinct keys, times the number of buckets, plus
    the bucket. Keys are compared themselves, so equal hashes don't mix names. The few common keys, which may fill a third of all rows,
    are sorted apart and get negative names; their rows are dealt out by ``spread`` without the key.
    """
    total, hashes = _common_keys(rows, key, common)
    buckets = max(1, -(-total // BUCKET))
    hashed = F.xxhash64(*key)
    others = [c for c in rows.columns if c not in key]
    if hashes:
        apart = rows.filter(hashed.isin(hashes)).select(*key).distinct()
        known = apart.select(*key, (-F.row_number().over(Window.orderBy(*key))).cast("long").alias("known"))
        rows = rows.join(F.broadcast(known), key, "left")  # under a thousand keys of a block at most
    else:
        rows = rows.withColumn("known", F.lit(None).cast("long"))
    free = F.col("known").isNull()
    bucket = F.pmod(F.when(free, hashed).otherwise(F.xxhash64(*spread)), F.lit(buckets)).alias("bucket")
    dealt = rows.select(*others, *[F.when(free, F.col(c)).alias(c) for c in key], "known", bucket)
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*key)).cast("long")
    return dealt.select(*others, F.coalesce("known", place * F.lit(buckets) + F.col("bucket")).alias("name"))


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, common: int = COMMON) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a number of its own), ``doc_id``, ``sha256`` (of the lower-cased text, hex), ``size`` (its bytes) and ``name``.

    Two rows have the same ``size`` and ``name`` if and only if their texts are equal but for the case of A-Z. Texts are cut into blocks of ``block`` bytes,
    which are sorted into integer names; then adjacent names are paired and the pairs sorted into names, until a text has one name. Texts
    of one size go through the same turns, so no hash decides anything. Null texts count as empty; an empty text is one empty block. Null and repeated
    ids are carried along; other columns are left out. A text of any length works: it is dealt out as blocks, and the turns grow with the
    logarithm of the longest text. An empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), lowered(text).alias("text"))
    size = F.octet_length("text").cast("long")
    sized = rows.select("row", "doc_id", "text", size.alias("size"), F.greatest(F.ceil(size / block), F.lit(1)).cast("int").alias("n"))
    raw = F.col("text").cast("binary")
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(raw, i * block + 1, F.lit(block)))
    pieces = sized.select("row", "doc_id", "text", "size", "n", F.posexplode(cut).alias("pos", "block"))
    first = F.col("pos") == 0  # the text's own columns travel with its first block only
    head = F.when(first, F.struct("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha256"), "size")).alias("head")
    level = kept(_named(pieces.select("row", "n", "pos", head, "block"), ["block"], ["row", "pos"], common), "names")
    heads = level.filter(first).select("row", "head.doc_id", F.lower(F.hex("head.sha256")).alias("sha256"), "head.size", "n", "name")
    done, longer = [], level.filter("n > 1")
    while not longer.isEmpty():
        odd = F.col("pos").bitwiseAND(F.lit(1)) == 1
        pairs = longer.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
            F.shiftright(F.first("n") + 1, 1).alias("n"),
            F.max(F.when(~odd, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(_NONE)).alias("right"),
        )
        level = kept(_named(pairs, ["left", "right"], ["row", "pos"], common), "names")
        done.append(level.filter("n = 1").select("row", F.col("name").alias("last")))
        longer = level.filter("n > 1")
    short = heads.filter("n = 1").select("row", "doc_id", "sha256", "size", "name")
    if not done:
        return short
    ended = reduce(DataFrame.union, done)
    return short.union(heads.filter("n > 1").join(ended, "row").select("row", "doc_id", "sha256", "size", F.col("last").alias("name")))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, common: int = COMMON) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (id of the row of its group that stays), ``group_size``, ``kept`` and ``text_sha256``.

    A group holds the rows whose texts are equal but for the case of A-Z (see ``identities``). The row with the largest id stays, exactly one of a group: of
    repeated ids any one of them, of a group without ids any row, with a null ``keep_id``. An empty table gives no rows.
    """
    named = kept(identities(docs, doc_id, text, block, common), "identities")
    best = F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("best")
    groups = named.groupBy("size", "name").agg(F.max("doc_id").alias("keep_id"), best, F.count(F.lit(1)).alias("group_size"))
    groups = kept(groups.filter("group_size > 1"), "groups")  # a table of its own, so that the join can split a large group
    alone = F.col("best").isNull()
    return named.join(groups, ["size", "name"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )
