"""Exact copies by block naming against grouping of the whole texts."""

import hashlib
import random
from collections import defaultdict

import pytest

from candlewick.llm import identity

DOCS = "doc_id long, text string"
UPPER = {c: c + 32 for c in range(65, 91)}


def groups(rows):
    """``(doc_id, keep_id, group_size, sha256)`` of each row, and how many rows of each group stay."""
    same = defaultdict(list)
    for i, t in rows:
        same[(t or "").translate(UPPER)].append(i)
    out = []
    for text, ids in same.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, best, len(ids), digest) for i in ids]
    return sorted(out, key=str), len(same)


@pytest.mark.parametrize(("block", "common"), [(4, 5), (7, 10_000), (2_048, 1)])
def test_groups_equal_plain_grouping(spark, block, common):
    rng = random.Random(block)
    base = ["".join(rng.choice("abAB \nÄäß漢") for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    rows = [(k, rng.choice(base)) for k in range(400)]
    rows += [(k, t.swapcase()) for k, t in enumerate(base, 1000)]
    rows += [(None, None), (None, ""), (5, ""), (5, base[3]), (5, base[3]), (None, base[4]), (None, "only nulls"), (None, "Only Nulls")]
    rows += [(2000, "x" * 5_000), (2001, "X" * 5_000), (2002, "x" * 4_999 + "y"), (2003, "y" + "x" * 4_999)]
    found = identity.exact_groups(spark.createDataFrame(rows, DOCS), block=block if block > 4 else 64, common=common).collect()
    expected, n = groups(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected
    assert sum(r.kept for r in found) == n
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_texts_that_share_all_but_one_block_differ(spark):
    rows = [(k, "aaaa" * k) for k in range(1, 30)] + [(100 + k, "aaaa" * k + "aaab" + "aaaa" * (28 - k)) for k in range(29)]
    found = identity.exact_groups(spark.createDataFrame(rows, DOCS), block=4, common=3).collect()
    assert {r.group_size for r in found} == {1}


def test_empty_table_and_other_columns(spark):
    assert identity.exact_groups(spark.createDataFrame([], DOCS)).count() == 0
    clash = spark.createDataFrame([(1, "A", 7, "x"), (2, "a", 8, "y")], "doc_id long, text string, row long, name string")
    assert [(r.keep_id, r.kept) for r in identity.exact_groups(clash).orderBy("doc_id").collect()] == [(2, False), (2, True)]


def test_main_path_runs_without_python_workers(spark, sf_dir, capsys):
    identity.exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow"))


def test_megabyte_texts(spark):
    long = "Word and ünd " * 200_000
    rows = [(1, long), (2, long.upper().replace("Ü", "ü")), (3, long[:-1]), (4, "z" + long[1:])]
    found = identity.exact_groups(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()
    assert [r.keep_id for r in found] == [2, 2, 3, 4]
