"""Token alignment against interval comparisons over the tokens that the libraries give for whole texts."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from candlewick.llm import alignment
from candlewick.llm.bpe import byte_letters
from candlewick.llm.catalogue import PIECES, QUERIES, TOKENIZER

DOCS = "doc_id long, text string"
ODD = ["", None, "one", " ", "\n", " \n\t x", "a▁b", "<unk> <s> <|endoftext|>", "ﬁ ｆull", "Ünï 漢字かな mixed 🙂🙂", "don't\r\n stop here  twice   ", "\x1cctl\x1fx", "a\tb\u0085c"]


def plain(rows):
    first, second = Tokenizer.from_file(TOKENIZER), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(byte_letters())}
    docs, counts = [], Counter()
    for doc_id, text in rows:
        links, written, a, b = [], "", [], []
        if text:
            whole = (" " + text).encode()
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
                a, b = [], []
            spans = []
            for ids, parts in ((a, a_bytes), (b, b_bytes)):
                at, own = 0, []
                for i, part in zip(ids, parts):
                    own.append((at, at + len(part), i))
                    at += len(part)
                spans.append(own)
            ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
            low, groups = 0, []
            for end in ends:
                groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= end) for side in spans))
                low = end
            written = ";".join(groups)
            j = 0
            for s, e, i in spans[0]:
                while j and spans[1][j][0] > s:
                    j -= 1
                while j < len(b) and spans[1][j][0] < e:
                    if spans[1][j][1] > s:
                        links.append((i, spans[1][j][2]))
                    j += 1
                j = max(j - 1, 0)
        counts.update(links)
        docs.append((doc_id, len(a), len(b), written.count(";") + bool(written), links, written))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, written in docs:
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((doc_id, n_a, n_b, n_groups, len(links), best, sum(counts[x] for x in links), hashlib.sha256(written.encode()).hexdigest() if written else ""))
    return sorted(out, key=str), {(x, y, n, n == most[y]) for (x, y), n in counts.items()}


def made(seed, n):
    rng = random.Random(seed)
    words = ["the", "Übung", "token", "naïve", "x1", "co-op", "don't", "…", "漢字", "\n", "\n\n", " ", "\t", "3.14", "Wörter", "🙂", " ", "á"]
    return [(k, "".join(rng.choice(words) + rng.choice([" ", " ", "", "  ", "\n"]) for _ in range(rng.randrange(0, 60)))) for k in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("chunk", "broadcast"), [(alignment.CHUNK, alignment.BROADCAST), (50, 3)])
def test_equal_to_interval_comparison(spark, monkeypatch, chunk, broadcast):
    rows = made(1, 120) + [(1000 + k, t) for k, t in enumerate(ODD)] + [(7, "one"), (7, "one"), (None, "null id text"), (None, None)]
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    docs, links = alignment.aligned(spark.createDataFrame(rows, DOCS).coalesce(2), TOKENIZER, PIECES, broadcast=broadcast)
    expected, counts = plain(rows)
    assert rows_of(docs) == expected
    assert {tuple(r) for r in links.collect()} == counts


def test_parts_of_a_long_text_give_the_same():
    both = alignment.Pair(TOKENIZER, PIECES)
    text = " " + "Some words, ünd mehr\nlines  of it " * 500
    pieces = list(alignment._parts(text, both.cut))
    assert pieces == [text]
    whole, cut = alignment.Document(), alignment.Document()
    docs = {0: whole, 1: cut}
    alignment._add(both, [(0, text)], docs)
    at = [0, *[m.start() for m in both.cut.finditer(text)][5::17], len(text)]
    for a, b in zip(at[:-1], at[1:]):
        alignment._add(both, [(1, text[a:b])], docs)
    one, other = whole.result(), cut.result()
    assert one[0].tolist() == other[0].tolist() and one[1] == other[1]


def test_the_query_equals_plain_python(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op11_alignment"].build(spark, sf_dir)) == plain(rows)[0]


def test_megabyte_text_empty_table_and_other_columns(spark):
    assert alignment.aligned(spark.createDataFrame([], DOCS), TOKENIZER, PIECES)[0].count() == 0
    table = spark.createDataFrame([(1, "word " * 700_000, 5), (2, "x" * 20_000, 6), (3, "word", 7)], "doc_id long, text string, pairs long")
    found = {r.doc_id: r for r in alignment.aligned(table, TOKENIZER, PIECES)[0].collect()}
    assert found[1].n_a >= 700_000 and found[1].n_links >= found[1].n_groups > 0
    assert found[2].n_a > 0 and found[3].n_groups == 1
