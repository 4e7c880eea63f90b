"""Each operator against plain Python that does the same the long way, on small tables with every odd case."""

import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from candlewick.llm import bpe, copies, decontaminate, html, pii, quality, secrets, simhash, substrings, tokens, vectors
from candlewick.llm.catalogue import QUERIES, TOKENIZER
from candlewick.llm.components import connected
from tests.oracle import connect, differences

DOCS = "doc_id long, text string"
ODD = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "Ünïcode　wide space"), (None, "one two three")]


def prose(seed, words=120, size=40):
    rng = random.Random(seed)
    return " ".join(rng.choice([f"w{k}" for k in range(size)]) for _ in range(words))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), QUERIES[name], sf_dir) == []


def test_every_operator_takes_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert decontaminate.find_passages(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert substrings.without_repeats(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    assert secrets.find_secrets(docs).count() == 0
    assert pii.with_surrogates(docs, b"k").count() == 0
    assert bpe.encode(docs, TOKENIZER).count() == 0
    assert tokens.token_counts(docs, TOKENIZER).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    machine = quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.scored(docs, machine).count() == 0
    assert html.extracted(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 140)] + [(7, None), (500, 500)]
    root = {x: x for link in links for x in link if x is not None and None not in link and link[0] != link[1]}
    for _ in root:
        for a, b in links:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    got = connected(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert dict(rows(got)) == root


# --- 1: surrogates -----------------------------------------------------------------------------------------


def test_surrogates_are_consistent_and_distinct(spark):
    text = "Mail Bob.42@mail8.example.com or bob.42@MAIL8.example.com, call +1 (456) 555-2186 or 456-555-2186, Mrs Anna Berg, 10.2.3.44, 4041894974608795"
    docs = spark.createDataFrame([(1, text, "x"), (2, "Mr. Berg wrote to bob.42@mail8.example.com", "y"), (3, None, "z"), (3, "", "z"), (3, "", "z")], DOCS + ", n_entities string")
    got = {(r.doc_id, r.n_entities): r.text for r in pii.with_surrogates(docs, b"k").collect()}
    out = got[1, 7]
    mails = re.findall(r"\S+@\S+?(?=[, ]|$)", out)
    assert mails[0] == mails[1] and "bob" not in out.lower()
    assert got[2, 2].endswith(mails[0])
    phones = [re.sub(r"\D", "", p)[-10:] for p in re.findall(r"call (.*?) or (.*?),", out)[0]]
    assert phones[0] == phones[1] != "4565552186"
    card = re.search(r"\d{16}", out)[0]
    assert pii._luhn(card) == 0 and card[0] == "4"
    assert "Anna" not in out and re.search(r"Mrs [A-Z]\w+a [A-Z]\w+,", out)
    assert (got[3, 0] in (None, "")) and pii.with_surrogates(docs, b"k").count() == 5


def test_surrogate_collisions_are_drawn_again(spark):
    found = spark.createDataFrame([("ip", f"{a}.{b}.1.1") for a in range(10) for b in range(10)] * 2 + [("ssn", f"{k:09d}") for k in range(300)], "kind string, form string")
    table = rows(pii.surrogate_table(found, b"k"))
    real = {(k, f) for k, f, _ in table}
    assert len(table) == 400 == len({(k, s) for k, _, s in table}) and not real & {(k, s) for k, _, s in table}


def test_names_are_one_entity_behind_any_title_and_without():
    text = "Mr John Smith met Dr Smith and Dr John Smith. Smith's wife, Dr Anna Maria Weber, left; Weber and SMITH wrote to Mrs Anna Weber. Mr Smith Mr Jones, Dr von Berg."
    forms = {}
    for start, end, kind, form, _ in pii.entities(text):
        assert kind == "name"
        forms.setdefault(text[start:end].casefold(), []).append(form)
    assert {w: (len(set(f)), len(f)) for w, f in forms.items()} == {"john": (1, 2), "smith": (1, 6), "anna": (1, 2), "maria": (1, 1), "weber": (1, 3), "jones": (1, 1), "berg": (1, 1)}
    assert forms["john"] == ["m:john"] * 2 and forms["anna"] == ["f:anna"] * 2
    assert sum(e[4] for e in pii.entities(text)) == 11


def test_names_in_text_lose_no_letter(spark):
    docs = spark.createDataFrame([(1, "Dr Anna Weber came. Weber said: ask Mr Smith's son, г-жа Иванова."), (2, "Mrs Weber")], DOCS)
    got = {r.doc_id: (r.text, r.n_entities) for r in pii.with_surrogates(docs, b"k").collect()}
    m = re.fullmatch(r"Dr (\w+) (\w+) came\. (\w+) said: ask Mr (\w+)'s son, г-жа (\w+)\.", got[1][0])
    assert m and m[2] == m[3] and got[2] == (f"Mrs {m[2]}", 1) and got[1][1] == 4
    assert not re.search("Anna|Weber|Smith|Иванова", got[1][0]) and m[5][-1] in "ая"


@pytest.mark.parametrize("phone", ["+14155550123", "+1 4155550123", "06 12 34 56 78", "+33 6 12 34 56 78", "06.12.34.56.78", "456-555-2186"])
def test_phones_of_other_forms_and_before_numbers(phone):
    for k in range(10):
        for text in (f"call {phone} now", f"call {phone} 1000{k} now"):
            found = pii.entities(text)
            assert found and found[0][0] == 5 and found[0][1] >= 5 + len(phone), text
    digits = re.sub(r"\D", "", phone)
    assert [e[2:4] for e in pii.entities(f"call {phone}.")] == [("phone", digits[1:] if phone.startswith("+1") else digits)]


def test_names_of_any_length_and_numbers_of_other_countries(spark):
    names = ["Dr Anna Maria Luisa Weber", "Frau Ursula von der Leyen", "Señor Juan Carlos Alberto de la Vega Ruiz"]
    docs = [(k, f"Yesterday {n} spoke. {n.split(' ')[-1]} left.") for k, n in enumerate(names)] + [(8, "call +49 4155550123 or +1 415 555 0123, or +4915112345678901.")]
    got = {r.doc_id: r.text for r in pii.with_surrogates(spark.createDataFrame(docs, DOCS), b"k").collect()}
    for k, n in enumerate(names):
        assert not [w for w in n.split(" ")[1:] if w[0].isupper() and w in got[k]]
    numbers = [re.sub(r"\D", "", x) for x in re.findall(r"\+[\d ]+", got[8])]
    assert numbers[0][-10:] != numbers[1][-10:] and "4155550123" not in "".join(numbers)
    assert [e[:2] for e in pii.entities("Herr Braun der Bank, Dr Weber den Brief")] == [(5, 10), (24, 29)]


def test_card_before_a_number():
    assert [e[2:4] for e in pii.entities("pay 4041 8949 7460 8795 123 now")][0] == ("card", "4041894974608795")


# --- 2: decontamination ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [400_000, 200])
def test_passages(spark, most):
    items = [(1, prose(1, 30)), (2, prose(2, 10)), (3, "Only, FOUR wörds here"), (4, ""), (5, None), (None, prose(6, 12)), (2, prose(2, 10)), (7, prose(1, 30))]
    docs = ODD + [(10, prose(3) + " " + prose(1, 30)[20:90].upper() + "! " + prose(4)), (11, "x only four WÖRDS here only four wörds here."), (12, prose(2, 10) + " " + prose(2, 10)), (13, prose(6, 12))]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    plain = lambda t: word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))

    def brute(t):
        w, hit, ids = plain(t), set(), set()
        for item, text in items:
            x = plain(text)
            k = min(10, len(x))
            for p in {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if x else ():
                at = [i for i in range(len(w) - k + 1) if tuple(w[i : i + k]) == p]
                hit.update(j for i in at for j in range(i, i + k))
                ids.update([str(item) if item is not None else ""] if at else [])
        return len(w), len(hit), tuple(sorted(ids))

    found = decontaminate.find_passages(spark.createDataFrame([(*d, "kept") for d in docs], DOCS + ", hits string"), spark.createDataFrame(items, "item_id long, text string"), spans=True, automaton_chars=most)
    got = sorted(((r.words, sum(h.end - h.start for h in r.hits), tuple(r["items"])) for r in found.collect()), key=str)
    assert got == sorted((brute(t) for _, t in docs), key=str)
    row = next(r for r in found.collect() if r.doc_id == 11)
    assert [row.text[s.start : s.end] for s in row.spans] == ["only four wörds here"]  # only A to Z are lower-cased
    clean = decontaminate.without_passages(spark.createDataFrame([(*d, "kept") for d in docs], DOCS + ", hits string"), spark.createDataFrame(items, "item_id long, text string"), 10)
    assert clean.columns == ["doc_id", "text", "hits"] and clean.count() == sum(not brute(t)[1] for _, t in docs)


# --- 3: main text ------------------------------------------------------------------------------------------------


def test_backward_pass_equals_differences():
    rng = np.random.default_rng(1)
    model = html.Labeller(5, units=3)
    x, mask = html.padded([rng.normal(size=(n, 5)) for n in (4, 2, 6)])
    labels = (rng.random(mask.shape) < 0.5) * 1.0

    def loss():
        s = model.scores(x, mask)
        return -float(((labels * np.log(s) + (1 - labels) * np.log(1 - s)) * mask).sum() / mask.sum())

    for name, g in model.gradients(x, mask, labels).items():
        place = tuple(rng.integers(s) for s in model.p[name].shape)
        model.p[name][place] += 1e-5
        up = loss()
        model.p[name][place] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[place], abs=1e-6), name
        model.p[name][place] += 1e-5


def test_main_text_of_pages(spark):
    body = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><div class='ad'>Buy it now.</div><article><h1>A  title &amp; more</h1><p><b>One&nbsp;two.<br><p>Three <i>fo</i>ur, five.</p></article><footer>&copy; x.example.com</footer>"
    pages = [(1, f"<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body>{body}"), (2, None), (3, ""), (4, "<<<>>"), (5, "<!-- open"), (6, f"<body>{body}")]
    got = {r.page_id: r.main_text for r in html.extracted(spark.createDataFrame(pages, "page_id long, html string")).collect()}
    assert got[1] == got[6] == "A title & more\n\nOne two.\n\nThree four, five."
    assert got[2] == got[3] == got[5] == ""


@pytest.mark.parametrize("start", ["<svg-icon></svg-icon>", "<object-viewer>", "<title-bar></title-bar>", "<svg viewBox='0 > 0'/>", "<math/>", "<svg><text>5</text></svg>", "<template-x>", "<script-y/>"])
def test_elements_that_only_look_skipped_swallow_nothing(start):
    page = f"<header>{start}</header><article><p>Body</p></article><script>x('<p>no</p>')</script>"
    assert [b.text for b in html.blocks(page)] == ["Body"]


def test_text_of_math_object_and_noscript_reaches_the_model():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><object data='a'><p>In words.</p></object><noscript><p>No <b>script</b>.</p><style>p{}</style></noscript></article>"
    found = html.blocks(page)
    assert [b.text for b in found] == ["Let x=1 be.", "In words.", "No script."]
    assert found[1].path == ("article", "object", "p") and found[2].path == ("article", "noscript", "p")


def test_far_ancestors_and_late_class_names_reach_the_model():
    deep = lambda top: html.block_features(html.blocks(f"<{top}>{'<div class=c><section>' * 20}Some words here."))
    assert (deep("nav") != deep("main")).any()
    late = lambda name: html.block_features(html.blocks(f"<div class='a b c d e f g h i {name}'>Some words here.</div>"))
    assert (late("sidebar") != late("content")).any()


def test_features_of_blocks_equal_plain_loops():
    odd = ["a.", "A", "(b)", "©", "É!", "İ", "¿c?", "...", "x" * 100, "&nbsp;d,", "1"]
    pages = [[html.Block(("div", ".c", "div") * (i % 15), " ".join(odd[j % 11] for j in range(i, i * 7 + 1)), i) for i in range(n)] for n in (0, 1, 30)]
    pages.append([html.Block(("main", f".{i}"), f"Block {i % 300}", 0) for i in range(html.RUN + 3)])  # more than one run
    for page in pages:
        found = html.block_features(page)
        assert found.shape == (len(page), html.PATH + html.WORDS + html.FIGURES) and found.dtype == np.float32
        for i, b in enumerate(page):
            path, words = np.zeros(html.PATH, np.float32), np.zeros(html.WORDS, np.float32)
            for k, name in enumerate(dict.fromkeys(reversed(b.path))):
                h = zlib.crc32(name.encode())
                path[h % html.PATH] += (1.0 if h & 0x10000 else -1.0) / (1 + 0.1 * min(k, 16))
            split = b.text.lower().split()
            for w in split:
                h = zlib.crc32(w.strip(".,:;!?()©").encode())
                words[h % html.WORDS] += 1.0 if h & 0x10000 else -1.0
            words /= max(1.0, float(np.linalg.norm(words)))
            figures = (
                min(len(split), 100) / 50, min(np.log1p(len(b.text)), 8) / 4, b.linked / len(b.text), sum(w[-1] in ".!?,;:" for w in split) / len(split),
                i / len(page), 1.0 if b.text[0].isupper() else 0.0, 1.0 if b.text[0] == "©" else 0.0, min(len(page), 200) / 100,
            )
            assert (found[i] == np.concatenate([path, words, np.array(figures, np.float32)])).all(), (len(page), i)


def test_words_of_blocks_take_no_step_each():
    steps = 0

    def count(frame, event, arg):
        nonlocal steps
        steps += event in ("call", "c_call")

    page = [html.Block(("article", "p"), "some words of a text, again and again. " * 200, 0)] * 20
    sys.setprofile(count)
    try:
        html.block_features(page)
    finally:
        sys.setprofile(None)
    assert steps < 1_000  # 32,000 words


def test_stores_of_words_and_paths_stay_small():
    known = html._Known(len, 3, 2)
    assert [known[k] for k in ("a", "bb", "a", "cccc", "ddd")] == [1, 2, 1, 4, 3] and dict(known) == {"ddd": 3}


def test_held_out_pages_are_labelled():
    rng, wrong, total = np.random.default_rng(2024), 0, 0
    for _ in range(100):
        page = html.blocks(html.made_page(rng))
        marks = [b.text.startswith(html.MAIN) for b in page]
        plain = [html.Block(b.path, b.text.replace(html.MAIN, "").strip(), b.linked) for b in page]
        x, mask = html.padded([html.block_features(plain)])
        wrong += sum(a != b for a, b in zip(html.standard_labeller().scores(x, mask)[0] >= 0.5, marks, strict=True))
        total += len(page)
    assert wrong <= 0.01 * total


# --- 4 and 6: tokens ------------------------------------------------------------------------------------------------


def test_codec_equals_the_tokenizers_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t for _, t in ODD] + ["It's 12 o'clock,  isn't it?\n\n  yes", "a<|endoftext|> b<|endoftext|>", "日本語 ñandú 🙂🙂 x̂", "aaaaaaaaaab" * 300, "\x1c\x85  z"]
    coded = bpe.encode(spark.createDataFrame([(t, 1) for t in texts], "text string, ids long"), TOKENIZER, outputs=("ids", "n_tokens", "ids_sha256", "decoded"))
    for r in coded.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r["ids"], r.n_tokens) == (ids, len(ids)) and r.decoded == library.decode(ids, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert all(r.text in (None, r.decoded) for r in bpe.decode(coded.drop("decoded"), TOKENIZER).collect())


def test_piece_counts_equal_greedy_matching():
    rng = random.Random(3)
    for _ in range(500):
        vocabulary = {"a", "b", "c"} | {"".join(rng.choices("abc", k=rng.randint(2, 6))) for _ in range(rng.randint(0, 12))}
        word = "".join(rng.choices("abc", k=rng.randint(0, 25)))
        rest, n = word, 0
        while rest:
            rest, n = rest[max(k for k in range(1, len(rest) + 1) if rest[:k] in vocabulary) :], n + 1
        assert tokens.PieceCounter(list(vocabulary), ["a", "b", "c"]).count(word) == n


def test_token_counts_of_odd_texts(spark):
    got = tokens.token_counts(spark.createDataFrame(ODD, DOCS), TOKENIZER).collect()
    assert len(got) == len(ODD) and all((r.n_tokens == 0) == (not r.text) for r in got)


# --- 5: quality ---------------------------------------------------------------------------------------------------


def test_margin_in_linear_time_equals_all_pairs():
    rng = np.random.default_rng(2)
    m = quality.FactorisationMachine(0.3, rng.normal(size=20), rng.normal(size=(20, 4)), 10)
    index, value = np.arange(12), rng.normal(size=12)
    pairs = sum(value[i] * value[j] * (m.factors[i] @ m.factors[j]) for i in range(12) for j in range(i))
    assert m.margin(index, value) == pytest.approx(0.3 + m.weights[index] @ value + pairs)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.scored(docs, quality.learn(docs, labels)).join(labels, "doc_id").filter(quality.held_out("doc_id"))
    right = scored.select(F.avg(((F.col("score") >= 0.7).cast("int") == F.col("quality")).cast("double")).alias("r")).first().r
    assert right > 0.9


def test_odd_texts_score_between_0_and_1(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    machine = quality.learn(docs, spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1)], "doc_id long, quality int"))
    assert all(0 <= r.score <= 1 for r in quality.scored(docs, machine).collect())


# --- 7: repeats -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shard", [40_000, 3])
def test_repeats(spark, shard):
    shared, line = prose(100, 60, 500), prose(101, 21, 500)
    docs = ODD + [(k, f"{prose(k, 50, 500)} {shared} {prose(k + 50, 30, 500)}") for k in range(20, 30)] + [(k, f"{line}\n{prose(k, 40, 500)} {line}") for k in range(30, 45)]
    docs += [(50, prose(50, 300, 2)), (51, prose(21, 50, 500) + " " + shared), (52, docs[-1][1]), (53, docs[-1][1]), (54, "x " * 400)]
    got = substrings.without_repeats(spark.createDataFrame([(*d, 0) for d in docs], DOCS + ", kept int"), shard_stretches=shard)
    first = {}
    order = lambda d: -(2**63) if d is None else d
    split = [(order(d), re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    for d, w in sorted(split, key=lambda x: x[0]):
        for i in range(len(w) - 19):
            first.setdefault(tuple(w[i : i + 20]), (d, i))
    want = []
    for (d, t), (o, w) in zip(docs, split, strict=True):
        gone = {j for i in range(len(w) - 19) if first[tuple(w[i : i + 20])] < (o, i) for j in range(i, i + 20)}
        want.append((d, t, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert rows(got.select("doc_id", "text", "n_words", "n_removed", "kept")) == sorted(want, key=str)


def test_the_search_for_repeats_starts_without_the_texts(spark, monkeypatch):
    gone, locate, drop = [], substrings._located, substrings.discard
    seen = []
    monkeypatch.setattr(substrings, "discard", lambda *t: (gone.extend(c for x in t for c in x.columns), drop(*t)))
    monkeypatch.setattr(substrings, "_located", lambda *a: seen.append("text" in gone) or locate(*a))
    passage = prose(7, 60, 3000)
    got = substrings.without_repeats(spark.createDataFrame([(1, passage), (2, "new " + passage)], DOCS))
    assert [(r.doc_id, r.n_removed) for r in got.orderBy("doc_id").collect()] == [(1, 0), (2, 60)]
    assert seen == [True]


@pytest.mark.parametrize("shard", [40_000, 3])
def test_repeats_of_null_and_repeated_ids(spark, shard):
    shared = [prose(600 + k, 60, 500) for k in range(8)]
    docs = [(None, f"{prose(620 + k, 25 + k, 500)} {shared[k]} {prose(640 + k, 30, 500)}") for k in range(4)]
    docs += [(7, f"{prose(660 + k, 25 + k, 500)} {shared[k]}") for k in range(4, 8)]
    docs += [(50 + k, f"{prose(680 + k, 40, 500)} {shared[k]} {prose(700 + k, 20, 500)}") for k in range(8)] + [(None, f"{prose(720, 80, 500)} {shared[0]}")]
    got = substrings.without_repeats(spark.createDataFrame(docs, DOCS), shard_stretches=shard)
    order = lambda d: -(2**63) if d is None else d
    split, first = [(order(d), t.split()) for d, t in docs], {}
    for d, w in split:
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            first[key] = min(first.get(key, (d, i)), (d, i))
    want = []
    for (d, t), (o, w) in zip(docs, split, strict=True):
        gone = {j for i in range(len(w) - 19) if first[tuple(w[i : i + 20])] < (o, i) for j in range(i, i + 20)}
        want.append((d, t, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert sum(x[3] >= 60 for x in want) == 9
    assert rows(got.select("doc_id", "text", "n_words", "n_removed", "kept")) == sorted(want, key=str)


# --- 8: SimHash -----------------------------------------------------------------------------------------------------


def test_fingerprint():
    text = "A b\tc d\x0be\nA b c"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == bits
    assert simhash.fingerprint(None) == simhash.fingerprint(" ") == 0
    assert simhash.fingerprint("one Two") == xxhash.xxh64_intdigest("one two", 42)


@pytest.mark.parametrize("cell", [2, 32])
def test_all_links_within_two_bits(spark, cell):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(120)} | {0, 1, 2**63}
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in fps)
    want = sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    got = simhash.links_within(spark.createDataFrame([(x,) for x in signed], "fp long"), cell=cell)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_near_duplicates(spark):
    base = prose(9, 400, 5000)
    docs = ODD + [(20, base), (21, base), (22, base + " end"), (23, prose(10, 400, 5000))]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()}
    assert {(20, 20), (21, 20), (22, 20), (23, 23), (1, 1), (2, 1), (3, 1), (None, 1), (5, 4)} <= got


# --- 9: vectors -----------------------------------------------------------------------------------------------------


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 16))
    dense = x[0] + 0.15 * rng.normal(size=(150, 16))
    loose = x[1] + 0.4 * rng.normal(size=(80, 16))
    all_x = np.concatenate([x, dense, loose, np.repeat(x[2:3], 50, 0), 3 * x[3:4]]).astype(np.float32)
    data = [(k, v.tolist()) for k, v in enumerate(all_x)] + [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [1.0, None] * 8), (9004, [float("nan")] * 16), (9005, [1.0, 2.0]), (None, x[5].tolist())]
    got = vectors.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>")).collect()
    assert len(got) == len(data)
    unit = all_x.astype(np.float64)
    unit = np.concatenate([unit, x[5:6].astype(np.float32)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = {r.vec_id: r for r in got}
    degree = np.array([found[k].n_links for k in range(len(all_x))])
    assert (degree <= near[:-1].sum(1)).all() and degree.sum() >= 0.99 * near[:-1].sum()
    assert found[None].component_id == 5 and not found[None].kept
    assert all(found[k].n_links == 0 and found[k].kept for k in range(9000, 9006))


def test_vectors_of_each_length_link_among_themselves(spark):
    rng = np.random.default_rng(3)
    data = [(k, rng.normal(size=5).tolist()) for k in range(20)] + [(100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 3.01]), (102, [1.0, 2.0]), (103, [1.0, 2.0]), (104, [7.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    assert [got[k] for k in range(100, 105)] == [(1, 100), (1, 100), (1, 102), (1, 102), (0, 104)] and len(got) == len(data)


# --- 10: secrets ----------------------------------------------------------------------------------------------------


def test_known_forms(spark):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    texts = [t for _, t in ODD] + ["é token=abcdef apikey: 'abc' SECRET = \"aé_b.c-12345\" Api_Key:zzzzzz", "AKIA" + "A1" * 8 + " xAKIAAKIA" + "B" * 16, "f" * 30 + "F" + "0" * 23, "token=token=abcdefg passwd:secret:abcdefgh " * 400]

    def brute(t):
        t = t or ""
        found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return sorted(found)

    got = secrets.find_secrets(spark.createDataFrame([(t, 0) for t in texts], "text string, base int")).collect()
    assert [[(s.start, s.order, s.kind, s.end) for s in r.base] for r in got] == [brute(t) for t in texts]
    assert all({tuple(s) for s in r.base} <= {tuple(s) for s in r.secrets} for r in got)


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choices(alphabet, k=44)) for _ in range(60)]
    words = ["internationalization-of-standardised-administrative-procedures", "x" * 50, "xyz" * 15, "0123456789" * 2, "/usr/local/share/applications/documents/readme"]
    docs = [(k, f"see {key} there") for k, key in enumerate(keys)] + [(100 + k, f"see {w} there") for k, w in enumerate(words)] + ODD
    frame = spark.createDataFrame(docs, DOCS)
    found = {r.doc_id for r in secrets.find_secrets(frame).collect() if any(s.kind == "random" for s in r.secrets)}
    assert len(found & set(range(60))) >= 50 and not found & set(range(100, 110))
    clean = {r.doc_id: r.text for r in secrets.redacted(frame).collect() if r.doc_id is not None}
    assert sum(t == "see [SECRET] there" for t in clean.values() if t) >= 50 and clean[100] == docs[60][1] and clean[1] is None


def test_random_strings_after_an_equals_sign_are_found(spark):
    rng = random.Random(18)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    forms = ["AWS_SECRET_ACCESS_KEY={}", "client_key={}", "https://a.example.com/b?sig={}&v=1", "https://a.example.com/b?v=1&sig={}", "key= {}", 'key="{}"']
    docs = [(k, forms[k % 6].format("".join(rng.choices(alphabet, k=40)))) for k in range(120)]
    clean = {r.doc_id: r.text for r in secrets.redacted(spark.createDataFrame(docs, DOCS)).collect()}
    for form in range(6):
        assert sum(clean[k] == forms[form].format("[SECRET]") for k in range(form, 120, 6)) >= 16


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def plain_battery(value):
    """The tests for one string in plain Python: tenths of the negative logarithm of its chance."""
    if value.isdigit():
        return 0
    _, _, alphabet, excess, words = next(e for e in secrets.ENCODINGS if re.search(e[1], value))
    size, n = len(alphabet), len(value)
    tail = lambda z: 1 / (1 + math.exp(1.5976 * (z := max(-8.0, min(8.0, z))) + 0.07056 * z**3))
    chi = sum(value.count(c) ** 2 for c in alphabet) * size / n - n
    even = (size - 1 + excess * n - chi) / math.sqrt(2 * (size - 1) + 4 * excess * n)
    kind = lambda c: "mark" if c in alphabet[-2:] and c in "+/-_" else next((k for k, part in enumerate(LETTERS) if c in part), c)
    turns = sum(kind(a) != kind(b) for a, b in itertools.pairwise(value))
    share = Counter(map(kind, alphabet)).values()
    same, thrice = sum((k / size) ** 2 for k in share), sum((k / size) ** 3 for k in share)
    runs = (turns - (1 - same) * (n - 1)) / math.sqrt((same * (1 - same) + 2 * (thrice - same**2)) * (n - 1))
    mixed = (turns - words * (n - 1)) / math.sqrt(words * (1 - words) * (n - 1))
    x = np.array([alphabet.find(c) + 1 for c in value], float)
    x -= x.mean()
    serial = (x[:-1] * x[1:]).sum() / (x * x).sum() * math.sqrt(n) if (x * x).sum() > 0 else 99.0
    p = tail(even) * tail(mixed)
    chance = 1.0 if runs**2 + serial**2 > secrets.REJECT else p * (1 - math.log(p))
    return math.floor(-math.log10(max(chance, 1e-30)) * 10)


def key_texts(rng, alphabets, lengths, each):
    keys = ["".join(rng.choices(a, k=n)) for a in alphabets for n in lengths for _ in range(each)]
    return {k: f"see {key} there" for k, key in enumerate(keys)}


NAMES = ["XMLHttpRequestUploadProgressEvent", "docs/MyProject/BuildSystem/CMakeLists", "/opt/spark/jars/bundle-aws-runtime-1", "getUserByEmailAddressOrNull", "AbstractSingletonProxyFactoryBean"]
NAMES += ["/usr/local/share/applications/documents/readme", "examples/src/main/python/sql/streaming/word_count_session", "internationalization-of-standards", "MAXIMUM_NUMBER_OF_CONNECTIONS", "20240131T235959Z20240201"]


def test_battery_levels_and_random_spans_equal_plain_python(spark):
    rng = random.Random(28)
    texts = key_texts(rng, [LETTERS[0] + LETTERS[1] + LETTERS[2] + "+/", LETTERS[2] + "ABCDEF", LETTERS[0] + "234567", LETTERS[2] + LETTERS[1], LETTERS[0] + LETTERS[1] + LETTERS[2] + "-_"], (20, 31, 32, 64, 70), 6)
    texts |= {1000 + k: f"{n}, {n}." for k, n in enumerate([*NAMES, "a" * 20, "ab" * 40, "1" * 30, "-" * 25, "a/+b-_" * 9])}
    found = {d: [(m.start(), m.end(), sum(len(m[0]) >= c for c in secrets.CLASSES), plain_battery(m[0])) for m in re.finditer(secrets.RUN, t)] for d, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    got = docs.select("doc_id", secrets._candidates(F.col("text")).alias("c")).collect()
    assert {r.doc_id: [tuple(c) for c in r.c] for r in got} == found
    counted, least = Counter((c[2], c[3]) for cs in found.values() for c in cs), {}
    for stratum, level in sorted(counted):
        above = lambda k: sum(n for (s, v), n in counted.items() if s == stratum and v >= k)  # noqa: B023, E731
        if 10 ** (-level / 10) * above(-1) <= secrets.FALSE_SHARE * above(level):
            least.setdefault(stratum, level)
    assert {r.stratum: r.least for r in secrets.levels(docs).collect()} == least and least
    for r in secrets.find_secrets(docs).collect():
        inside = lambda a, b: any(s.start <= a and s.end >= b for s in r.base)  # noqa: B023, E731
        want = [(a, b) for a, b, stratum, level in found[r.doc_id] if level >= least.get(stratum, 10**6) and not inside(a, b)]
        assert [(s.start, s.end) for s in r.secrets if s.kind == "random"] == want


def test_recall_by_encoding_and_no_names_or_paths(spark):
    rng = random.Random(38)
    alphabets = {"HEX": LETTERS[2] + "ABCDEF", "base32": LETTERS[0] + "234567", "lower36": LETTERS[2] + LETTERS[1], "base64": LETTERS[0] + LETTERS[1] + LETTERS[2] + "+/"}
    texts = key_texts(rng, alphabets.values(), (24, 32, 40), 40)
    texts |= {1000 + k: f"see {n} there" for k, n in enumerate(NAMES * 40)}
    rows = secrets.find_secrets(spark.createDataFrame(list(texts.items()), DOCS)).collect()
    found = {r.doc_id for r in rows if any(s.kind == "random" for s in r.secrets)}
    recall = {(name, n): len(found & set(range(k, k + 40))) / 40 for k, (name, n) in zip(range(0, 480, 40), itertools.product(alphabets, (24, 32, 40)), strict=True)}
    least = {24: 0.25, 32: 0.5, 40: 0.75}
    assert all(share >= least[n] for (_, n), share in recall.items()), recall
    assert not {texts[k] for k in found if k >= 1000}


# --- near copies ------------------------------------------------------------------------------------------------------


def changed(text, share, rng):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def shingle_sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def copied_documents():
    rng, line = random.Random(12), prose(500, 30, 300)
    docs = [(k, prose(200 + k, 250, 3000) + " " + line) for k in range(25)]
    docs += [(100 + 40 * k + n, changed(docs[k][1], share, rng)) for k in range(25) for n, share in enumerate((0.002, 0.005, 0.01, 0.02, 0.022, 0.05))]
    docs += [(5000 + k, changed(docs[0][1], 0.012, rng)) for k in range(30)] + [(None, changed(docs[1][1], 0.01, rng)), (None, prose(900, 200, 3000)), (3, prose(901, 90, 3000))]
    return docs + [(None, docs[-2][1] + " end"), (3, docs[3][1])] + [(d, t) for d, t in ODD if t is None or t.isascii()]


def components_of(docs):
    sets = [shingle_sets(t) for _, t in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if root[i] != root[j] and near(sets[i], sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    return root


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_copies_link_from_similarity_0_8(spark, monkeypatch, rounds):
    monkeypatch.setattr(copies, "ROUNDS", rounds)
    docs = copied_documents()
    frame = spark.createDataFrame(docs, DOCS)
    groups = {}
    for (d, t), r in zip(docs, components_of(docs), strict=True):
        groups.setdefault(r, []).append((str(d), hashlib.md5((t or "").encode()).hexdigest()))
    got = {}
    for r in copies.near_copies(frame).collect():
        got.setdefault(bytes(r.component), []).append((str(r.doc_id), r.tie.hex()))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("rounds", [0, 2])
def test_no_link_is_lost_among_texts_of_many_lengths(spark, monkeypatch, rounds):
    monkeypatch.setattr(copies, "ROUNDS", rounds)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(14)]
    texts = []
    for _ in range(40):
        base = rng.choices(words, k=rng.randint(12, 60))
        for _ in range(10):
            own = [rng.choice(words) if rng.random() < 0.03 else w for w in base]
            texts.append(" ".join(own[rng.randint(0, len(own) // 9) :] + rng.choices(words, k=rng.randint(0, len(own) // 6))))
    texts = list(dict.fromkeys(texts))
    sets = [frozenset(zip(w, w[1:], strict=False)) for w in map(str.split, texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and near(sets[i], sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    groups, got = {}, {}
    for k, r in enumerate(root):
        groups.setdefault(r, []).append(k)
    for r in copies.near_copies(spark.createDataFrame(list(enumerate(texts)), DOCS), words=2).collect():
        got.setdefault(bytes(r.component), []).append(r.doc_id)
    assert 40 < len(groups) < len(texts) - 40
    assert sorted(map(sorted, got.values())) == sorted(groups.values())


def test_a_large_group_that_hangs_together_in_part_is_not_paired(spark, monkeypatch):
    seen, verify = [], copies._verified
    monkeypatch.setattr(copies, "_verified", lambda pairs, *a: seen.append(pairs.count()) or verify(pairs, *a))
    rng, base = random.Random(8), prose(77, 150, 3000).split()
    docs = []
    for k in range(200):
        at = set(rng.sample(range(len(base)), rng.choice((2, 3, 3, 4, 5))))
        docs.append((k, " ".join(f"new{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(base))))
    groups, got = {}, {}
    for (d, _), r in zip(docs, components_of(docs), strict=True):
        groups.setdefault(r, []).append(d)
    for r in copies.near_copies(spark.createDataFrame(docs, DOCS)).collect():
        got.setdefault(bytes(r.component), []).append(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(groups.values())
    assert len(groups) > 20 and sum(seen) < 10 * len(docs), seen


def test_simhash_finds_candidates_before_the_exact_search(spark, sf_dir, monkeypatch):
    seen, search = [], simhash.near_duplicates
    monkeypatch.setattr(simhash, "near_duplicates", lambda docs, *a, **k: seen.append((docs.columns, k)) or search(docs, *a, **k))
    text = prose(3, 400, 3000)
    docs = [(1, text), (2, text + " end"), (3, prose(4, 400, 3000))]
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(docs, DOCS), sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]
    assert seen == [(["node", "text"], {"words": copies.WORDS})]


def test_one_row_of_each_group_of_near_copies_stays(spark, sf_dir):
    docs = copied_documents()
    least = {}
    for (d, t), r in zip(docs, components_of(docs), strict=True):
        key = (d is None, d or 0, hashlib.md5((t or "").encode()).hexdigest())
        least[r] = min(least.get(r, (key, d, t)), (key, d, t), key=lambda x: x[0])
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(docs, DOCS), sf_dir)
    assert sorted((str(r.doc_id), (r.text or "").strip()) for r in got.collect()) == sorted((str(d), (t or "").strip()) for _, d, t in least.values())


# --- pipeline ---------------------------------------------------------------------------------------------------------


def test_pipeline_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns and docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and {"ids", "n_tokens"} <= set(last.columns)


def test_pipeline_stages_take_columns_of_any_name_and_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.selectExpr("*", "doc_id AS spans", "lang AS tie", "source AS hits", "n_chars AS component")
    for stage in (corpus_pipeline.one_of_each, corpus_pipeline.without_benchmark):
        plain, other = stage(spark, docs, sf_dir), stage(spark, odd, sf_dir)
        assert other.columns == odd.columns
        assert rows(other.select("doc_id")) == rows(plain.select("doc_id"))
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_of_rows_with_one_id_and_text_the_smallest_columns_stay(spark, sf_dir):
    docs = spark.createDataFrame([(1, "some text of five words", "b"), (1, "some text of five words", "a"), (2, "some text of five words", "a")], "doc_id long, text string, source string")
    assert rows(corpus_pipeline.one_of_each(spark, docs, sf_dir)) == [(1, "some text of five words", "a")]
