"""Personal data: detected entities get keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from candlewick.llm.common import kept, release

#: Forms of address by gender, and syllables of surrogate names by script (female names end in the last set).
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "г-жа"),
    "m": ("Mr", "Herr", "Monsieur", "Sr", "Señor", "г-н"),
    "n": ("Dr", "Prof"),
}
#: Small words inside a name, and those that only follow one of them.
PARTICLES = {"van", "von", "de", "du", "da", "di", "del", "della", "dos", "ter", "ten", "af", "av", "bin", "al", "el"}
AFTER_PARTICLE = {"der", "den", "dem", "la", "las", "los", "le"}
SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe ka ke ki la le li lo ma me mi na ne ni pa ra re ri ro sa se ta te ti va ve vi".split(), {"f": "na la ra lia nia sa".split(), "m": "n l r d k s".split(), "n": "n l r s".split()}),
    "cyrillic": ("ба бе би бо ва ве ви да де ди ка ке ки ла ле ли ма ме ми на не ни па ра ре ри са се та те ти".split(), {"f": "на ла ра лия ния са".split(), "m": "н л р д к с".split(), "n": "н л р с".split()}),
    "greek": ("βα βε βι δα δε δι κα κε κι λα λε λι μα με μι να νε νι πα ρα ρε ρι σα σε τα τε τι".split(), {"f": "να λα ρα λια νια".split(), "m": "ς ν ρ".split(), "n": "ς ν".split()}),
}
_TITLE = "|".join(re.escape(t) for names in TITLES.values() for t in names)
_WORD = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
FORMS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d]|[.-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w.])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w]|[.-]\d)"
    r"|(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d|0\d)(?:[ .-]\d{2}){4}(?![\w]|[.-]\d)|\+\d{1,3}[ .-]?\d{6,12}(?![\w]|[.-]\d))",
    "name": rf"\b(?:{_TITLE})\.?[ ]{_WORD}(?:[ ]{_WORD})*",
}
FOUND = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in FORMS.items()))
_NOT_CARD = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in FORMS.items() if kind != "card"))
_BARE = re.compile(rf"\b{_WORD}")
_GENDER = {t: gender for gender, names in TITLES.items() for t in names}


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * 2, 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10


def _digits(raw: str) -> str:
    return "".join(c for c in raw if c.isdigit())


def _checked(raw: str) -> str:
    """The longest start of a card-like string, whole groups of it, that has a valid check digit; empty without one."""
    ends = [len(raw), *(k for k in range(len(raw) - 1, 12, -1) if raw[k] in " -")]
    return next((raw[:k] for k in ends if len(_digits(raw[:k])) >= 13 and not _luhn(_digits(raw[:k]))), "")


def _name_words(m: re.Match) -> tuple[str, list[tuple[int, int, str]]]:
    """Gender of a title, and the words of the name behind it: start, end and folded case."""
    title, *words = m[0].split(" ")
    at, found, inside = m.start() + len(title) + 1, [], False
    for w in words:
        if w[0].isupper():
            own = re.sub("['’]s$", "", w)
            if w in _GENDER:
                break
            found.append((at, at + len(own), own.casefold()))
            if own != w:
                break
        elif found and not (w in PARTICLES or inside and w in AFTER_PARTICLE):
            break
        inside = not w[0].isupper()
        at += len(w) + 1
    return _GENDER[title.rstrip(".")], found


def _family(word: str) -> str:
    """Gender that a surname shows itself, in scripts whose languages inflect surnames; a Latin one shows none."""
    latin = unicodedata.name(word[0], "LATIN").startswith("LATIN")
    return "n" if latin else "f" if word[-1] in "аяαηυ" else "m"


def entities(text: str | None) -> list[tuple[int, int, str, str, int]]:
    """Start, end, kind, normal form, and one for the first part of a mention (zero for the others). Mentions of one entity have one normal
    form, however written.

    Names have a part for each word, so that a surname is the same behind any title and given name. Within a text, the words of titled
    names are also found where they stand without a title, and given names take the gender that any title of theirs tells.
    """
    text = text or ""
    out, people, at = [], [], 0
    while m := FOUND.search(text, at):
        kind, raw, start = m.lastgroup, m[0], m.start()
        if kind == "card":
            raw = _checked(raw)
            if not raw:
                m = _NOT_CARD.match(text, start)
                if not m:
                    at = start + 1
                    continue
                kind, raw = m.lastgroup, m[0]
        at = start + len(raw)
        if kind == "name":
            gender, words = _name_words(m)
            at = words[-1][1] if words else start + raw.index(" ")
            if words:
                people.append((gender, words))
            continue
        digits = _digits(raw)
        if kind == "email":
            form = raw.lower()
        elif kind == "iban":
            form = raw.replace(" ", "")
        elif kind == "phone":
            form = digits[1:] if len(digits) == 11 and raw.startswith("+1") else digits  # the same number with and without its country
        else:
            form = digits if kind != "ip" else raw
        out.append((start, at, kind, form, 1))
    return sorted(out + _names(text, people, out)) if people else out


def _names(text: str, people: list[tuple[str, list[tuple[int, int, str]]]], others: list[tuple]) -> list[tuple[int, int, str, str, int]]:
    """Parts of the titled names and of their words' mentions without a title."""
    told: dict[str, set[str]] = {}
    for gender, words in people:
        for *_, w in words[:-1]:
            told.setdefault(w, set()).add(gender)
    only = {w: (genders - {"n"}).pop() if len(genders - {"n"}) == 1 else "n" for w, genders in told.items()}
    known = {w: f"{gender}:{w}" for w, gender in only.items()} | {words[-1][2]: f"{_family(words[-1][2])}:{words[-1][2]}" for _, words in people}
    out = []
    for gender, words in people:
        for k, (start, end, w) in enumerate(words):
            form = known[w] if k == len(words) - 1 else f"{only[w] if gender == 'n' else gender}:{w}"
            out.append((start, end, "name", form, int(k == 0)))
    taken = sorted((s, e) for s, e, *_ in others + out)
    last = -1
    k = 0
    for m in _BARE.finditer(text):
        own = re.sub("['’]s$", "", m[0])
        start, end = m.start(), m.start() + len(own)
        if not own[0].isupper() or own.casefold() not in known:
            continue
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k == len(taken) or end <= taken[k][0]:
            out.append((start, end, "name", known[own.casefold()], int(text[last:start] != " " or last < 0)))
            last = end
    return out


class _Stream:
    """Numbers drawn from a key and a label, without end."""

    def __init__(self, key: bytes, label: str) -> None:
        self.key, self.label, self.count, self.pool = key, label, 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.digest(self.key, f"{self.label}|{self.count}".encode(), "sha256")
            self.count += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n


def surrogate(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """Replacement for a normal form, itself a normal form of the kind: digits for digits, letters for letters, valid where the kind has a check."""
    draw = _Stream(key, f"{kind}|{form}|{attempt}").below
    wider = attempt // 8  # short forms may run out, so later attempts draw from more
    swap = lambda c: str(draw(10)) if c.isdigit() else chr(97 + draw(26)) if c.isascii() and c.islower() else chr(65 + draw(26)) if c.isascii() and c.isupper() else c
    if kind == "email":
        local, _, host = form.partition("@")
        labels = host.split(".")
        return "".join(map(swap, local)) + "".join(chr(97 + draw(26)) for _ in range(wider)) + "@" + ".".join(["".join(map(swap, x)) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        if wider:
            return ".".join(str(1 + draw(255)) for _ in range(4))
        return ".".join(str(draw(10) if len(x) == 1 else 10 + draw(90) if len(x) == 2 else 100 + draw(156)) for x in form.split("."))
    if kind == "card":
        body = form[0] + "".join(map(swap, form[1:-1]))
        return body + str(-_luhn(body + "0") % 10)
    if kind == "iban":
        body = "".join(map(swap, form[4:]))
        number = int("".join(str(int(c, 36)) for c in body + form[:2] + "00"))
        return form[:2] + f"{98 - number % 97:02d}" + body
    if kind == "phone":
        return "".join(str(1 + draw(9)) if k == 0 and c != "0" else swap(c) for k, c in enumerate(form))
    if kind == "name":
        gender, _, name = form.partition(":")
        return gender + ":" + " ".join(_name(draw, word, gender, wider) for word in name.split(" "))
    return "".join(map(swap, form))


def _name(draw, word: str, gender: str, wider: int = 0) -> str:
    script = unicodedata.name(next(c for c in word if c.isalpha()), "LATIN").split(" ")[0].lower()
    middle, last = SYLLABLES.get(script, SYLLABLES["latin"])
    count = max(2, min(5, (len(word) - 1) // 2)) + wider
    return "".join(middle[draw(len(middle))] for _ in range(count)) + last[gender][draw(len(last[gender]))]


def fitted(raw: str, kind: str, replacement: str) -> str:
    """A surrogate in the format of a mention: its separators, its case, and digits beyond the normal form as they are."""
    if kind == "email":
        return replacement.upper() if raw.isupper() else replacement
    if kind == "name":
        words = replacement.partition(":")[2].split(" ")
        return " ".join(w.upper() if r.isupper() and len(r) > 1 else w.capitalize() for w, r in zip(words, raw.split(" "), strict=False))
    if kind == "ip":
        return replacement
    fill = iter(replacement)
    spare = sum(c.isalnum() for c in raw) - len(replacement)
    out = []
    for c in raw:
        if not c.isalnum():
            out.append(c)
        elif spare > 0:
            spare -= 1
            out.append(c)
        else:
            out.append(next(fill))
    return "".join(out)


def surrogate_table(found: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``form``, ``surrogate``: one row per entity, no two entities of a kind alike, no surrogate equal to any real entity.

    ``found`` has ``kind`` and ``form``, repeats allowed. Entities whose surrogate collides draw again, except the one with
    the smallest form, until none collides; each round looks at all entities, and is written to the shared folder.
    """
    spark = found.sparkSession

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(surrogate=[surrogate(key, k, f, a) for k, f, a in zip(pdf["kind"], pdf["form"], pdf["attempt"], strict=True)])

    schema = "kind string, form string, attempt int, surrogate string"
    table = found.select("kind", "form").distinct().select("kind", "form", F.lit(0).alias("attempt"))
    table = kept(table.mapInPandas(drawn, schema), "entities")
    while True:
        real = table.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("real"))
        first = table.groupBy("kind", "surrogate").agg(F.min("form").alias("owner"))
        judged = table.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        judged = kept(judged.select("kind", "form", "attempt", "surrogate", (F.col("real").isNotNull() | (F.col("owner") != F.col("form"))).alias("again")), "entities")
        if judged.filter("again").isEmpty():
            release(spark)
            return judged.select("kind", "form", "surrogate")
        redrawn = judged.filter("again").select("kind", "form", (F.col("attempt") + 1).alias("attempt")).mapInPandas(drawn, schema)
        table = kept(judged.filter("not again").select("kind", "form", "attempt", "surrogate").union(redrawn), "entities")


def with_surrogates(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_entities``: the mentions replaced in it.

    Equal entities have equal surrogates everywhere (coreference), different ones different surrogates, and the same key gives the
    same result. Null texts stay null with no entities, empty ones empty. Repeated rows each stay. Other columns stay; one
    named ``n_entities`` is replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_entities", "__row", "__found")]
    named = docs.select(*columns, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("__row"))

    def mentions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(row, *e) for row, t in zip(pdf["row"], pdf["text"], strict=True) for e in entities(t)]
            yield pd.DataFrame(out, columns=["row", "start", "end", "kind", "form", "lead"])

    texts = named.select(F.col("__row").alias("row"), F.col(text).alias("text"))
    found = kept(texts.mapInPandas(mentions, "row binary, start int, end int, kind string, form string, lead int"), "mentions")
    table = surrogate_table(found, key)
    placed = found.distinct().join(table, ["kind", "form"])  # equal texts share a row
    listed = placed.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("start", "end", "kind", "surrogate", "lead")).alias("__found"))  # bounded by the text
    joined = named.join(listed, "__row", "left").drop("__row")
    schema = docs.select(*columns).schema.add("n_entities", "long")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, counts = [], []
            for t, all_found in zip(pdf[text], pdf.pop("__found"), strict=True):
                done, at = [], 0
                spans = sorted((e["start"], e["end"], e["kind"], e["surrogate"], e["lead"]) for e in all_found) if all_found is not None else []
                for start, end, kind, value, _ in spans:
                    done += [t[at:start], fitted(t[start:end], kind, value)]
                    at = end
                texts.append("".join([*done, t[at:]]) if spans else t)
                counts.append(sum(lead for *_, lead in spans))
            yield pdf.assign(**{text: texts, "n_entities": counts})

    return joined.mapInPandas(rewrite, schema)
