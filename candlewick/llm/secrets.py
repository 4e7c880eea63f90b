"""Secrets in text, with DataFrame functions only: known forms, and strings that a battery of randomness tests picks out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: The known forms. The second group of an assignment is its value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_CHARS = 6
#: Strings to test: at least 20 characters of one unbroken run. Padding at the end isn't tested.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encoding, the form that tells it, its alphabet in order, how far above one (times its length) the chi-squared statistic of
#: ordinary words lies (size of the alphabet times the chance that two letters of a text are equal, less one), and how often the kind of
#: letter (lower, upper, digit, mark) changes within joined words, names and paths.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef", 1.6, 0.25),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF", 1.6, 0.25),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567", 1.1, 0.1),
    ("lower36", "^[a-z0-9]+$", DIGITS + LOWER, 1.4, 0.12),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/", 3.2, 0.4),
    ("base64url", "^.*$", UPPER + LOWER + DIGITS + "-_", 3.2, 0.4),
)
#: The tests for order reject chance where their squared deviations add up to more than this (one in a hundred random strings);
#: false discoveries are held to this share in each class of lengths.
REJECT, FALSE_SHARE, CLASSES = 9.21, 0.01, (32, 64)
KINDS = ("assign", "access", "hex", "random")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches in order: start and end in code points, and the text of a group. Prefix sums go in steps of 256 matches."""
    lengths = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches

    def placed(x: Column) -> Column:
        both = F.transform(x["matches"], lambda m, i: F.length(m) + x["gaps"][i])
        last = lambda y: F.floor(F.greatest(F.size(y) - 1, F.lit(0)) / 256).cast("int")
        steps = lambda y: F.transform(F.sequence(F.lit(0), last(y)), lambda k: _sum(F.slice(y, k * 256 + 1, 256)))

        def spans(y: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                step = F.floor(i / 256).cast("int")
                start = _sum(F.slice(y["steps"], F.lit(1), step)) + _sum(F.slice(y["both"], step * 256 + 1, i - step * 256)) + x["gaps"][i]
                return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), x["values"][i].alias("value"))

            return F.transform(x["matches"], span)

        return _let(both, lambda b: _let(F.struct(b.alias("both"), steps(b).alias("steps")), spans))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    some = _let(F.struct(lengths.alias("gaps"), matches.alias("matches"), values.alias("values")), placed)
    return F.when(text.rlike(pattern), some).otherwise(none).cast("array<struct<start:int,end:int,value:string>>")


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("order"), F.lit(kind).alias("kind"), s["end"]))


def known_forms(text: Column) -> Column:
    """Spans of assignments, access keys and long hexadecimal numbers, by start and then in this order."""
    assigned = F.filter(_found(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_CHARS)
    parts = [_tagged(assigned, "assign"), _tagged(_found(text, ACCESS), "access"), _tagged(_found(text, HEX), "hex")]
    return F.array_sort(F.concat(*parts))


def _normal_tail(z: Column) -> Column:
    """Share of a normal distribution above ``z``, by the usual logistic form."""
    held = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * held + 0.07056 * held * held * held))


def _kinds(alphabet: str) -> str:
    """The kind of each letter: lower, upper, digit or mark."""
    return "".join("l" if c in LOWER else "u" if c in UPPER else "d" if c in DIGITS else "m" for c in alphabet)


def changes(alphabet: str) -> tuple[float, float]:
    """Of neighbours in a random string the share whose kinds differ, and the variance that each adds to the number of changes."""
    kinds = _kinds(alphabet)
    shares = [kinds.count(k) / len(kinds) for k in sorted(set(kinds))]
    same, thrice = (sum(p**power for p in shares) for power in (2, 3))
    return 1 - same, same * (1 - same) + 2 * (thrice - same * same)


def _encoding(value: Column) -> Column:
    """The first encoding whose form the string has: letters, their kinds, size, and what chance and ordinary words would show."""
    choice = None
    for _, form, alphabet, excess, words in reversed(ENCODINGS):
        rate, spread = changes(alphabet)
        numbers = {"size": float(len(alphabet)), "excess": excess, "rate": rate, "spread": spread, "words": words}
        own = F.struct(F.lit(alphabet).alias("letters"), F.lit(_kinds(alphabet)).alias("kinds"), *[F.lit(x).alias(c) for c, x in numbers.items()])
        choice = own if choice is None else F.when(value.rlike(form), own).otherwise(choice)
    return choice


def _battery(value: Column, encoding: Column) -> Column:
    """How likely ordinary words are to look as random as the string does; one if the tests for order reject chance.

    Chi-squared of the letters' counts, and runs of letters of one kind, each give the chance under ordinary words; both are
    combined by the product of the two. Runs and the correlation of neighbours are combined against chance by the sum of their squares.
    """
    letters, size, excess, words = (encoding[c] for c in ("letters", "size", "excess", "words"))
    n = F.length(value).cast("double")
    count = lambda c: n - F.length(F.replace(value, c, F.lit("")))
    squares = F.aggregate(F.split(letters, ""), F.lit(0.0), lambda a, c: a + F.pow(count(c), F.lit(2.0)))
    chi = squares * size / n - n
    df = size - 1
    even = (df + excess * n - chi) / F.sqrt(2 * df + 4 * excess * n)
    kinds = F.call_function("translate", value, letters, encoding["kinds"])
    turns = F.length(F.regexp_replace(kinds, r"(.)\1*", "r")) - 1.0
    mixed = (turns - words * (n - 1)) / F.sqrt(words * (1 - words) * (n - 1))
    runs = (turns - encoding["rate"] * (n - 1)) / F.sqrt(encoding["spread"] * (n - 1))
    places = F.transform(F.split(value, ""), lambda c: F.call_function("instr", letters, c).cast("double") - (size + 1) / 2)

    def correlation(v: Column) -> Column:
        total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, y: a + y)
        count = F.size(v)
        mean = total(v) / count
        squared = total(F.transform(v, lambda x: (x - mean) * (x - mean)))
        paired = total(F.zip_with(F.slice(v, F.lit(1), count - 1), F.slice(v, F.lit(2), count - 1), lambda x, y: (x - mean) * (y - mean)))
        return F.when(squared > 0, paired / squared * F.sqrt(count)).otherwise(99.0)

    serial = _let(places, correlation)
    both = _let(_normal_tail(even) * _normal_tail(mixed), lambda p: p * (1 - F.log(p)))
    return F.when(runs * runs + serial * serial > REJECT, F.lit(1.0)).otherwise(both)


def _candidates(text: Column) -> Column:
    """Strings to test: start, end, class of length, and tenths of the negative logarithm of their chance under ordinary words."""

    def judged(s: Column) -> Column:
        chance = _let(_encoding(s["value"]), lambda e: _battery(s["value"], e))
        chance = F.when(s["value"].rlike("^[0-9]+$"), 1.0).otherwise(chance)  # numbers are no keys
        stratum = sum(((F.length(s["value"]) >= least).cast("int") for least in CLASSES), F.lit(0))
        level = F.floor(-F.log10(F.greatest(chance, F.lit(1e-30))) * 10).cast("int")
        return F.struct(s["start"], s["end"], stratum.alias("stratum"), level.alias("level"))

    return F.transform(_found(text, RUN), judged)


def levels(docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """For each class of lengths the least level at which the expected share of false discoveries stays within bounds
    (step-up over all strings of all documents). One row per class, three at most; none for a class without such a level."""
    found = docs.select(F.explode(_candidates(F.coalesce(F.col(text), F.lit("")))).alias("c"))
    counted = found.groupBy("c.stratum", "c.level").agg(F.count(F.lit(1)).alias("n"))
    # At most 301 levels for each of three classes, so the sums over them are small.
    listed = counted.groupBy("stratum").agg(F.collect_list(F.struct("level", "n")).alias("all"))
    above = lambda level: F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + F.when(x["level"] >= level, x["n"]).otherwise(0))
    total = above(F.lit(-1))
    fine = F.filter("all", lambda x: F.pow(F.lit(10.0), -x["level"] / 10) * total <= false_share * above(x["level"]))
    least = F.array_min(F.transform(fine, lambda x: x["level"]))
    return listed.select("stratum", least.alias("least")).filter("least is not null")


def find_secrets(docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """``docs`` with ``base`` and ``secrets``: spans (start, order, kind, end; code points, end exclusive) of the known forms, and of these and
    the strings that the tests add. A string inside a known form isn't added again.

    A null text is empty and has no spans. Columns of ``docs`` of these names are replaced. The levels that bound false
    discoveries come from all rows, so a first pass over the same documents precedes.
    """
    columns = [c for c in docs.columns if c not in ("base", "secrets", "__tested")]
    bounds = {r["stratum"]: r["least"] for r in levels(docs, text, false_share).collect()}  # three rows at most
    whole = F.coalesce(F.col(text), F.lit(""))
    tested = docs.select(*columns, known_forms(whole).alias("base"), _candidates(whole).alias("__tested"))

    def added(b: Column, c: Column) -> Column:
        random = F.lit(False)
        for stratum, least in bounds.items():
            random = random | ((c["stratum"] == stratum) & (c["level"] >= least))
        inside = F.exists(b, lambda s: (s["start"] <= c["start"]) & (s["end"] >= c["end"]))
        return random & ~inside

    more = _tagged(F.filter("__tested", lambda c: added(F.col("base"), c)), "random")
    return tested.select(*columns, "base", F.array_sort(F.concat("base", more)).alias("secrets"))


def span_text(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", false_share: float = FALSE_SHARE) -> DataFrame:
    """``docs`` with every secret in the text replaced by a mark. Texts without secrets, null ones too, stay as they are."""
    packed = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"))
    found = find_secrets(packed, "__text", false_share)
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(F.col("__text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["done"], before, F.lit(mark))).otherwise(acc["done"]).alias("done"),
        )

    clean = F.aggregate("secrets", begin, step, lambda acc: F.concat(acc["done"], F.substring(F.col("__text"), acc["at"] + 1, F.length("__text"))))
    value = F.when(F.size("secrets") > 0, clean).otherwise(F.col("__text"))
    return found.select(*[value.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns])
