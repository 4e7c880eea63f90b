"""Headline extraction as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

WORD = r"\p{L}\p{N}_"
_WORD = f"[{WORD}]"
_CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, rf"^{_SPACE}+|{_SPACE}+$", "")


def tag_title(text: Column, tag: str = "PAGE_TITLE") -> Column:
    """Trimmed content of the first ``<tag>`` pair on one line.

    NULL without such a pair; an empty pair gives ``''``.
    """
    pattern = f"(?d)<{re.escape(tag)}>(.*?)</{re.escape(tag)}>"
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def title_case(text: Column) -> Column:
    """Capital after every non-letter, lower case elsewhere."""
    runs = F.regexp_extract_all(text, F.lit(f"({_CASED}+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def url_title(url: Column) -> Column:
    """Readable title from the last URL segment; ``''`` where there is none."""
    slug = F.regexp_extract(F.btrim(url, F.lit("/")), r"([^/]+)(?:\.html|\?|$)", 1)
    words = F.translate(F.regexp_replace(slug, r"\p{Nd}+", ""), "-_+", "   ")
    return F.coalesce(title_case(strip(words)), F.lit(""))


def headline(extras: Column, url: Column, tag: str = "PAGE_TITLE") -> Column:
    """Tagged title if the tag is there, else the URL title."""
    return F.coalesce(tag_title(extras, tag), url_title(url))


def any_of_pattern(words: list[str], whole_word: bool = False) -> str:
    """Case-insensitive alternation of literal words; whole words end at anything but letters, digits and ``_``."""
    body = "|".join(re.escape(w) for w in words)
    return f"(?i)(?<!{_WORD})(?:{body})(?!{_WORD})" if whole_word else f"(?i)(?:{body})"


def prompt(text: Column, aspect: Column, instruction: str, delimiter: str, ending: str) -> Column:
    """Instruction, text and aspect joined into one scoring prompt."""
    return F.concat(F.lit(instruction), text, F.lit(delimiter), aspect, F.lit(ending))
