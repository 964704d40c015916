"""Text, unit and code normalization."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What label cleaning replaces, applied in this order.
LABEL_RULES = [
    (r"\[[^\]]*\]", ""),
    (r"\([^)]*\)", ""),
    (r"\s+", " "),
]

# What title normalization replaces, applied in this order. The first is the set
# [^\w\s<>+] written as an intersection, which the regex engine tests several times faster.
TITLE_RULES = [
    (r"[\W&&[^\s<>+]]", ""),
    (r"\s+", " "),
]


def _replace_all(text: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), rules, text)


def clean_text(text: Column) -> Column:
    """Drop ``[...]`` and ``(...)`` notes, collapse whitespace, trim, lower.

    Nested notes are not followed: ``a[b[c]d]e`` becomes ``ad]e``. A text that is one note
    becomes an empty string; NULL stays NULL.
    """
    return F.lower(F.trim(_replace_all(text, LABEL_RULES)))


def normalize_title(title: Column) -> Column:
    """Lower, trim, keep only ASCII word characters, whitespace and ``< > +``, collapse whitespace.

    Trimming comes first, so a stripped leading mark may leave one leading space.
    """
    return _replace_all(F.trim(F.lower(title)), TITLE_RULES)


def upper_trim(text: Column) -> Column:
    """Unit, route and drug-name form: spaces trimmed, upper case."""
    return F.upper(F.trim(text))


def remap(code: Column, changes: Mapping[str, str]) -> Column:
    """Replace listed codes, leave all others (and NULL) as they are; the result is text."""
    text = code.cast("string")
    out = text
    for old, new in changes.items():
        out = F.when(text == F.lit(old), F.lit(new)).otherwise(out)
    return out
