"""Names of companies and creditors, as column expressions."""

from __future__ import annotations

import functools
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and labels that are no creditor's name.
JUNK_WORDS = ("contact", "contacts", "name", "address", "amount", "claim", "creditor", "creditors", "total")
JUNK_HEADS = (
    "list of creditors", "creditor matrix", "creditors holding", "official form 204", "20 largest unsecured", "name of creditor",
    r"creditor\s*name",
)
JUNK_LABELS = (
    "mailing address", "email address", "name of creditor", "including zip", "zip code", "nature of claim", "account number",
    "official form", r"form\s*204", "list of creditors", "creditor matrix", "claim amount",
)

# What ends companies' names, and what joins the names of two people.
COMPANY_SUFFIX = r"(?i)\b(llc|l\.l\.c\.|inc\.?|corp\.?|corporation|ltd\.?|lp|llp|co\.)\b"
JOINT_NAME = r"(?i)(\band\b|&)"

# Our own default rules: (kind, pattern, replacement), in order.
NAME_RULES = (
    ("token_replace", r"\s+&\s+", " and "),
    ("suffix_strip", r",?\s+(inc|llc|corp|ltd)\.?$", ""),
    ("alias", "IBM", "International Business Machines"),
)


def is_junk_name(name: Column, least_length: int = 3, most_digits: int = 3, whole_heads: bool = False) -> Column:
    """Whether a name is a label, a heading or a line number. Null for null. ``whole_heads``: a heading ends with its last word."""
    shown = F.trim(name)
    low = F.lower(shown)
    return (
        (F.length(shown) < max(1, least_length))
        | low.isin(*JUNK_WORDS)
        | low.rlike(f"^({'|'.join(JUNK_HEADS)})" + (r"\b" if whole_heads else ""))
        | low.rlike(f"({'|'.join(JUNK_LABELS)})")
        | shown.rlike(f"^[0-9]{{1,{most_digits}}}$")
    )


@functools.lru_cache(maxsize=4)
def _automaton(words: tuple[str, ...]):
    import ahocorasick

    made = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for word in words:
        made.add_word(word)
    made.make_automaton()
    return made


def _holds_one_of(words: tuple[str, ...]):
    @F.pandas_udf("boolean")
    def search(texts: pd.Series) -> pd.Series:
        find = _automaton(words).iter
        return pd.Series([text is not None and next(find(text), None) is not None for text in texts], dtype=bool)

    return search


def holds_any(text: Column, words: Iterable[str], few: int = 64) -> Column:
    """Whether ``text`` holds one of ``words``, whatever the case. False for null; an empty word is in every text.

    Up to ``few`` words are as many comparisons in built-in functions. More become one automaton (Aho and Corasick, 1975),
    which reads each text once however many words there are.
    """
    words = tuple(dict.fromkeys(w.lower() for w in words))
    if "" in words:
        return text.isNotNull()
    if len(words) > few:
        return F.coalesce(_holds_one_of(words)(F.lower(text)), F.lit(False))
    out = F.lit(False)
    for word in words:
        out = out | F.contains(F.lower(text), F.lit(word))
    return F.coalesce(out, F.lit(False))


def company_name(name: Column, rules: Iterable[tuple[str, str, str]] = NAME_RULES, most: int = 500) -> Column:
    """A comparable form of a name's first ``most`` characters: rules in order, then only word characters, upper case, single blanks."""
    out = F.left(F.coalesce(F.trim(name), F.lit("")), F.lit(most))
    for kind, pattern, replacement in rules:
        if kind == "alias":
            out = F.when(F.upper(out) == pattern.upper(), F.lit(replacement)).otherwise(out)
        else:
            out = F.regexp_replace(out, f"(?i){pattern}", replacement)
    return F.trim(F.regexp_replace(F.upper(F.regexp_replace(out, r"[^\w\s]", " ")), r"\s+", " "))


def company_key(name: Column, address: Column, rules: Iterable[tuple[str, str, str]] = NAME_RULES) -> Column:
    place = F.upper(F.trim(F.regexp_replace(F.coalesce(address, F.lit("")), r"\s+", " ")))
    return F.md5(F.concat(company_name(name, rules), F.lit("|"), place))


def entity_type(name: Column) -> Column:
    """Company by suffix; individual for joint names of three words or two capitalised words; else company."""
    parts = F.split(F.trim(name), r"\s+")
    return (
        F.when(name.rlike(COMPANY_SUFFIX), "company")
        .when(name.rlike(JOINT_NAME) & (F.size(parts) >= 3), "individual")
        .when((F.size(parts) >= 2) & F.get(parts, F.lit(0)).rlike("^[A-Z]") & F.get(parts, F.lit(1)).rlike("^[A-Z]"), "individual")
        .otherwise("company")
    )


def dedup_key(name: Column, address: Column) -> Column:
    """Name and address in lower case without marks, joined by a blank."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))
    return F.trim(F.concat_ws(" ", plain(name), plain(address)))


def shown_name(original: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(original), F.lit("")), name)
