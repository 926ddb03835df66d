"""Nationality texts to ISO 3166 alpha-2 codes.

The dictionary is a parameter: a table of (token, codes) rows, looked up with
case.  The default one is the reference's whole dictionary and a few names more;
others are loaded with ``load_table``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.country_table import TABLE

#: Names that the reference's dictionary lacks, each with its code.
NAMES = """Canadian CA; Hong Kong HK; Iranian IR; Italian IT; Lebanese LB; Spanish ES; Sudanese SD; Syrian SY; Росія RU"""


def default_table() -> dict[str, list[str]]:
    pairs = (x.strip().rsplit(" ", 1) for x in NAMES.split(";"))
    return _lists(TABLE) | {name: [code] for name, code in pairs}


def _lists(raw: dict) -> dict[str, list[str]]:
    return {k: [v] if isinstance(v, str) else [c for c in v or () if isinstance(c, str)] for k, v in raw.items()}


def load_table(path: str) -> dict[str, list[str]]:
    """A dictionary from JSON: token to code, list of codes, or null (no country)."""
    with open(path, encoding="utf-8") as f:
        return _lists(json.load(f))


_EMPTY = "array<string>"
SPLIT = r"(?iU)\s*(?:;|,|/|\||&|\+|\band\b)\s*"
TAIL = r"(?iU)\s*(?:-\s*NDE|-\s*Non\s*ADB\s*Member\s*Country|\(\s*as\s*at\s*(?:Dec\.?|\w+)\s*\d{4}\s*\))\s*$"


def _strip(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clean_token(s: Column) -> Column:
    """A country token without odd blanks and quotes, noise tails and closing dots."""
    t = F.regexp_replace(F.regexp_replace(s, " ", " "), "’", "'")
    t = F.regexp_replace(t, "[“”]", '"')
    t = _strip(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]+", " "))
    return _strip(F.regexp_replace(_strip(F.regexp_replace(t, TAIL, "")), r"\.+$", ""))


def table_map(table: dict[str, list[str]]) -> Column:
    """The dictionary as a map literal (for tables of bounded size, as country names are)."""
    cells = [x for k, v in sorted(table.items()) for x in (F.lit(k), F.array(*map(F.lit, v)).cast(_EMPTY))]
    return F.create_map(*cells) if cells else F.create_map().cast("map<string,array<string>>")


def _codes(token: Column, known: Column) -> Column:
    """Codes of a clean token: two letters stand for themselves; else the dictionary, twice."""
    less = _strip(F.regexp_replace(token, r"(?iU)\bRep\.?\s*of\b", ""))
    less = clean_token(_strip(F.regexp_replace(less, r"(?iU)\bRepublic\s+of\b", "")))
    found = F.coalesce(F.try_element_at(known, token), F.try_element_at(known, less), F.array().cast(_EMPTY))
    return F.when(token.rlike("^[A-Za-z]{2}$"), F.array(token)).otherwise(found)


def normalize(values: Column, table: dict[str, list[str]] | None = None, whole_first: bool = False) -> Column:
    """Distinct upper-case codes of an array of texts, in order of appearance.

    Texts are split before they are looked up, so a name with a comma or 'and' in it
    is looked up in parts; ``whole_first`` looks the whole text up before that.
    """
    known = table_map(default_table() if table is None else table)
    raw = F.filter(F.transform(values, _strip), lambda s: s.isNotNull() & (s != "") & ~F.lower(s).isin("nan", "none", "null"))

    def of(s: Column) -> Column:
        tokens = F.filter(F.transform(F.split(s, SPLIT), clean_token), lambda t: t != "")
        parts = F.flatten(F.transform(tokens, lambda t: _codes(t, known)))
        if whole_first:
            parts = F.coalesce(F.try_element_at(known, clean_token(s)), parts)
        return F.when(s.rlike("^[A-Za-z]{2}$"), F.array(s)).otherwise(parts)

    codes = F.flatten(F.transform(raw, of))
    upper = F.filter(F.transform(codes, lambda c: F.upper(F.trim(c))), lambda c: c != "")
    return F.coalesce(F.array_distinct(upper), F.array().cast(_EMPTY))
