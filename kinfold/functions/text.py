"""Name and date text as Column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of a name that do not identify a person.
NAME_STOPWORDS = """al el as ash ad at ar az abu umm um bin ibn bint ben b st saint de del da di la le the of
abd abdel abdul""".split()

#: White space as Unicode has it, and the separators U+001C-U+001F.
BLANK = r"(?U)[\s\x1c-\x1f]+"


def squeeze(s: Column) -> Column:
    """Runs of white space to one space, none at the ends (the display form of a name)."""
    return F.trim(F.regexp_replace(s, BLANK, " "))


def norm_text(s: Column) -> Column:
    """Name for comparison: dashes to spaces, lower case, letters, digits and '_' only; null is ''.

    Combining marks count as punctuation, hence the explicit class instead of a
    Unicode word class.
    """
    t = F.regexp_replace(F.trim(F.regexp_replace(s, rf"^(?:{BLANK})|(?:{BLANK})$", "")), "[’‘`´]", "'")
    t = F.lower(F.regexp_replace(t, r"[‐-—−\-]+", " "))
    t = F.regexp_replace(t, r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]", " ")
    return F.coalesce(squeeze(t), F.lit(""))


def name_tokens(norm: Column) -> Column:
    """Tokens of a normalised name."""
    return F.filter(F.split(norm, " "), lambda t: t != "")


def _meaningful(tokens: Column) -> Column:
    stop = F.array(*map(F.lit, NAME_STOPWORDS))
    return F.filter(tokens, lambda t: ~F.array_contains(stop, t) & (F.length(t) >= 2))


def first_token(tokens: Column) -> Column:
    """The first token that is no stop word and has two characters; else the first; else ''."""
    return F.coalesce(F.try_element_at(_meaningful(tokens), F.lit(1)), F.try_element_at(tokens, F.lit(1)), F.lit(""))


def last_token(tokens: Column) -> Column:
    return F.coalesce(F.try_element_at(_meaningful(tokens), F.lit(-1)), F.try_element_at(tokens, F.lit(-1)), F.lit(""))


def fingerprint(tokens: Column) -> Column:
    """Sorted distinct tokens, joined by spaces."""
    return F.array_join(F.array_sort(F.array_distinct(tokens)), " ")


def sorted_tokens(s: Column) -> Column:
    """All white-space tokens, sorted and joined: the operand of the token sort ratio."""
    return F.array_join(F.array_sort(F.filter(F.split(squeeze(s), " "), lambda t: t != "")), " ")


def years(dates: Column) -> Column:
    """Sorted distinct years 1800-2099 standing as words in a list of date texts; null is empty."""
    each = F.transform(dates, lambda d: F.regexp_extract_all(d, F.lit(r"(?U)\b((?:18|19|20)\d{2})\b"), F.lit(1)))
    found = F.flatten(F.filter(each, lambda x: x.isNotNull()))
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<string>"))


def alias_set(full_name: Column, aliases: Column) -> Column:
    """Normalised names of a profile, its full name's included, without empty ones."""
    every = F.concat(F.array(norm_text(full_name)), F.coalesce(F.transform(aliases, norm_text), F.array().cast("array<string>")))
    return F.array_distinct(F.filter(every, lambda x: x != ""))


def top_aliases(aliases: Column, n: int = 6) -> Column:
    """The ``n`` longest distinct normalised aliases that identify: two tokens or ten characters; ties by order."""
    norm = F.array_distinct(F.transform(aliases, norm_text))
    kept = F.filter(norm, lambda x: (x != "") & ((F.size(F.split(x, " ")) >= 2) | (F.length(x) >= 10)))
    placed = F.transform(kept, lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("x")))
    return F.coalesce(F.transform(F.slice(F.array_sort(placed), 1, n), lambda s: s["x"]), F.array().cast("array<string>"))


def shared(a: Column, b: Column) -> Column:
    """Whether two arrays without nulls share an element; null arrays share none."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))
