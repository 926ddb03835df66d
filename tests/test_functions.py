"""Text, country, phonetic and similarity functions on small tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kinfold.functions import country as C
from kinfold.functions import text as T
from kinfold.functions.phonetic import double_metaphone
from kinfold.functions.similarity import lcs_length, token_sort_ratio, with_ratio


def one(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("x"), "i").orderBy("i").select("x").collect()]


def test_norm_text(spark):
    given = [None, "", "  O’Connor–Smith ", "A_b c-d", "क्या اَب", "İx", "x y\x1cz", "..!", "MIXED  Case"]
    assert one(spark, given, T.norm_text) == ["", "", "o connor smith", "a_b c d", "क य ا ب", "i x", "x y z", "", "mixed case"]


def test_tokens(spark):
    norm = ["al bin saleh", "b x", "of", "", "the john de smith"]
    assert one(spark, norm, lambda c: T.first_token(T.name_tokens(c))) == ["saleh", "b", "of", "", "john"]
    assert one(spark, norm, lambda c: T.last_token(T.name_tokens(c))) == ["saleh", "x", "of", "", "smith"]
    assert one(spark, ["b a b", ""], lambda c: T.fingerprint(T.name_tokens(c))) == ["a b", ""]


def test_years(spark):
    given = [["1970-01-02", "2001/1850"], ["19700101", "c1980", "1999_"], [None, "1970"], None, []]
    assert one(spark, given, T.years, "array<string>") == [["1850", "1970", "2001"], [], ["1970"], [], []]


def test_aliases(spark):
    rows = [["B C", "Longer Name", "short", "tenletters", "b  c", None, "a1 x", "a2 xx", "a3 xxx", "a4 xxxx"]]
    assert one(spark, rows, T.top_aliases, "array<string>") == [["longer name", "tenletters", "a4 xxxx", "a3 xxx", "a2 xx", "a1 x"]]
    assert one(spark, [None], T.top_aliases, "array<string>") == [[]]


@pytest.mark.parametrize(
    "value, codes",
    [
        (["UK"], ["UK"]),
        (["pk", "PK"], ["PK"]),
        (["Pakistan; Iraq/France"], ["PK", "IQ", "FR"]),
        (["Hong Kong, China"], ["HK", "CN"]),
        (["Germany (as at Dec 2019)"], ["DE"]),
        (["Argentina - Non ADB Member Country"], ["AR"]),
        (["Azerbaijan Rep. of"], ["AZ"]),
        (["pakistan"], []),
        (["nan", " ", "None", None], []),
        (None, []),
    ],
)
def test_country(spark, value, codes):
    assert one(spark, [value], C.normalize, "array<string>") == [codes]


def test_country_default_covers_the_reference(spark):
    """All 458 keys, each against a plain form of the reference's rules."""
    table = C.default_table()

    def clean(s):
        s = re.sub(r"\s+", " ", s.replace("\u00a0", " ").replace("’", "'").replace("“", '"').replace("”", '"')).strip()
        s = re.sub(r"\s*(-\s*NDE|-\s*Non\s*ADB\s*Member\s*Country|\(\s*as\s*at\s*(Dec\.?|\w+)\s*\d{4}\s*\))\s*$", "", s, flags=re.I).strip()
        return re.sub(r"\.+$", "", s).strip()

    def codes(text):
        if re.fullmatch("[A-Za-z]{2}", text.strip()):
            return [text.strip().upper()]
        out = []
        for token in filter(None, map(clean, re.split(r"\s*(?:;|,|/|\||&|\+|\band\b)\s*", text.strip(), flags=re.I))):
            less = clean(re.sub(r"\bRepublic\s+of\b", "", re.sub(r"\bRep\.?\s*of\b", "", token, flags=re.I).strip(), flags=re.I).strip())
            out += [token.upper()] if re.fullmatch("[A-Za-z]{2}", token) else table.get(token) or table.get(less) or []
        return list(dict.fromkeys(out))

    assert len(table) == 458 + 9 and {"BA", "CD", "CZ", "KP", "KR", "LU", "ME", "MK", "MN", "MZ", "NZ", "PY", "TM", "TW", "UY", "XK"} <= {c for v in table.values() for c in v}
    assert table["Afghanistan, Pakistan"] == ["AF", "PK"] and table["Hamas Terrorist Attacks"] == []
    keys = sorted(table)
    assert one(spark, [[k] for k in keys], C.normalize, "array<string>") == [codes(k) for k in keys]


def test_country_table_is_a_parameter(spark):
    table = {"Bosnia and Herzegovina": ["BA"], "Both": ["AA", "BB"], "No one": []}
    assert one(spark, [["Both", "No one", "Bosnia and Herzegovina"]], lambda c: C.normalize(c, table), "array<string>") == [["AA", "BB"]]
    assert one(spark, [["Bosnia and Herzegovina"]], lambda c: C.normalize(c, table, whole_first=True), "array<string>") == [["BA"]]


def test_double_metaphone():
    known = {"smith": "SM0", "schmidt": "XMT", "thomas": "TMS", "michael": "MKL", "knight": "NT", "wright": "RT", "caesar": "SSR", "ghost": "KST", "judge": "JJ", "philip": "FLP", "xavier": "SF", "": "", "محمد": "", "josé": "HS"}
    assert {w: double_metaphone(w) for w in known} == known


def lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_and_ratio(spark):
    rnd = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc ") for _ in range(rnd.randrange(12))) for _ in "ab")
        assert lcs_length(a, b) == lcs_table(a, b)
        assert token_sort_ratio(a, b) == token_sort_ratio(b, a)
    assert token_sort_ratio("", "") == 100 and token_sort_ratio("b a", "a b") == 100
    pairs = [("abcd", "abcd"), ("abcdefghij", "abcdefghi"), ("abc", "xyz"), ("", ""), ("", "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    full = {(r.a, r.b): r.s for r in with_ratio(df, "a", "b", "s").collect()}
    assert full == {p: token_sort_ratio(*p) for p in pairs}
    kept = {(r.a, r.b): r.s for r in with_ratio(df, "a", "b", "s", 90).collect()}
    assert kept == {p: s for p, s in full.items() if s >= 90}
