"""URL filter: host word segmentation and multinomial naive Bayes (operator 10).

Host labels and path segments are split at non-alphanumerics, and each name is
then segmented by unigram Viterbi: the word costs come from counts over the paths
of all URLs (host names are what is to be split) and a small dictionary, unknown
words pay by length.  Words of the Viterbi search have up to ``LONGEST`` letters;
a longer name may also stay whole.

A multinomial naive Bayes over the segmented host and path tokens gives the verdict.
It is fitted on labelled names (``EXAMPLES``), and then once more on these and all
URLs, each labelled by the first fit, so tokens that go with such names are learnt
from the corpus.  Labels belong to whole names; no word decides alone, and a word
that names of both kinds hold tells little.

Both count tables are exact: one row per word, held as sorted 64-bit fingerprints
that each look-up compares, so a word that was not counted never gets another's
count.  What can be told without a row is left out: words counted once are not
words, and a token of the table without a row stood once, in an allowed URL.

Rules (host, path, verdict) come before the model: a rule fits its host and all
subdomains when the URL's path starts with the rule's; the longest rule wins.

Defined results: a null URL, or one without "://", has an empty host and path,
no rule, and the verdict of the model without tokens; repeated rows are judged
each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import saved

#: Cells of counts that are given as an array, for small vocabularies.
BUCKETS = 1 << 16
LONGEST = 24
MEMO = 200_000
#: Unknown words: cost of a first character and of each further one, in nats.
UNKNOWN, UNKNOWN_MORE = 12.0, 1.8
#: Cost of each word, so that scraps of unknown names are not taken for words.
SEGMENT = 4.0
#: What a dictionary word counts without being seen: so much, or this share of all counted words.
PRIOR, PRIOR_SHARE = 10.0, 1e-3
#: Smoothing of naive Bayes counts.
ALPHA = 0.1

#: How often each labelled name counts beside the corpus.
EXAMPLE_WEIGHT = 20

#: Words that names are made of, for the segmentation alone.
DICTIONARY = """ad ads adult adserver banner bet bets betting bingo bonus buy cash casino cheap click clicks coupon crack cracked
crypto cryptography dating deal deals debt doubleclick escort farm free gamble gambling jackpot hack hookup keygen lender loan loans lottery lotto malware miracle naked nsfw nude payday
phish phishing pill pills poker porn pharma pharmacy popup promo replica scam sex slots spam spyware swindle torrent track
tracker tracking tracks viagra warez win winner xxx about article articles archive blog book books city college community data docs
editor example forum garden gazette guide health help history home info journal kitchen law library list mail map media medical member
museum music nature network news notes open page pages paper photo post press project public radio recipe recipes review school science
search shop society sport sports stories story student study support teacher team times today travel university user video
watch weather web wiki work world www online store best link links center club service hotel market farmers""".split()
#: Names that a filter blocks and names that it lets pass, as examples to learn from.
EXAMPLES = (
    """adserver adbanner adsclick adstrack adstracker banneradserver clicktracks doubleclickads popupads adultvideo adultx adultdating
    bingobonus betsonline bestbets bettingbonus freebets sportsbets casinobonus casinowin onlinecasino casinoslots winjackpot lottowin lotterywinner cashwin
    cheappills pillsonline cheapviagra viagrapharmacy buypills pharmadeals miraclepills replicawatch cheapreplica couponscam cashloans
    paydayloan paydayloans debtlender fastcashloan freepoker pokercash pokerbonus gamblingcash jackpotslots nakedescort nudedating
    nsfwxxx pornvideo freeporn sexhookup sexdating xxxporn escortclub hookupnsfw crackedkeygen keygenwarez freewarez torrentcrack warezcrack hackcrack
    malwarespyware spywarepopup phishingscam phishmail scamspam spamfarm linkfarm spamlinks swindlescam cryptoscam cryptobonus spamtracker""".split(),
    """cityschool citylibrary dailynews newsarchive worldnews newsjournal pressgazette weathertoday sportsnews sportsteam worldsports
    musicradio radiostories historymuseum sciencejournal naturephoto gardenguide kitchenrecipes recipebook bookreview booksonline studenthelp teacherguide
    universitypress collegewiki healthinfo medicaljournal lawlibrary publicmedia openproject opendata datadocs webforum userforum userguide
    communitynotes societypages travelmap travelguide hotelreview familyhistory homegarden homepage workmail maillist webmail searchhelp supportdocs
    freelibrary freeschool farmnews farmersmarket trackandfield winterwatch watchstore winnerstories bookshop photoshop videoarchive studyguide
    editorblog articlearchive memberlist postnotes timesarchive paperarchive eventguide networkwiki cryptography mobilesite wwwexample exampleblog""".split(),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("`__url`")))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct (size, rule, verdict), or null; a map lookup per domain suffix."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    by: dict[str, list] = {}
    for h, p, v in rules:
        by.setdefault(h, []).append(F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(p).alias("path")))
    table = F.create_map(*[x for h, found in by.items() for x in (F.lit(h), F.array(*found))])
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull()))
    best = F.array_max(F.filter(found, lambda r: F.startswith(path, r["path"])))
    return F.when(best.isNotNull(), F.struct(best["size"].alias("size"), best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def fingerprints(found: list[str]) -> np.ndarray:
    """64-bit fingerprints of words."""
    return np.frombuffer(b"".join(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in found), np.int64)


class Words:
    """Counts by word: sorted fingerprints, one row of counts each, and the total of all words."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: float):
        order = np.argsort(keys)
        self.keys, self.counts, self.total = keys[order], counts[order], float(total)

    @classmethod
    def of_cells(cls, cells: np.ndarray) -> Words:
        """Counts hashed into ``BUCKETS`` cells, for small vocabularies."""
        got = cls(np.arange(len(cells)), cells, cells.sum())
        got.key_of = lambda found: np.array([bucket(w) for w in found], np.int64)
        return got

    key_of = staticmethod(fingerprints)

    def find(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(whether a word has a row, its place)."""
        if not len(self.keys) or not found:
            return np.zeros(len(found), bool), np.zeros(len(found), np.int64)
        keys = self.key_of(found)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at

    def of(self, found: list[str]) -> np.ndarray:
        """Counts of words, 0 without a row."""
        has, at = self.find(found)
        return np.where(has, self.counts[at], 0) if len(self.keys) else np.zeros(len(found))


def names(text: str) -> list[str]:
    """Runs of letters, runs of digits as one token, and hyphens, in lower case."""
    return ["0" if x[0].isdigit() else x for x in re.findall(r"\d+|[^\W\d_]+|-+", text.lower())]


class Segmenter:
    """Unigram Viterbi over counts by word and a dictionary."""

    def __init__(self, counts: Words | np.ndarray, dictionary: list[str]):
        self.counts = Words.of_cells(counts) if isinstance(counts, np.ndarray) else counts
        prior = max(PRIOR, PRIOR_SHARE * self.counts.total)
        self.log_total = math.log(self.counts.total + prior * len(dictionary) + 1.0)
        self.words = {w: min(self.log_total - math.log(prior + n), UNKNOWN) for w, n in zip(dictionary, self.counts.of(dictionary))}
        self.memo: dict[str, list[str]] = {}

    def costs(self, found: list[str]) -> list[float]:
        counts = self.counts.of(found)
        seen = np.where(counts > 1, self.log_total - np.log(np.maximum(counts, 1)), np.inf)
        return [min(c, self.words.get(w, math.inf), UNKNOWN + UNKNOWN_MORE * (len(w) - 1)) + SEGMENT for w, c in zip(found, seen.tolist())]

    def split(self, name: str) -> list[str]:
        got = self.memo.get(name)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[name] = self._split(name)
        return got

    def _split(self, name: str) -> list[str]:
        best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            first = max(0, end - LONGEST)
            for at, cost in enumerate(self.costs([name[k:end] for k in range(first, end)]), first):
                c = best[at] + cost
                if c < best[end]:
                    best[end], back[end] = c, at
        if len(name) > LONGEST and self.costs([name])[0] <= best[-1]:
            return [name]
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        return [f"h:{w}" for n in names(host) for w in self.split(n)] + [f"p:{w}" for n in names(path) for w in self.split(n)]


def example_counts(segmenter: Segmenter) -> dict[str, list[float]]:
    """(allowed, blocked) counts of the host tokens of the labelled names."""
    out: dict[str, list[float]] = {}
    for y, found in ((1, EXAMPLES[0]), (0, EXAMPLES[1])):
        for name in found:
            for t in segmenter.split(name):
                out.setdefault(f"h:{t}", [0.0, 0.0])[y] += EXAMPLE_WEIGHT
    return out


class UrlModel:
    """Segmenter and naive Bayes; ``blocked(host, path)`` is the posterior of the blocked class.

    ``classes`` has the counts (allowed, blocked) of tokens, those that stood once
    and in an allowed URL left out unless a labelled name has them; ``sums`` the
    tokens of each class and the distinct ones, ``docs`` the URLs of each class.
    Without them the model knows the labelled names alone.
    """

    def __init__(self, counts: Words | np.ndarray, classes: Words | None = None, sums: tuple[float, float, int] = (0, 0, 0), docs: tuple[int, int] = (0, 0)):
        self.segmenter = Segmenter(counts, DICTIONARY)
        corpus = classes is not None
        if classes is None:
            classes = Words(np.zeros(0, np.int64), np.zeros((0, 2)), 0)
        examples = example_counts(self.segmenter)
        more = np.array(list(examples.values()))
        has, at = classes.find(list(examples))
        n = classes.counts.astype(float).reshape(-1, 2)
        n[at[has]] += more[has]
        keys = np.concatenate([classes.keys, fingerprints([w for w, h in zip(examples, has) if not h])])
        n = np.concatenate([n, more[~has]])
        seen = sums[2] + int((~has).sum())
        size = np.array(sums[:2], float) + more.sum(axis=0)
        base = np.log(size + ALPHA * max(seen, 1))
        like = np.log(n + ALPHA) - base
        # a token without a row: it stood once, in an allowed URL, or, without a corpus, never
        once = np.log(np.array([1 + ALPHA if corpus else ALPHA, ALPHA])) - base
        self.once = float(once[1] - once[0])
        self.classes = Words(keys, like[:, 1] - like[:, 0], 0)
        self.bias = math.log(docs[1] + EXAMPLE_WEIGHT) - math.log(docs[0] + EXAMPLE_WEIGHT)

    def blocked(self, host: str, path: str) -> float:
        """The posterior of a URL of the table that the model is fitted on; the host's tokens alone without a corpus."""
        return self.posterior(self.segmenter.tokens(host, path))

    def posterior(self, tokens: list[str]) -> float:
        x = self.bias
        if tokens:
            has, at = self.classes.find(tokens)
            x += float(np.where(has, self.classes.counts[at], self.once).sum())
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, x))))


def _arrays(df: DataFrame) -> list[np.ndarray]:
    table = df.toArrow()
    return [table.column(i).to_numpy() for i in range(table.num_columns)]


def fit(parts: DataFrame) -> UrlModel:
    """The model of a table (host, path): two passes of counting over all rows."""

    def cells(batches):
        for pdf in batches:
            found = Counter(n for p in pdf["path"] for n in names(p))
            yield pd.DataFrame({"key": fingerprints(list(found)), "n": np.array(list(found.values()), np.int64)})

    table = saved(parts.mapInPandas(cells, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    counts = Words(*_arrays(table.where("n > 1").select("key", "n")), total)
    first = UrlModel(counts)
    known = example_counts(first.segmenter)  # what no labelled name has tells the first fit nothing

    def labelled(batches):
        for pdf in batches:
            found: tuple[Counter, Counter] = Counter(), Counter()
            docs = [0, 0]
            for h, p in zip(pdf["host"], pdf["path"]):
                tokens = first.segmenter.tokens(h, p)
                y = int(first.posterior([t for t in tokens if t in known]) > 0.5)
                docs[y] += 1
                found[y].update(tokens)
            every = list(found[0].keys() | found[1].keys())
            yield pd.DataFrame({"kind": 0, "key": fingerprints(every), "n0": [found[0][w] for w in every], "n1": [found[1][w] for w in every]})
            yield pd.DataFrame({"kind": [1], "key": [0], "n0": [docs[0]], "n1": [docs[1]]})

    table = saved(parts.mapInPandas(labelled, "kind int, key long, n0 long, n1 long").groupBy("kind", "key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    sums = {r["kind"]: r for r in table.groupBy("kind").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count("*").alias("n")).collect()}
    kept = (F.col("n0") != 1) | (F.col("n1") != 0) | F.col("key").isin(fingerprints(list(known)).tolist())
    key, n0, n1 = _arrays(table.where("kind = 0").where(kept).select("key", "n0", "n1"))
    tokens = (sums[0]["n0"], sums[0]["n1"], sums[0]["n"]) if 0 in sums else (0, 0, 0)
    docs = (sums[1]["n0"], sums[1]["n1"]) if 1 in sums else (0, 0)
    return UrlModel(counts, Words(key, np.stack([n0, n1], axis=1), 0), tokens, docs)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, blocked): rules first, else naive Bayes; no shuffle of rows."""
    host, path = url_parts(F.col("__url"))
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("__url")).select("id", host.alias("host"), path.alias("path"))
    net = fit(parts)

    def score(batches):
        for pdf in batches:
            yield pdf.assign(blocked=[net.blocked(h, p) for h, p in zip(pdf["host"], pdf["path"])])

    kind = dict(parts.dtypes)["id"]
    got = parts.mapInPandas(score, f"id {kind}, host string, path string, blocked double")
    got = got.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("blocked") >= threshold, "block").otherwise("allow"))
    return got.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "blocked")
