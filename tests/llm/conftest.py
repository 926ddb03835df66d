import random

import pytest

#: Columns that clash with names the operators use inside.
CLASH = "id, row, n, key, keys, sig, kept, ids, sequence_id, start, spans, component, n_bytes"


def words(rnd, n):
    return [rnd.choice(["the", "of", "and"]) if rnd.random() < 0.3 else "".join(rnd.choice(["an", "the", "ou", "re", "st", "on", "é"]) for _ in range(rnd.randrange(1, 5))) for _ in range(n)]


def make_texts():
    """Texts with nulls, empty ones, copies, near copies, shared passages, a very long one and odd characters."""
    rnd = random.Random(11)
    texts = [" ".join(words(rnd, rnd.randrange(1, 200))) for _ in range(40)]
    long = " ".join(words(rnd, 20_000))
    passage = " ".join(words(rnd, 60))
    near = words(rnd, 120)
    texts += [None, "", " ", "\n\t", "one", "One", "two words", "TWO  words", long, long[:5000]]
    texts += [texts[3]] * 4 + [f"{texts[i]} {passage} {texts[i + 1]}" for i in range(8)] + [passage, passage + passage]
    for i in range(8):
        w = list(near)
        w[i * 9] = "changed"
        texts.append(" ".join(w))
    texts += ["a" * 700, "ab" * 400, "<|endoftext|> x", "x <|endoftext|>y <|startoftext|>", "tab\tand  two   three\n\n four ", "İstanbul ΣΑΣ ﬁ café cafe\u0301 日本語 \u00a0nbsp\u3000wide", "it's we'll don''t 's 12 345 6.7%%%&&&", "\x1cctrl\x00 nul"]
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with columns whose names clash, over several partitions."""
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3, "doc_id")
    extra = ", ".join(f"'x' as {c.strip()}" for c in CLASH.split(","))
    return df.selectExpr("*", *extra.split(", "))


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
