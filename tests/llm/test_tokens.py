"""Operators 2, 3 and 6 against the tokenizers library."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from kinfold.llm.bpe import StreamDecoder, encode_decode, model
from kinfold.llm.chunkenc import ChunkEncoder
from kinfold.llm.packing import cost, pack, pack_documents
from kinfold.llm.wavelet import WaveletFile, build, encode_to_shards

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def library(path, texts):
    t = Tokenizer.from_file(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_give_the_librarys_ids(path, texts):
    from kinfold.llm.textbuf import text_column

    import pyarrow as pa

    buf, off = text_column(pa.array(texts))
    got = []
    for _, ids, ends in ChunkEncoder(path, limit=100_000).encode(buf, off):
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert got == library(path, texts)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_of_one_key(path, texts, monkeypatch):
    """Chunks whose keys collide are told apart by their bytes."""
    import pyarrow as pa

    from kinfold.llm import textbuf

    monkeypatch.setattr(textbuf.Words, "keys", lambda self, start, end: (end - start).astype(np.uint64) % np.uint64(3))
    buf, off = textbuf.text_column(pa.array(texts))
    got = []
    for _, ids, ends in ChunkEncoder(path).encode(buf, off):
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert got == library(path, texts)


def test_wavelet_file():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 7, 1000, 70_000):
        ids = rnd.integers(0, 50_257, n).astype(np.uint16)
        if n > 10:
            ids[::3] = 17
        f = WaveletFile(build(np.array([5]), np.array([n]), ids))
        assert (f.decode() == ids).all() and f.doc_ids.tolist() == [5]
        for i in rnd.integers(0, n, 5).tolist() if n else []:
            assert f.access(i) == ids[i] and f.rank(17, i) == int((ids[:i] == 17).sum())
        where = np.flatnonzero(ids == 17).tolist()
        assert f.count(17) == len(where) and f.select(17, len(where)) == -1
        for k in range(0, len(where), max(1, len(where) // 4)):
            assert f.select(17, k) == where[k]


def test_shards(docs, no_docs, texts):
    got = sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in encode_to_shards(docs, BYTE, 2, shard_tokens=3000).collect())
    want, at = [], 0
    for i, ids in enumerate(library(BYTE, texts)):
        ids = [*ids, 2]
        want.append((i, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
    assert encode_to_shards(no_docs, BYTE).count() == 0


def test_transducer(docs, no_docs, texts):
    t = Tokenizer.from_file(WORD)
    want = library(WORD, texts)
    got = {r.doc_id: r for r in encode_decode(docs, WORD).collect()}
    for i, ids in enumerate(want):
        assert got[i].ids == " ".join(map(str, ids)) and got[i].n_tokens == len(ids)
        assert got[i].decoded == t.decode(ids, skip_special_tokens=False)
    assert encode_decode(no_docs, WORD).count() == 0


def test_transducer_streams_in_bounded_memory():
    net = model(WORD).transducer
    rnd = random.Random(4)
    chains = [u + v for u, v in list(net.rank)[-400:]]
    plain = {p: b for b, p in enumerate(net.plain)}
    texts = ["a" * 6000, "thetheirthere" * 600, "ababac" * 1000, "".join(rnd.choice("aeinrst") for _ in range(6000))]
    texts += ["".join(chr(plain[c]) for c in "".join(rnd.choices(chains, k=900)) if plain.get(c, 0) in range(97, 123)) for _ in range(4)]
    for text in texts:
        symbols = [net.plain[b] for b in text[:-1].encode()] + [net.last[ord(text[-1])]]
        held, fed, size, out = 0, 0, 0, []

        def feed():
            nonlocal fed, held
            for c in symbols:
                fed += 1
                held = max(held, fed - size)  # symbols read whose tokens are not emitted
                yield c

        for token in net.stream(feed()):
            out.append(net.tokens[token])
            size += len(token)
        assert out == Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids
        assert held <= 2 * net.lookahead + 2 * net.longest


def test_decoder_machine():
    names = model(WORD).names
    ids = library(WORD, ["café 日本 it's"])[0]
    d = StreamDecoder(names)
    assert ("".join(map(d.feed, ids)) + d.close()).split() == ["café", "日本", "it", "'s"]
    joined = StreamDecoder(names, joined=True)
    assert "".join(map(joined.feed, ids)) == Tokenizer.from_file(WORD).decode(ids, skip_special_tokens=False)


def test_pack_fills_and_balances():
    lengths = [5, 90, 40, 33, 60, 70, 12, 88, 2]
    placed = pack(lengths, 100, 4)
    assert sum(lengths) == 400
    by, seq = defaultdict(list), defaultdict(int)
    for i, at, n, s in placed:
        by[i].append((at, n))
        seq[s] += n
    assert all(seq[s] == 100 for s in range(4))
    assert all(sorted(p)[0][0] == 0 and sum(n for _, n in p) == lengths[i] for i, p in by.items())
    assert cost(2, 1, 1) == 6


def test_packing(docs, no_docs, texts):
    got = pack_documents(docs, WORD, end_id=2, room=256, group_tokens=2048).collect()
    by, seq = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    for i, ids in enumerate(library(WORD, texts)):
        ids, at = [*ids, 2], 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    short = 0
    for rows in seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
        short += at < 256
    assert short <= docs.rdd.getNumPartitions()
    assert pack_documents(no_docs, WORD).count() == 0


def colliding_words():
    """Two words of 1,024 letters that collide for every base modulo 2^64 (the Thue-Morse sequence and its complement)."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_colliding_words_and_null_ids(spark):
    one, two = colliding_words()
    texts = [one, two, f"x {two} y", f"x {one} y", None]
    df = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    at = {i if i != 3 else None: k for k, i in enumerate(range(5))}
    byte, word = library(BYTE, texts), library(WORD, texts)
    got = {r.doc_id: r for r in encode_to_shards(df, BYTE, 2).collect()}
    assert {i: np.frombuffer(r.ids, "<u4").tolist() for i, r in got.items()} == {i: [*byte[k], 2] for i, k in at.items()}
    assert got[None].start == 0
    assert {r.doc_id: r.ids for r in encode_decode(df, WORD).collect()} == {i: " ".join(map(str, word[k])) for i, k in at.items()}
    packed = defaultdict(dict)
    for r in pack_documents(df, WORD, end_id=2).collect():
        packed[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
    assert {i: sum((p[s] for s in sorted(p)), []) for i, p in packed.items()} == {i: [*word[k], 2] for i, k in at.items()}


def test_wavelet_reads_one_block_a_level():
    ids = np.random.default_rng(3).integers(0, 50_000, 1 << 19).astype(np.uint16)
    ids[ids == 4] = 5
    ids[::7] = 4
    data = build(np.array([1]), np.array([len(ids)]), ids)
    for ask, blocks, want in ((lambda f: f.access(300_001), 16, ids[300_001]), (lambda f: f.rank(4, 400_000), 32, (ids[:400_000] == 4).sum()), (lambda f: f.select(4, 5000), 48, 35_000)):
        f = WaveletFile(data)
        assert len(f.planes[0].ends) - 1 == 16 and ask(f) == want and f.reads <= blocks
