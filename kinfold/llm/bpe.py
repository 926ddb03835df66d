"""BPE encoding and decoding as streaming transducers (operator 3).

Encoding follows the formal view of BPE as a string transduction with bounded
lookahead (Berglund and van der Merwe, "Formalizing BPE Tokenization").  For
every prefix of a pre-token there is one last token of the prefix's encoding;
two neighbouring tokens stand side by side exactly if encoding their joined
symbols gives the two back.  So one pass keeps the last token of each prefix of a
bounded window; ``lookahead``, computed from the merge list, is the number of
symbols after which a token can't change any more, and then it is emitted.
Distinct chunks of texts are encoded once and kept, by their bytes, in a table
that is emptied when it is full.

Decoding is a state machine that the ids of each document are fed to: token
strings joined as the library does, or, byte by byte, an incremental UTF-8 decoder.

Defined results: a null or empty text has no ids and decodes to the empty string;
special tokens' strings in a text become their ids, as in the library; repeated rows
are encoded each; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.chunkenc import TABLE_BYTES, Chunked
from kinfold.llm.textbuf import give_back, keep, text_column

END = "</w>"
#: Pairs of tokens that are remembered, and whole tokens.
PAIRS = 200_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b) if b in shown else chr(extra)
        extra += b not in shown
    return out


class Transducer:
    """Encoder of single pre-tokens, given as strings of one character per symbol.

    A symbol is a byte, or a byte that ends the pre-token: ``symbols`` maps both
    to private characters when the vocabulary has an end-of-word suffix.
    """

    def __init__(self, model: dict):
        self.suffix = model.get("end_of_word_suffix") or ""
        alphabet = byte_alphabet()
        self.plain = [chr(0xE000 + b) for b in range(256)]
        self.last = [chr(0xE100 + b) for b in range(256)] if self.suffix else self.plain
        byte_of = {c: b for b, c in enumerate(alphabet)}

        def symbols(token: str) -> str:
            if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
                head = [byte_of[c] for c in token[: -len(self.suffix)]]
                return "".join(self.plain[b] for b in head[:-1]) + self.last[head[-1]]
            return "".join(self.plain[byte_of[c]] for c in token)

        self.rank: dict[tuple[str, str], int] = {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        for i, (a, b) in enumerate(merges):
            self.rank.setdefault((symbols(a), symbols(b)), i)
        self.ids: dict[str, int] = {}
        for token, i in model["vocab"].items():
            try:
                self.ids[symbols(token)] = i
            except KeyError:
                continue  # not made of bytes: a special token
        made = {a + b for a, b in self.rank}
        self.tokens = {t: i for t, i in self.ids.items() if len(t) == 1 or t in made}
        self.longest = max(map(len, self.tokens))
        self.lookahead = self._lookahead()
        self.pairs: dict[str, bool] = {}
        self.wholes: dict[str, bool] = {}  # a vocabulary at most

    def _lookahead(self) -> int:
        """The most symbols, back from the end of an input, whose tokens more input can change.

        What is added can only change tokens from some place on.  A rule (u, v)
        moves that place back over u if v stands there in one of the two encodings
        only; v then begins with the left side of the earlier rule that moved the
        place to where it is.  So the longest chain of rules of ascending rank, each
        one's right side beginning with the left side of the one before, bounds the
        distance; one pass over the merge list finds it.
        """
        reach: dict[str, int] = {}
        most = 1
        for u, v in self.rank:  # in rank order
            n = len(u) + max([len(v), *(reach.get(v[:k], 0) for k in range(1, len(v) + 1))])
            reach[u] = max(n, reach.get(u, 0))
            most = max(most, n)
        return most

    def merge(self, text: str) -> list[str]:
        """Direct application of the merge list to a short string of symbols."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            found = [rank.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            best = min(found)
            if best == 1 << 30:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(found) and found[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two tokens stand side by side in the encoding of their symbols."""
        key = left + "\0" + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(left + right) == [left, right]
        return known

    def stream(self, symbols):
        """Yield tokens of one pre-token while its symbols arrive.

        A token is emitted once it ends ``lookahead`` symbols back, so at most three
        times that many symbols are held, however long the pre-token is.
        """
        tokens, longest, ahead = self.tokens, self.longest, self.lookahead
        window = ""  # symbols after those emitted
        last: list[str] = [""]  # last token of the encoding of each prefix of the window
        for c in symbols:
            window += c
            n = len(window)
            for size in range(min(longest, n), 0, -1):
                t = window[n - size :]
                if t in tokens and (size == 1 or self._whole(t)) and (n == size or self.fits(last[n - size], t)):
                    last.append(t)
                    break
            else:
                raise ValueError("a symbol has no token")
            if n >= 2 * ahead + longest:
                stable = [t for t in self._path(last) if t[0] <= n - ahead]
                for _, t in stable:
                    yield t
                if stable:
                    done = stable[-1][0]
                    window, last = window[done:], ["", *last[done + 1 :]]
        for _, t in self._path(last):
            yield t

    @staticmethod
    def _path(last: list[str]) -> list[tuple[int, str]]:
        """(end, token) of the encoding of the whole window."""
        out, at = [], len(last) - 1
        while at > 0:
            out.append((at, last[at]))
            at -= len(last[at])
        return out[::-1]

    def _whole(self, token: str) -> bool:
        known = self.wholes.get(token)
        if known is None:
            known = self.wholes[token] = self.merge(token) == [token]
        return known

    def encode(self, data: bytes):
        """Yield the ids of one pre-token's bytes."""
        if data:
            symbols = chain(map(self.plain.__getitem__, data[:-1]), (self.last[data[-1]],))
            yield from map(self.tokens.__getitem__, self.stream(symbols))


class WordBpe(Chunked):
    """The whole tokenizer of a word-BPE file: special tokens, normaliser, pre-tokens, transducer."""

    def __init__(self, path: str, limit: int = TABLE_BYTES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.transducer = Transducer(spec["model"])
        self.marks = {t["content"]: t["id"] for t in spec["added_tokens"]}
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        self.pattern = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in self.marks) + ")") if self.marks else None
        self.names = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.marks.items()}
        super().__init__(False, [s.lower().encode() for s in self.marks], limit)

    def normal(self, text: str) -> str:
        """NFC, then each character in lower case by itself (no final-sigma rule)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def ids(self, text: str):
        """Yield the ids of a text as they become certain."""
        for part in self.split.split(text) if self.split else [text]:
            if part in self.marks:
                yield self.marks[part]
                continue
            for word in self.pattern.finditer(self.normal(part)):
                yield from self.transducer.encode(word[0].encode())

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        each = [list(self.ids(c.decode("utf-8", "replace"))) for c in chunks]
        counts = np.array([len(x) for x in each], dtype=np.int64)
        return np.fromiter(chain.from_iterable(each), np.uint16, int(counts.sum())), counts

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [list(self.ids(t)) for t in texts]


class StreamDecoder:
    """Decoder of a stream of ids; feed ids, get text as soon as it is certain.

    ``joined`` gives the library's decode() of a file without a decoder: token
    strings with one space between; the state is whether one came before.  Otherwise
    the tokens' bytes go through an incremental UTF-8 decoder, whose state is an
    unfinished character, and an end-of-word suffix becomes a space.
    """

    def __init__(self, names: dict[int, str], suffix: str = END, joined: bool = False):
        self.names, self.suffix, self.joined = names, suffix, joined
        self.byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.clear()

    def clear(self) -> None:
        """Back to the state before the first id."""
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.lead = ""

    def feed(self, i: int) -> str:
        return self.feed_all((i,))

    def feed_all(self, ids) -> str:
        """The text of further ids."""
        if self.joined:
            if not len(ids):
                return ""
            out, self.lead = self.lead + " ".join(map(self.names.__getitem__, ids)), " "
            return out
        out = []
        for i in ids:
            token = self.names[i]
            ended = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ended else token
            try:
                data = bytes(self.byte_of[c] for c in body)
            except KeyError:
                data = body.encode()
            out.append(self.utf8.decode(self.lead.encode() + data))
            self.lead = " " if ended else ""
        return "".join(out)

    def close(self) -> str:
        return "" if self.joined else self.utf8.decode(b"", True)


_MODELS: dict[str, WordBpe] = {}


def model(path: str) -> WordBpe:
    """This process's tokenizer for a file, kept until a task ends that encodes nothing."""
    keep("bpe", _MODELS.clear)
    if path not in _MODELS:
        _MODELS[path] = WordBpe(path)
    return _MODELS[path]


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])


#: Ids that the decoder is fed at a time, and bytes of a result batch.
FEED, EMIT = 4096, 4 << 20


def _encode_partition(path: str):
    def run(batches):
        bpe = model(path)
        decimal = [str(i) for i in range(max(bpe.names) + 1)]
        machine = StreamDecoder(bpe.names, joined=True)
        for batch in batches:
            buf, off = text_column(batch.column(1))
            for lo, ids, ends in bpe.encode(buf, off):
                counts = np.diff(ends)
                first, numbers, texts, size = 0, [], [], 0
                for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    machine.clear()
                    parts = [ids[at : min(at + FEED, b)].tolist() for at in range(a, b, FEED)]
                    texts.append("".join(map(machine.feed_all, parts)) + machine.close())
                    numbers.append(" ".join(" ".join(map(decimal.__getitem__, p)) for p in parts))
                    size += len(texts[-1]) + len(numbers[-1])
                    if size > EMIT or k == len(counts) - 1:
                        n = k + 1 - first
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo + first, n), pa.array(counts[first : k + 1]), pa.array(numbers), pa.array(texts)], schema=ENCODED)
                        first, numbers, texts, size = k + 1, [], [], 0
        give_back(but="bpe")

    return run


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids as decimals joined by a space, decoded text) of whole texts; no shuffle."""
    few = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return few.mapInArrow(_encode_partition(tokenizer), "doc_id long, n_tokens long, ids string, decoded string")
