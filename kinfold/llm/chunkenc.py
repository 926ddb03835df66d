"""Whole-text encoding through a bounded table of independently encoded chunks.

A BPE tokenizer never merges across the borders of its pre-tokens.  Texts are
therefore cut, by vectorised byte tests, at places where the pre-tokenizer is
certain to cut as well; each distinct chunk is encoded once by the library and
kept, by its bytes, in a bounded table, and documents are assembled by gathering.  Documents
holding a special token's string are encoded whole, by the library.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from kinfold.llm.textbuf import SHORT, Words, blocks, expand, keep, same_bytes

BLOCK = 512 << 10
#: Bytes that the table may hold before it is emptied.
TABLE_BYTES = 96 << 20

_SPACE, _LETTER, _PUNCT, _MAYBE, _DIGIT, _HIGH = 0, 1, 2, 3, 4, 5


def _classes() -> np.ndarray:
    c = np.full(256, _PUNCT, dtype=np.uint8)
    c[ord("A") : ord("Z") + 1] = c[ord("a") : ord("z") + 1] = _LETTER
    c[ord("0") : ord("9") + 1] = _DIGIT
    c[:32] = c[127] = _MAYBE  # controls: some count as white space
    c[0x80:] = _HIGH
    c[[0xC2, 0xE1, 0xE2, 0xE3]] = _MAYBE  # lead bytes of the other white space
    c[[0x20, 0x0A]] = _SPACE
    return c


CLASS = _classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def cuts_keeping_space(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk starts and ends for byte-level BPE, whose pre-tokens keep white space.

    Cuts: before a space that a certain non-space follows; around a line feed
    between two certain non-spaces; between an ASCII letter and ASCII
    punctuation.  None of the pattern's alternatives matches across these.
    """
    n = len(buf)
    c = CLASS[buf]
    solid = (c != _SPACE) & (c != _MAYBE)
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = (c[:-1] == _LETTER) & (c[1:] == _PUNCT)
    if n > 1:
        cut[: n - 1] |= (buf[:-1] == 0x20) & solid[1:]
    if n > 2:
        # a lead byte proves a letter or punctuation after the line feed; before it, any byte but white space's last ones
        feed = (buf[1:-1] == 0x0A) & solid[2:] & ((c[:-2] == _LETTER) | (c[:-2] == _PUNCT) | (c[:-2] == _DIGIT))
        cut[1 : n - 1] |= feed
        cut[2:n] |= feed
    cut[offsets] = True
    at = np.flatnonzero(cut[:n])
    return at, np.append(at[1:], n)


def cuts_dropping_space(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk starts and ends for word BPE, whose pre-tokens drop white space."""
    n = len(buf)
    c = CLASS[buf]
    word = c != _SPACE
    cut = np.zeros(n + 1, dtype=bool)
    if n > 1:
        cut[1:n] = ((c[:-1] == _LETTER) & (c[1:] == _PUNCT)) | (word[1:] & ~word[:-1])
    cut[offsets] = True
    end = np.zeros(n + 1, dtype=bool)
    end[1:] = cut[1:]
    if n:
        end[1:n] |= word[:-1] & ~word[1:]
        end[n] = True
    start = np.flatnonzero(cut[:n] & word)
    stop = np.flatnonzero(end)
    stop = stop[np.searchsorted(stop, start, side="right")] if len(start) else start
    return start, stop


class ChunkTable:
    """Distinct chunks by key, with their bytes and a payload slice of ids each; to be emptied when ``full``.

    Keys stand in sorted runs, each at least twice as long as the next.
    """

    def __init__(self, limit: int = TABLE_BYTES):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.ids = np.zeros(0, np.uint16)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.text = np.zeros(1 << 16, np.uint8)  # the chunks' bytes, with room after them
        self.used = 0
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.start)

    def full(self) -> bool:
        return 48 * len(self.start) + 2 * len(self.ids) + len(self.text) > self.limit

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of keys, -1 where unknown."""
        out = np.full(len(keys), -1, np.int64)
        for have, rows in self.runs:
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            hit = have[at] == keys
            out[hit] = rows[at[hit]]
        return out

    def add(self, keys: np.ndarray, ids: np.ndarray, length: np.ndarray, text: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows of new sorted keys; ``text`` holds their chunks' bytes, ``size`` of each."""
        rows = np.arange(len(self.start), len(self.start) + len(keys), dtype=np.int64)
        first = len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        self.start = np.concatenate([self.start, first + np.cumsum(length, dtype=np.int64) - length])
        self.length = np.concatenate([self.length, length.astype(np.int32)])
        if self.used + len(text) + 8 > len(self.text):
            self.text = np.concatenate([self.text, np.zeros(len(text) + len(self.text) // 2, np.uint8)])
        self.text[self.used : self.used + len(text)] = text
        self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used += len(text)
        self.runs.append((keys, rows))
        while len(self.runs) > 1 and 2 * len(self.runs[-1][0]) > len(self.runs[-2][0]):
            (a, x), (b, y) = self.runs.pop(-2), self.runs.pop()
            both = np.concatenate([a, b])
            order = np.argsort(both, kind="stable")
            self.runs.append((both[order], np.concatenate([x, y])[order]))
        return rows

    def holds(self, rows: np.ndarray, words: Words, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the chunks of rows are these slices, byte by byte."""
        out = self.size[rows] == size
        some = np.flatnonzero(out)
        out[some] = same_bytes(Words(self.text, padded=True), self.at[rows[some]], words, start[some], size[some])
        return out


class Chunked:
    """Encoding of whole texts through a table of distinct chunks.

    ``lossless`` tells whether pre-tokens keep white space; ``special`` are the
    strings whose documents ``whole`` encodes.  The table is bounded by ``limit``
    bytes and a block, and belongs to the process, so tasks of one worker share it.
    """

    def __init__(self, lossless: bool, special: list[bytes], limit: int = TABLE_BYTES):
        self.lossless, self.special, self.table = lossless, special, ChunkTable(limit)

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of distinct chunks."""
        raise NotImplementedError

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts that may hold special tokens."""
        raise NotImplementedError

    def rows(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Table rows of the chunks of one block, the number of chunks before each document, and documents with a chunk that is not its row's.

        Chunks of up to seven bytes are their own key; longer ones are compared with the row of their key.
        """
        if not self.lossless:
            buf = LOWER[buf]
        start, end = (cuts_keeping_space if self.lossless else cuts_dropping_space)(buf, offsets)
        before = np.searchsorted(start, offsets)
        if self.table.full():
            self.table.clear()
        words, size = Words(buf), end - start
        long = np.flatnonzero(size > SHORT)
        keys = words.exact(start, size)
        keys[long] = words.keys(start[long], end[long]) | np.uint64(255 << 56)
        uniq, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        rows = self.table.find(uniq)
        new = np.flatnonzero(rows < 0)
        if len(new):
            raw = buf.tobytes()
            at = first[new]
            ids, counts = self.encode_new([raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            rows[new] = self.table.add(uniq[new], ids, counts, buf[expand(start[at], size[at])], size[at])
        rows = rows[inverse]
        odd = long[~self.table.holds(rows[long], words, start[long], size[long])]
        return rows, before, np.unique(np.searchsorted(offsets, start[odd], side="right") - 1)

    def _specials(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Documents that hold the string of a special token, in any case."""
        raw = LOWER[buf].tobytes()
        found = set()
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                found.add(int(np.searchsorted(offsets, at, side="right")) - 1)
                at = raw.find(s, at + 1)
        return np.array(sorted(found), dtype=np.int64)

    def encode(self, buf: np.ndarray, offsets: np.ndarray):
        """Yield (first document, ids, offsets of ids) for consecutive blocks of documents."""
        for lo, hi in blocks(offsets, BLOCK):
            off = offsets[lo : hi + 1] - offsets[lo]
            part = buf[offsets[lo] : offsets[hi]]
            rows, before, odd = self.rows(part, off)
            length = self.table.length[rows]
            ids = self.table.ids[expand(self.table.start[rows], length)]
            ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])[before]
            whole = np.union1d(self._specials(part, off), odd)
            if len(whole):
                each = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
                texts = [part[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace") for i in whole]
                for i, x in zip(whole, self.whole(texts)):
                    each[i] = np.array(x, dtype=np.uint16)
                ids = np.concatenate(each)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)])
            yield lo, ids, ends


class ChunkEncoder(Chunked):
    """Ids of whole texts as ``tokenizer.encode(text, add_special_tokens=False)`` gives them.

    A file's pre-tokens keep white space if it splits by the byte-level pattern.
    """

    def __init__(self, path: str, limit: int = TABLE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        super().__init__("use_regex\":true" in self.tokenizer.to_str().replace(" ", ""), [t.content.encode() for t in added.values()], limit)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if size > 1 << 16:
            raise ValueError("a vocabulary of more than 65,536 ids")
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.feed = self.tokenizer.token_to_id("Ċ") if self.lossless else None

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and counts of chunks that are one pre-token each, by one library call; None if they are not."""
        e = self.whole([("\n" if self.lossless else " ").join(chunks)])[0]
        ids = np.fromiter(e, np.uint16, len(e))
        if self.lossless:
            at = np.flatnonzero(ids == self.feed)
            if len(at) != len(chunks) - 1:
                return None
            return np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
        at = np.flatnonzero(self.ends_word[ids])
        return (ids, np.diff(np.concatenate([[-1], at]))) if len(at) == len(chunks) else None

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of distinct chunks; plain ASCII ones share library calls."""
        texts = [x.decode("utf-8", "replace") for x in chunks]
        if self.lossless:
            plain = np.array([x.isascii() and x.isprintable() and x[-1] != " " and "  " not in x for x in texts], dtype=bool)
        else:
            plain = np.array([x.isascii() and x.isalpha() for x in texts], dtype=bool)
        ids, counts, order = [], [], []

        def singly(part):
            got = self.whole([texts[i] for i in part])
            each = np.array([len(x) for x in got], dtype=np.int64)
            ids.append(np.fromiter(chain.from_iterable(got), np.uint16, int(each.sum())))
            counts.append(each)

        for which, size in ((np.flatnonzero(plain), 2048), (np.flatnonzero(~plain), 4096)):
            for lo in range(0, len(which), size):
                part = which[lo : lo + size].tolist()
                order += part
                got = self._joined([texts[i] for i in part]) if plain[part[0]] else None
                if got is None:
                    singly(part)
                else:
                    ids.append(got[0])
                    counts.append(got[1])
        if not order:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        flat, each = np.concatenate(ids), np.concatenate(counts).astype(np.int64)
        back = np.empty(len(order), dtype=np.int64)
        back[np.array(order)] = np.arange(len(order))
        start = np.cumsum(each) - each
        return flat[expand(start[back], each[back])], each[back]


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, limit: int = TABLE_BYTES) -> ChunkEncoder:
    """This process's encoder for a tokenizer file, kept until a task ends that encodes nothing."""
    keep("encoder", _ENCODERS.clear)
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = ChunkEncoder(path, limit)
    return _ENCODERS[path, limit]
