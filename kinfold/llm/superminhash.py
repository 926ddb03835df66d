"""SuperMinHash signatures of word shingle sets, a block of documents at a time.

SuperMinHash (Ertl, 2017) gives each element of a set a random permutation of the
m slots; at its j-th step an element offers the value j + r, r uniform in [0, 1),
to the j-th slot of its permutation, and each slot keeps the least offer.  Ranks
within one element are correlated, which lowers the variance below that of
independent minima.  Offers of step j cannot improve a slot that already holds
less than j, so a document is done once all its slots are filled before step j.

Steps run over all elements of all unfinished documents of a block at once.
"""

from __future__ import annotations

import numpy as np

from kinfold.llm.chunkenc import LOWER
from kinfold.llm.textbuf import Words, mix64

_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of a block, A-Z in lower case, and words before each document.

    Words are runs of bytes other than space and 0x09-0x0D.
    """
    low = LOWER[buf]
    n = len(low)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = (low != 0x20) & ((low < 0x09) | (low > 0x0D))
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start = np.flatnonzero(solid[1 : n + 1] & (~solid[:n] | edge[:n]))
    end = np.flatnonzero(solid[: n + 1] & (~solid[1:] | edge))
    return Words(low).keys(start, end), np.searchsorted(start, offsets)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each document, ascending within it, and shingles before each document.

    A document of fewer than k words has its whole sequence as one shingle; one
    without words has none.
    """
    w, first = word_hashes(buf, offsets)
    words = np.diff(first)
    n_docs = len(words)
    with np.errstate(over="ignore"):
        run = np.zeros(len(w), dtype=np.uint64)
        for j in range(k):
            run[: len(w) - j] = run[: len(w) - j] * _ODD + w[j:] if j else w.copy()
        run = mix64(run)
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    doc = np.repeat(np.arange(n_docs), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
    h = run[at]
    for i in np.flatnonzero((words > 0) & (words < k)).tolist():
        x = np.uint64(words[i])
        with np.errstate(over="ignore"):
            for v in w[first[i] : first[i + 1]]:
                x = x * _ODD + v
        h[np.searchsorted(doc, i)] = mix64(np.array([x]))[0]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(n_docs + 1))


def signatures(h: np.ndarray, first: np.ndarray, m: int, seed: int = 1) -> np.ndarray:
    """(documents, m) signatures; an empty set keeps the greatest value in all slots."""
    n_docs = len(first) - 1
    size = np.diff(first)
    none = np.uint64(2**64 - 1)
    sig = np.full(n_docs * m, none, dtype=np.uint64)
    doc = np.repeat(np.arange(n_docs), size)

    def draw(x: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        r = mix64(x + np.uint64((2 * step + 1 + seed * 1000) * 0x632BE59BD9B4E019 % 2**64))
        pick = step + (mix64(r + _ODD) >> np.uint64(33)).astype(np.int64) % (m - step)
        return (r >> np.uint64(8)) | np.uint64(step << 56), pick

    if not len(h):
        return sig.reshape(n_docs, m)
    value, pick0 = draw(h, 0)
    np.minimum.at(sig, doc * m + pick0, value)
    # step 1 in closed form: after the first swap slot pick0 holds 0
    open_docs = (sig.reshape(n_docs, m) == none).any(axis=1) & (size > 0)
    live = np.flatnonzero(open_docs[doc])
    if m > 1 and len(live):
        value, pick1 = draw(h[live], 1)
        slot = np.where(pick1 == pick0[live], 0, pick1)
        at = doc[live] * m + slot
        better = sig[at] > value
        np.minimum.at(sig, at[better], value[better])
        open_docs &= (sig.reshape(n_docs, m) == none).any(axis=1)
        keep = open_docs[doc[live]]
        live, pick1 = live[keep], pick1[keep]
    if m > 2 and len(live):
        perm = np.tile(np.arange(m, dtype=np.int16), (len(live), 1))
        rows = np.arange(len(live))

        def swap(step, pick):
            perm[rows, step], perm[rows, pick] = perm[rows, pick].copy(), perm[rows, step].copy()

        swap(0, pick0[live])
        swap(1, pick1)
        for step in range(2, m):
            value, pick = draw(h[live], step)
            swap(step, pick)
            at = doc[live] * m + perm[rows, step]
            better = sig[at] > value
            np.minimum.at(sig, at[better], value[better])
            still = (sig.reshape(n_docs, m)[np.flatnonzero(open_docs)] == none).any(axis=1)
            if not still.all():
                open_docs[np.flatnonzero(open_docs)[~still]] = False
                keep = open_docs[doc[live]]
                live, perm = live[keep], perm[keep]
                rows = np.arange(len(live))
                if not len(live):
                    break
    return sig.reshape(n_docs, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) fingerprints of the bands, each with its number."""
    n = len(sig)
    out = np.zeros((n, bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            x = np.full(n, b + 1, dtype=np.uint64)
            for r in range(rows):
                x = mix64(x * _ODD + sig[:, b * rows + r])
            out[:, b] = x
    return out
