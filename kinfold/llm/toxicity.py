"""Toxic spans by a linear-chain conditional random field (operator 5).

Tokens are runs of letters (bytes from 0x80 on count as letters, A-Z in lower
case); a token's features are its word and its prefixes.  Labels exist for whole
documents only, so training tokens are labelled from them: in a toxic document a
token is toxic if one of its features occurs far more often in toxic documents;
all other tokens are not.  The field has two states, feature weights for the
toxic one, and transitions; it is trained by maximum likelihood with forward and
backward passes.  Marginals give a document's score, through a logistic fit on
training documents, and its offending byte offsets.

Scoring is exact over whole texts: between tokens with features the chain moves
by powers of one 2x2 matrix, so its cost is in the tokens that matter.

Only text and training labels enter the model.  It is fitted on a sample of at
most ``per_class`` rows of each label (in the order of a hash of the id).  Their
features are counted and their sentences made on the executors; the driver gets
``MOST_FEATURES`` features, ``MOST_SENTENCES`` sentences of up to ``SENTENCE`` tokens
(features and places only) and one number for each training row, however long the texts.

Defined results: null and empty texts get the score of a text without toxic
tokens; a label that is null is ignored; several labels of one document count as
toxic if one is; of several rows with the id of a training label the text of lowest
hash is the example; without training rows of both labels every score is 0; repeated
rows are scored each; null ids are kept; an empty table gives no rows; other columns
are ignored, or kept as they are by ``drop_toxic``.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.chunkenc import LOWER
from kinfold.llm.shared import discard, saved
from kinfold.llm.textbuf import Words, blocks, give_back, mix64, text_column

PER_CLASS = (16000, 4000)
PREFIXES = (3, 4, 5, 6, 7, 8)
MOST_FEATURES, MOST_SENTENCES = 50_000, 100_000
STRONG = 3.0  # log ratio of document frequencies from which a feature labels tokens
EVIDENCE = 14.0  # and the log likelihood ratio against equal frequencies that it needs
SENTENCE = 48
#: One in so many sentences without a feature is taken, for the transitions.
PLAIN = 40
#: Sentences that are trained on at a time.
TRAIN_BATCH = 4096
BLOCK = 512 << 10

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[0x80:] = True


def words(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of a lower-cased block; none crosses documents."""
    n = len(low)
    letter = np.zeros(n + 2, dtype=bool)
    letter[1:-1] = _IS_LETTER[low]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    here, before = letter[1:], letter[:-1]
    start = np.flatnonzero(here[:n] & (~before[:n] | edge[:n]))
    end = np.flatnonzero(before & (~here | edge))
    return start, end


def features(low: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Yield (token indices, feature fingerprints): the word, then each prefix of tokens longer than it."""
    w = Words(low)
    yield np.arange(len(start)), mix64(w.keys(start, end) + np.uint64(1))
    for size in PREFIXES:
        at = np.flatnonzero(end - start > size)
        yield at, mix64(w.keys(start[at], start[at] + size) + np.uint64(size * 2 + 2))


class Crf:
    """Parameters: feature fingerprints (sorted) and weights, the bias of the toxic state, transitions."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float, moves: np.ndarray, scale=(0.0, 0.0)):
        self.keys, self.weights, self.bias, self.moves, self.scale = keys, weights, bias, moves, scale
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(keys >> np.uint64(48)).astype(np.int64)] = True

    def __reduce__(self):
        return Crf, (self.keys, self.weights, self.bias, self.moves, self.scale)

    def hits(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of tokens with features, ascending, and the sums of their weights."""
        at_all, w_all = [], []
        for at, f in features(low, start, end):
            maybe = np.flatnonzero(self.seen[(f >> np.uint64(48)).astype(np.int64)])
            if len(maybe) and len(self.keys):
                f, at = f[maybe], at[maybe]
                k = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
                same = self.keys[k] == f
                at_all.append(at[same])
                w_all.append(self.weights[k[same]])
        if not at_all:
            return np.zeros(0, np.int64), np.zeros(0)
        at, w = np.concatenate(at_all), np.concatenate(w_all)
        uniq, inverse = np.unique(at, return_inverse=True)
        return uniq, np.bincount(inverse, weights=w, minlength=len(uniq))

    def _powers(self):
        step = np.exp(self.moves + np.array([0.0, self.bias])[None, :])
        value, vector = np.linalg.eig(step)
        return step, value.real, vector.real, np.linalg.inv(vector.real)

    def marginals(self, n: int, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """P(toxic) of the tokens ``at`` of a chain of n tokens; all other tokens have no features."""
        step, value, vector, inverse = self._step
        top = value.max()

        def walk(g: int) -> np.ndarray:
            """step^g up to a factor."""
            return (vector * (value / top) ** g) @ inverse

        k = len(at)
        ahead = np.empty((k, 2))
        a = np.array([1.0, np.exp(self.bias)])  # before the first move: the first token's own scores
        where = 0
        boost = np.exp(np.minimum(weight, 50.0))
        for i in range(k):
            g = int(at[i]) - where
            if g:
                a = a @ walk(g)
            where = int(at[i])
            a = a * (1.0, boost[i])
            a = a / a.sum()
            ahead[i] = a
        out = np.empty(k)
        b = np.ones(2) if k == 0 else walk(n - 1 - int(at[-1])) @ np.ones(2)
        for i in range(k - 1, -1, -1):
            p = ahead[i] * b
            out[i] = p[1] / p.sum()
            if i:
                b = walk(int(at[i] - at[i - 1])) @ (b * (1.0, boost[i]))
                b = b / b.sum()
        return out

    @property
    def _step(self):
        if not hasattr(self, "_cached"):
            self._cached = self._powers()
        return self._cached

    def document(self, n: int, at: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """(evidence in [0, 1]: 1 - prod(1 - p), marginals)."""
        if not len(at):
            return 0.0, np.zeros(0)
        p = self.marginals(n, at, weight)
        return float(1.0 - np.prod(1.0 - p)), p

    def score(self, evidence: float) -> float:
        a, b = self.scale
        return float(1.0 / (1.0 + np.exp(-(a + b * evidence))))

    def scan(self, buf: np.ndarray, offsets: np.ndarray):
        """Yield (evidence, toxic spans as byte offsets) for each document."""
        for lo, hi in blocks(offsets, BLOCK):
            off = offsets[lo : hi + 1] - offsets[lo]
            low = LOWER[buf[offsets[lo] : offsets[hi]]]
            start, end = words(low, off)
            first = np.searchsorted(start, off)
            at, w = self.hits(low, start, end)
            cut = np.searchsorted(at, first)
            for i in range(hi - lo):
                a, b = cut[i], cut[i + 1]
                if a == b:
                    yield 0.0, []
                    continue
                evidence, p = self.document(int(first[i + 1] - first[i]), at[a:b] - first[i], w[a:b])
                spans: list[list[int]] = []
                for j in np.flatnonzero(p >= 0.5):
                    t = at[a + j]
                    s, e = int(start[t] - off[i]), int(end[t] - off[i])
                    if spans and t and spans[-1][1] == int(end[t - 1] - off[i]):
                        spans[-1][1] = e
                    else:
                        spans.append([s, e])
                yield evidence, spans


def _tokenised(batches, column: int):
    """(batch, first row, lower-cased bytes, offsets, starts, ends) of blocks of documents."""
    for batch in batches:
        buf, off = text_column(batch.column(column))
        for lo, hi in blocks(off, BLOCK):
            o = off[lo : hi + 1] - off[lo]
            low = LOWER[buf[off[lo] : off[hi]]]
            yield batch, lo, low, o, *words(low, o)
    give_back()


def _marks(batches, looks: int = 4):
    """(id, mark): minima of the three-word shingles of documents (id, y, text)."""
    for batch, lo, low, o, start, end in _tokenised(batches, 2):
        h = Words(low).keys(start, end)
        first = np.searchsorted(start, o)
        marks = []
        for i in range(len(o) - 1):
            w = h[first[i] : first[i + 1]]
            if len(w) > 2:
                w = w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(5) + w[2:]
            marks.append([mix64(w + np.uint64(k)).min() + np.uint64(k) for k in range(looks)] if len(w) else [np.uint64(0)] * looks)
        ids = np.repeat(batch.column(0).to_numpy()[lo : lo + len(o) - 1], looks)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.array(marks, np.uint64).ravel().view(np.int64))], names=["id", "mark"])


def _feature_counts(batches):
    """(key, n0, n1): documents (id, y, text) of each label that have a feature."""
    for batch, lo, low, o, start, end in _tokenised(batches, 2):
        y = batch.column(1).to_numpy()[lo : lo + len(o) - 1]
        doc = np.searchsorted(o, start, side="right") - 1
        found = list(features(low, start, end))
        keys, docs = np.concatenate([f for _, f in found]), doc[np.concatenate([at for at, _ in found])]
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        keys, toxic = keys[new], y[docs[new]]
        uniq, inverse = np.unique(keys, return_inverse=True)
        n1 = np.bincount(inverse, weights=toxic, minlength=len(uniq)).astype(np.int64)
        n = np.bincount(inverse, minlength=len(uniq))
        yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), pa.array(n - n1), pa.array(n1)], names=["key", "n0", "n1"])


SENTENCES = "id long, place long, y int, size int, at array<int>, keys array<long>"


def _sentences(wanted: np.ndarray):
    """Sentences of documents (id, y, text) with a wanted feature, and some without; ``at``: the token of each key."""

    def run(batches):
        for batch, lo, low, o, start, end in _tokenised(batches, 2):
            if not len(start):
                continue
            ids, y = batch.column(0).to_numpy()[lo:], batch.column(1).to_numpy()[lo:]
            doc = np.searchsorted(o, start, side="right") - 1
            inside = np.arange(len(start)) - np.searchsorted(start, o)[doc]
            begin = np.flatnonzero(inside % SENTENCE == 0)
            of = np.cumsum(inside % SENTENCE == 0) - 1
            tokens, keys = [], []
            for at, f in features(low, start, end):
                k = np.minimum(np.searchsorted(wanted, f), len(wanted) - 1)
                hit = wanted[k] == f
                tokens.append(at[hit])
                keys.append(f[hit])
            tokens, keys = np.concatenate(tokens), np.concatenate(keys)
            order = np.lexsort((keys, tokens))
            tokens, keys = tokens[order], keys[order]
            place = inside[begin] // SENTENCE
            chance = mix64(ids[doc[begin]].view(np.uint64) * np.uint64(31) + place.astype(np.uint64))
            have = np.bincount(of[tokens], minlength=len(begin))
            use = np.flatnonzero((have > 0) | (chance % np.uint64(PLAIN) == 0))
            sizes = np.diff(np.append(begin, len(start)))
            off = np.concatenate([[0], np.cumsum(have[use])]).astype(np.int32)
            local = (tokens - begin[of[tokens]]).astype(np.int32)  # those of sentences in use, as all with a feature are
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[doc[begin[use]]]), pa.array(place[use]), pa.array(y[doc[begin[use]]]), pa.array(sizes[use].astype(np.int32)), pa.ListArray.from_arrays(pa.array(off), pa.array(local)), pa.ListArray.from_arrays(pa.array(off), pa.array(keys.view(np.int64)))],
                names=["id", "place", "y", "size", "at", "keys"],
            )

    return run


class _Batch:
    """Some labelled sentences, as padded arrays."""

    def __init__(self, size: np.ndarray, label: np.ndarray, row: np.ndarray, at: np.ndarray, key: np.ndarray):
        width = int(size.max())
        self.row, self.at, self.key = row, at, key
        self.gold = np.zeros((len(size), width), dtype=np.int64)
        toxic = label[row] == 1
        self.gold[row[toxic], at[toxic]] = 1
        self.live = np.arange(width)[None, :] < size[:, None]

    def pairs(self) -> np.ndarray:
        """Counts of neighbouring labels."""
        a, b, inner = self.gold[:, :-1], self.gold[:, 1:], self.live[:, 1:]
        return np.array([[((a == i) & (b == j) & inner).sum() for j in (0, 1)] for i in (0, 1)], float)

    def expected(self, weights: np.ndarray, bias: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(toxic) of each token, expected counts of neighbouring labels), by forward and backward passes.

        Passes are scaled to sum to one at each token instead of taking logarithms.
        """
        live = self.live.T
        width, n = live.shape
        s = np.full((width, n), bias)
        np.add.at(s, (self.at, self.row), weights[self.key])
        s = np.exp(np.clip(s, -500.0, 500.0))
        e = np.exp(moves)
        clean, toxic = np.empty((width, n)), np.empty((width, n))  # forward, of either state
        clean[0], toxic[0] = 1 / (1 + s[0]), s[0] / (1 + s[0])
        for t in range(1, width):
            x, y = clean[t - 1] * e[0, 0] + toxic[t - 1] * e[1, 0], (clean[t - 1] * e[0, 1] + toxic[t - 1] * e[1, 1]) * s[t]
            z = x + y
            clean[t], toxic[t] = np.where(live[t], x / z, clean[t - 1]), np.where(live[t], y / z, toxic[t - 1])
        p, pairs = np.empty((width, n)), np.zeros((2, 2))
        b0 = b1 = np.ones(n)  # backward
        p[-1] = toxic[-1]
        for t in range(width - 2, -1, -1):
            on, c1 = live[t + 1], s[t + 1] * b1
            joint = [[clean[t] * e[0, 0] * b0, clean[t] * e[0, 1] * c1], [toxic[t] * e[1, 0] * b0, toxic[t] * e[1, 1] * c1]]
            z = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
            pairs += [[(x[on] / z[on]).sum() for x in row] for row in joint]
            x, y = e[0, 0] * b0 + e[0, 1] * c1, e[1, 0] * b0 + e[1, 1] * c1
            b0, b1 = np.where(on, x / (x + y), 1.0), np.where(on, y / (x + y), 1.0)
            p[t] = toxic[t] * b1 / (clean[t] * b0 + toxic[t] * b1)
        return (p * live).T, pairs


def field(batches: list[_Batch], n_features: int, rounds: int = 60, ridge: float = 1e-3) -> tuple[np.ndarray, float, np.ndarray]:
    """(weights, bias, moves) of largest likelihood, by adaptive gradient steps over all batches."""
    weights, bias, moves = np.zeros(n_features), -3.0, np.zeros((2, 2))
    gold = sum(np.bincount(b.key, weights=b.gold[b.row, b.at], minlength=n_features) for b in batches)
    toxic, tokens = sum(float(b.gold.sum()) for b in batches), sum(float(b.live.sum()) for b in batches)
    pairs = sum(b.pairs() for b in batches)
    speed = [np.full(n_features, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(rounds):
        got_w, got_b, got_m = np.zeros(n_features), 0.0, np.zeros((2, 2))
        for b in batches:
            p, m = b.expected(weights, bias, moves)
            got_w += np.bincount(b.key, weights=p[b.row, b.at], minlength=n_features)
            got_b += float(p.sum())
            got_m += m
        grads = [gold - got_w - ridge * tokens * 0.01 * weights, toxic - got_b - ridge * bias, pairs - got_m - ridge * moves]
        # adaptive steps: each parameter by its own gradient history
        for k, g in enumerate(grads):
            speed[k] = speed[k] + g * g
        weights = weights + 0.8 * grads[0] / np.sqrt(speed[0])
        bias = bias + 0.8 * grads[1] / np.sqrt(speed[1])
        moves = moves + 0.8 * grads[2] / np.sqrt(speed[2])
    return weights, float(bias), moves


def _evidence(net: bytes):
    crf = pickle.loads(net)

    def run(batches):
        for batch in batches:
            got = [e for e, _ in crf.scan(*text_column(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.float64())], names=["id", "y", "evidence"])

    return run


def train(examples: DataFrame) -> Crf:
    """Fit the field and the document scale on examples (id, y, text), one row for each id."""
    none = Crf(np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros((2, 2)), (-30.0, 0.0))
    examples = saved(examples)
    # copies would count the words they share as often as they occur: an example that shares a mark with an earlier one goes
    marks = saved(examples.mapInArrow(_marks, "id long, mark long"))
    first = marks.groupBy("mark").agg(F.min("id").alias("first"))
    fresh = marks.join(first, "mark").groupBy("id").agg(F.min(F.col("id") == F.col("first")).alias("fresh")).where("fresh").select("id")
    fresh = saved(examples.join(fresh, "id").select("id", "y", "text"))
    discard(examples, marks)
    total = {r["y"]: r["n"] for r in fresh.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return none
    counts = fresh.mapInArrow(_feature_counts, "key long, n0 long, n1 long").groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = [total[k] / (total[0] + total[1]) for k in (0, 1)]
    ratio = F.log((F.col("n1") + 0.5) / (total[1] + 1.0)) - F.log((F.col("n0") + 0.5) / (total[0] + 1.0))
    term = lambda c, q: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("n0") + F.col("n1")) * q))).otherwise(0.0)
    chosen = counts.withColumn("gain", term("n0", share[0]) + term("n1", share[1])).where((ratio >= STRONG) & (F.col("gain") >= EVIDENCE))
    wanted = np.sort(np.array([r["key"] for r in chosen.orderBy(F.desc("gain"), "key").limit(MOST_FEATURES).select("key").collect()], np.int64).view(np.uint64))
    if not len(wanted):
        return none
    some = fresh.mapInArrow(_sentences(wanted), SENTENCES).orderBy(F.xxhash64("id", "place"), "id", "place").limit(MOST_SENTENCES).toArrow().combine_chunks()
    size, label = (some.column(c).to_numpy() for c in ("size", "y"))
    each = some.column("keys").combine_chunks()
    off = np.concatenate([[0], np.cumsum(each.value_lengths().to_numpy())])
    at, key = some.column("at").combine_chunks().flatten().to_numpy(), np.searchsorted(wanted, each.flatten().to_numpy().view(np.uint64))
    row = np.repeat(np.arange(len(size)), np.diff(off))
    batches = []
    for lo in range(0, len(size), TRAIN_BATCH):
        hi = min(lo + TRAIN_BATCH, len(size))
        a, b = off[lo], off[hi]
        batches.append(_Batch(size[lo:hi], label[lo:hi], row[a:b] - lo, at[a:b], key[a:b]))
    weights, bias, moves = field(batches, len(wanted))
    net = Crf(wanted, weights, bias, moves)
    x = fresh.mapInArrow(_evidence(pickle.dumps(net)), "id long, y int, evidence double").orderBy("id").toArrow()
    net.scale = _logistic(x.column("evidence").to_numpy(), x.column("y").to_numpy())
    discard(fresh)
    return net


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Logistic regression of y on evidence by Newton steps, with a prior that puts evidence 1/2 at score 1/2.

    Evidence separates training documents almost without error, so the data alone
    would put the border next to 0; the prior weighs as much as the data.
    """
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    prior = np.array([-4.0, 8.0])
    theta = prior.copy()
    data = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(data @ theta, -30, 30)))
        g = data.T @ (weight * (y - p)) - 0.1 * (theta - prior)
        h = (data * (weight * p * (1 - p))[:, None]).T @ data + 0.1 * np.eye(2)
        theta = theta + np.linalg.solve(h, g)
    return float(theta[0]), float(theta[1])


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: tuple[int, int] = PER_CLASS, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text") -> DataFrame:
    """(id, y, text) of at most ``per_class[y]`` labelled documents of label y, lowest hash of the id first."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    few = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    present = few.where("text is not null").select("id").distinct()
    known = known.join(present, "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [known.where(f"y = {k}").orderBy(*order).limit(per_class[k]) for k in (0, 1)]
    picked = saved(chosen[0].unionAll(chosen[1]))
    got = few.join(F.broadcast(picked), "id").where("text is not null")  # sum(per_class) ids at most
    return got.groupBy("id").agg(F.first("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _score(net: bytes):
    crf = pickle.loads(net)

    def run(batches):
        for batch in batches:
            buf, off = text_column(batch.column(1))
            scores, spans = [], []
            for evidence, found in crf.scan(buf, off):
                scores.append(crf.score(evidence))
                spans.append([{"start": a, "end": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, SPANS)], names=["id", "score", "spans"])
        give_back()

    return run


def score_documents(docs: DataFrame, net: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans) of whole texts; spans are byte offsets in UTF-8; no shuffle."""
    few = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return few.mapInArrow(_score(pickle.dumps(net)), "id long, score double, spans array<struct<start:long,end:long>>").withColumnRenamed("id", id_col)


def _keep(net: bytes, threshold: float, at: int):
    crf = pickle.loads(net)

    def run(batches):
        for batch in batches:
            buf, off = text_column(batch.column(at))
            good = pa.array([crf.score(evidence) < threshold for evidence, _ in crf.scan(buf, off)], pa.bool_())
            kept = batch.filter(good)
            if kept.num_rows:
                yield kept
        give_back()

    return run


def drop_toxic(docs: DataFrame, net: Crf, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is below the threshold, all columns as they were; no shuffle."""
    return docs.mapInArrow(_keep(pickle.dumps(net), threshold, docs.columns.index(text_col)), docs.schema)
