"""Quality classifier: random-indexing word vectors pooled per document, a two-layer numpy network,
probabilities calibrated by a temperature.

A token (a run of non-space bytes) gives three items: its word, its shape (runs of upper case, lower
case, digits, and other ASCII signs as they are) and, when it repeats the token before, a repeat sign.
Every item has a fixed random index vector; an item's word vector is the sum of the index vectors of
the items around its places in the training sample. A document is the mean word vector of its words,
the mean of its shapes, and its share of repeats. The network has one hidden layer; the temperature is
fitted on a part of the sample that the weights did not see.

Learning uses at most ``SAMPLE`` labelled documents (smallest id hashes) and the ``VOCABULARY`` most
frequent items of these; scoring reads every whole text.

Edge cases: null and empty texts have zero vectors and get the network's score for those; every row
gives one output row; a null doc_id counts as the empty text for its fold; other columns, and labels of
unknown ids, are ignored; with no labelled documents, or of one kind only, the score is the share of
label 1 in the sample (0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.labelled import fold, labelled_sample
from webfeed.llm.tables import keep_columns, received, shared, table, with_key, written

SAMPLE, VOCABULARY, SIZE, HIDDEN = 12_000, 16_384, 64, 32
FOLDS, HELD_OUT, ACCEPT = 4, 2, 0.7
_REPEAT = np.uint64(0x52455045)


def _class_table() -> np.ndarray:
    """Byte -> class: one for upper case, one for lower case and non-ASCII, one for digits, signs as they are."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B], t[0x61:0x7B], t[0x30:0x3A] = 0x41, 0x61, 0x30
    t[0x80:] = 0x61
    return t


class Items:
    """Word and shape hashes of the tokens of text chunks."""

    def __init__(self):
        self.hasher, self.classes = W.Hasher(), _class_table()

    def __call__(self, raw: np.ndarray, offsets: np.ndarray):
        """(word, shape, repeats the token before, first token of each row)."""
        solid = raw > 0x20
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(raw)]] = False
        after[edges[edges > 0] - 1] = False
        head = solid & ~before
        starts = np.flatnonzero(head)
        ends = np.flatnonzero(solid & ~after) + 1
        first = np.searchsorted(starts, offsets)
        word = self.hasher.hash_spans(raw, starts, ends)
        kind = self.classes[raw]
        run = head.copy()
        run[1:] |= solid[1:] & (kind[1:] != kind[:-1])
        at = np.flatnonzero(run)
        a = np.searchsorted(at, starts)
        shape = ~self.hasher.hash_spans(kind[at], a, np.append(a[1:], len(at))) if len(starts) else word
        again = np.zeros(len(word), bool)
        again[1:] = word[1:] == word[:-1]
        again[first[:-1][first[:-1] < len(word)]] = False
        return word, shape, again, first

    def rows(self, col: pa.Array):
        raw, offsets = W.text_bytes(col)
        for lo, hi in W.chunks(offsets):
            part = offsets[lo:hi + 1]
            yield lo, *self(raw[part[0]:part[-1]], part - part[0])


def index_vectors(items: np.ndarray, size: int) -> np.ndarray:
    """Fixed sparse random vectors: four places of +1 or -1 for each item hash."""
    out = np.zeros((len(items), size), np.float32)
    for p in range(4):
        h = W.mix(items + np.uint64(0x1000 + p))
        np.add.at(out, (np.arange(len(items)), (h % np.uint64(size)).astype(np.int64)),
                  np.where(h >> np.uint64(63) == 1, np.float32(1), np.float32(-1)))
    return out


def _places(vocabulary: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each item in the sorted vocabulary, and whether it is there."""
    at = np.minimum(np.searchsorted(vocabulary, items), max(0, len(vocabulary) - 1))
    return at, (vocabulary[at] == items if len(vocabulary) else np.zeros(len(items), bool))


def _counts(batches):
    """Task: items of the sample and their counts."""
    get = Items()
    for b in batches:
        found = []
        for _, word, shape, again, _ in get.rows(b.column("text")):
            found += [word, shape, np.full(int(again.sum()), _REPEAT)]
        if found:
            item, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(item.view(np.int64)), pa.array(n)], names=["item", "n"])


def _contexts(vocabulary: np.ndarray, size: int):
    """Task: partial sums of word vectors: index vectors of the words and shapes up to two tokens away."""
    def task(batches):
        get = Items()
        index = index_vectors(vocabulary, size)
        total = np.zeros((len(vocabulary), size), np.float32)
        for b in batches:
            for _, word, shape, again, first in get.rows(b.column("text")):
                row = np.repeat(np.arange(len(first) - 1), np.diff(first))
                w, in_w = _places(vocabulary, word)
                s, in_s = _places(vocabulary, shape)
                mine = index[w] * in_w[:, None] + index[s] * in_s[:, None]
                near = mine.copy()
                for d in (1, 2):
                    same = (row[d:] == row[:-d])[:, None]
                    near[d:] += mine[:-d] * same
                    near[:-d] += mine[d:] * same
                np.add.at(total, w[in_w], near[in_w])
                np.add.at(total, s[in_s], near[in_s])
                r, in_r = _places(vocabulary, np.full(int(again.sum()), _REPEAT))
                np.add.at(total, r[in_r], near[again][in_r])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])
    return task


def pooled(get: Items, col: pa.Array, vocabulary: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Document vectors: mean word vector, mean shape vector, share of repeats, and whether there are tokens."""
    size = vectors.shape[1]
    out = np.zeros((len(col), 2 * size + 2), np.float32)
    padded = np.vstack([vectors, np.zeros((1, size), np.float32)])
    for lo, word, shape, again, first in get.rows(col):
        n = np.diff(first)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        for c, items in enumerate((word, shape)):
            at, known = _places(vocabulary, items)
            at = np.where(known, at, len(vocabulary))
            out[lo + some, c * size:(c + 1) * size] = \
                np.add.reduceat(padded[at], first[:-1][some], axis=0) / n[some, None]
        out[lo + some, 2 * size] = np.add.reduceat(again.astype(np.float32), first[:-1][some]) / n[some]
        out[lo + some, 2 * size + 1] = 1
    return out


class Network:
    """Standardised input, one hidden layer of tanh, one logit; Adam on the log loss; a temperature."""

    def __init__(self, hidden: int = HIDDEN, steps: int = 1500, seed: int = 7):
        self.hidden, self.steps, self.seed = hidden, steps, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        rng = np.random.default_rng(self.seed)
        order = rng.permutation(len(y))
        held = order[: len(y) // 5]
        used = order[len(y) // 5:]
        self.constant = None
        if len(y) < 10 or len(np.unique(y[used])) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        self.mean, self.scale = x[used].mean(0), x[used].std(0) + 1e-6
        d = x.shape[1]
        p = {"w": rng.normal(0, d ** -0.5, (d, self.hidden)), "b": np.zeros(self.hidden),
             "v": rng.normal(0, self.hidden ** -0.5, self.hidden), "c": np.zeros(1)}
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        z, t = (x[used] - self.mean) / self.scale, y[used]
        for step in range(1, self.steps + 1):
            pick = rng.integers(0, len(t), 256)
            a, b = z[pick], t[pick]
            h = np.tanh(a @ p["w"] + p["b"])
            e = (1 / (1 + np.exp(-np.clip(h @ p["v"] + p["c"], -30, 30))) - b) / len(b)
            back = np.outer(e, p["v"]) * (1 - h * h)
            g = {"w": a.T @ back + 1e-4 * p["w"], "b": back.sum(0), "v": h.T @ e + 1e-4 * p["v"],
                 "c": np.array([e.sum()])}
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        self.p = p
        logits, truth = self.logits(x[held]), y[held]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, -logits / g * (2 * truth - 1))) for g in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.p["w"] + self.p["b"])
        return h @ self.p["v"] + self.p["c"]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY,
          size: int = SIZE):
    """(vocabulary, word vectors, network) learned from the documents outside the held-out fold."""
    spark = docs.sparkSession
    free = labels.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = written(spark, labelled_sample(docs, free, "quality", sample), "quality-sample").coalesce(8)
    top = rows.select("text").mapInArrow(_counts, "item long, n long").groupBy("item").agg(F.sum("n").alias("n")) \
        .where("n > 1").orderBy(F.desc("n"), "item").limit(vocabulary).collect()
    words = np.sort(np.array([r["item"] for r in top], np.int64).view(np.uint64))
    vectors = np.zeros((len(words), size), np.float32)
    for part in rows.select("text").mapInArrow(_contexts(words, size), "total binary").toLocalIterator():
        vectors += np.frombuffer(part["total"], np.float32).reshape(vectors.shape)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9

    def features(batches):
        get = Items()
        for b in batches:
            x = pooled(get, b.column("text"), words, vectors)
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["label", "x"])

    got = rows.select("text", "label").mapInArrow(features, "label int, x binary").toPandas()
    x = np.frombuffer(b"".join(bytes(v) for v in got["x"]), np.float32).reshape(len(got), 2 * size + 2)
    y = got["label"].to_numpy(np.float64)
    order = np.lexsort((*x.T[:8], y))  # the same model whatever order the rows come in
    return words, vectors, Network().fit(x[order].astype(np.float64), y[order])


def quality_scores(docs: DataFrame, model) -> DataFrame:
    """(doc_id, k1, k2, score) of every row: the calibrated probability of label 1 under a trained ``model``."""
    sent = shared(docs.sparkSession, model)  # bounded by the parameters of the training

    def task(batches):
        words, vectors, network = received(sent)
        get = Items()
        for b in batches:
            score = network.probability(pooled(get, b.column("text"), words, vectors))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(score)],
                                             names=["doc_id", "k1", "k2", "score"])

    return with_key(docs).mapInArrow(task, "doc_id long, k1 long, k2 long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, learn_from: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``docs`` without those whose score is under ``accept``; where nothing could be learned, all of them stay."""
    model = train(learn_from, labels)
    if model[2].constant is not None:
        return docs
    return keep_columns(docs, quality_scores(docs, model).where(F.col("score") < accept), "left_anti")


def op4_quality(spark, sf_dir):
    """Score and decision for every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
