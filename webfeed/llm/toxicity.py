"""Toxicity: cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their beginnings (stems that inflect), hashed to
``FEATURES`` places. Severity grades 0 to 3 of the
sample come from its labels: not toxic is 0; a toxic document has 1, 2 or 3 by the number of its
distinct indicative features (one at most; up to three; more), a feature being indicative when its smoothed
odds among toxic documents of the sample are ``INDICATIVE`` times those among the others. The model has
one weight per feature, shared by all grades, and ordered thresholds: P(grade > k) = s(w.x - t_k). It is
fitted by proximal Adam with an L1 penalty, so most weights are zero. The expected severity is the sum
of P(grade > k) over k; a document is called toxic when P(grade > 0) is at least one half.

Learning uses at most ``SAMPLE`` labelled documents (smallest id hashes); scoring reads every whole text.

Edge cases: null and empty texts have no features; every row gives one output row; other columns, and
labels of unknown ids, are ignored; with no labelled documents, or of one kind only, there are no
weights, and every text gets the share of toxic documents in the sample (0 without any) as P(grade > 0)
and 0 above; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.labelled import labelled_sample
from webfeed.llm.tables import received, shared, table, with_key, written

SAMPLE, FEATURES, GRADES, INDICATIVE = 12_000, 1 << 18, 4, 12.0
#: Features whose odds differ less than this between toxic and other documents get no weight.
SCREEN = 1.5
#: Lengths (bytes) of the word beginnings that are features besides the words.
PREFIXES = (4, 5, 6, 7)


def _lowered(hasher: W.Hasher, raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the accented capitals of Latin-1 (UTF-8: C3 80 to C3 9E) in lower case."""
    low = hasher.lower[raw]
    capital = np.flatnonzero((raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)) + 1
    low[capital] += 0x20
    return low


def _features(hasher: W.Hasher, col: pa.Array):
    """(first row, distinct features of each row, offsets by row) for chunks of texts."""
    raw, offsets = W.text_bytes(col)
    for lo, hi in W.chunks(offsets):
        part = offsets[lo:hi + 1] - offsets[lo]
        low = _lowered(hasher, raw[offsets[lo]:offsets[hi]])
        starts, ends, first = hasher.spans(low, part)
        row = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(first))
        found = [row * FEATURES + (hasher.hash_spans(low, starts, ends) % np.uint64(FEATURES)).astype(np.int64)]
        for n in PREFIXES:
            longer = np.flatnonzero(ends - starts > n)
            h = W.mix(hasher.hash_spans(low, starts[longer], starts[longer] + n) + np.uint64(n))
            found.append(row[longer] * FEATURES + (h % np.uint64(FEATURES)).astype(np.int64))
        both = np.unique(np.concatenate(found))
        yield lo, both % FEATURES, np.searchsorted(both, np.arange(hi - lo + 1, dtype=np.int64) * FEATURES)


def _sample_features(batches):
    hasher = W.Hasher()
    for b in batches:
        out = []
        for _, ids, cut in _features(hasher, b.column("text")):
            out += [ids[a:z].astype(np.int32).tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(out, pa.binary())], names=["label", "ids"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _odds(label: np.ndarray, row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds of each feature among toxic documents over those among the others, and toxic documents with it."""
    toxic = label > 0
    with_t = np.bincount(ids[toxic[row]], minlength=FEATURES)
    with_c = np.bincount(ids[~toxic[row]], minlength=FEATURES)
    return (with_t + 0.5) / (toxic.sum() + 1) / ((with_c + 0.5) / ((~toxic).sum() + 1)), with_t


def grades(label: np.ndarray, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Severity grade of each sample document from its label and its indicative features."""
    odds, with_t = _odds(label, row, ids)
    n = np.bincount(row, weights=((odds >= INDICATIVE) & (with_t >= 3))[ids], minlength=len(label))
    return np.where(label > 0, 1 + (n > 1) + (n > 3), 0)


class Ordinal:
    """Cumulative-link (logit) regression with shared weights and ordered thresholds."""

    def fit(self, grade: np.ndarray, row: np.ndarray, ids: np.ndarray, size: int, levels: int = GRADES,
            steps: int = 400, rate: float = 0.05, l1: float = 1e-4) -> Ordinal:
        n = len(grade)
        above = grade[:, None] > np.arange(levels - 1)[None, :]
        self.weights = np.zeros(size)
        share = above.mean(0) if n else np.zeros(levels - 1)
        if n == 0 or share[0] in (0.0, 1.0):
            self.thresholds = -np.log(np.clip(share, 1e-15, 1 - 1e-15) / (1 - np.clip(share, 1e-15, 1 - 1e-15)))
            return self
        share = np.clip(share, 0.5 / n, 1 - 0.5 / n)
        # t_0 and the logs of the steps between thresholds, so that they stay ordered.
        t = -np.log(share / (1 - share))
        free = np.concatenate([t[:1], np.log(np.maximum(np.diff(t), 1e-2))])
        m, s = np.zeros(size), np.zeros(size)
        fm, fs = np.zeros(len(free)), np.zeros(len(free))
        rows = np.searchsorted(row, np.arange(n))
        full = np.flatnonzero(np.bincount(row, minlength=n))
        for step in range(1, steps + 1):
            t = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            score = np.zeros(n)
            score[full] = np.add.reduceat(self.weights[ids], rows[full])
            # P(grade = k) as a difference of neighbours; its logarithm's slope in the score and thresholds.
            p = _sigmoid(score[:, None] - t[None, :])
            upper = np.concatenate([np.ones((n, 1)), p], 1)
            lower = np.concatenate([p, np.zeros((n, 1))], 1)
            own = np.arange(n)
            a, b = upper[own, grade], lower[own, grade]
            mass = np.maximum(a - b, 1e-12)
            da, db = a * (1 - a), b * (1 - b)
            slope = -(da - db) / mass / n  # of the negative log likelihood, in the score
            g = np.bincount(ids, weights=slope[row], minlength=size)
            gt = np.zeros(len(t))
            np.add.at(gt, grade[grade > 0] - 1, (da / mass / n)[grade > 0])
            low = grade < levels - 1
            np.add.at(gt, grade[low], (-db / mass / n)[low])
            back = np.cumsum(gt[::-1])[::-1]
            gf = np.concatenate([back[:1], back[1:] * np.exp(free[1:])])
            for x, grad, first, second, penalty in ((self.weights, g, m, s, l1), (free, gf, fm, fs, 0.0)):
                first *= 0.9
                first += 0.1 * grad
                second *= 0.999
                second += 0.001 * grad * grad
                pace = rate / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-5)
                x -= pace * first / (1 - 0.9 ** step)
                if penalty:
                    np.copyto(x, np.sign(x) * np.maximum(np.abs(x) - pace * penalty, 0))
        self.thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        return self

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    rows = labelled_sample(docs, labels, "toxic", sample).select("text", "label")
    got = written(docs.sparkSession, rows.mapInArrow(_sample_features, "label int, ids binary"), "toxic-sample").toPandas()
    parts = [np.frombuffer(bytes(x), np.int32) for x in got["ids"]]
    order = sorted(range(len(parts)), key=lambda i: (int(got["label"][i]), parts[i].tobytes()))
    parts = [parts[i] for i in order]
    label = got["label"].to_numpy()[order] if order else np.zeros(0, int)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    grade = grades(label, row, ids).astype(int)
    odds, _ = _odds(label, row, ids)
    tells = (np.maximum(odds, 1 / odds) >= SCREEN)[ids]  # the others get no weight
    ids, row = ids[tells], row[tells]
    return Ordinal().fit(grade, row, ids, FEATURES)


def severities(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic) of every row; ``grade`` is the likeliest."""
    model = shared(docs.sparkSession, train(docs, labels, **parameters))  # bounded by FEATURES

    def task(batches):
        ordinal = received(model)
        hasher = W.Hasher()
        for b in batches:
            score = np.zeros(len(b))
            for lo, ids, cut in _features(hasher, b.column("text")):
                some = np.flatnonzero(np.diff(cut))
                if len(some):
                    score[lo + some] = np.add.reduceat(ordinal.weights[ids], cut[:-1][some])
            p = ordinal.above(score)
            each = np.concatenate([np.ones((len(b), 1)), p], 1) - np.concatenate([p, np.zeros((len(b), 1))], 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(p[:, 0]),
                 pa.array((p[:, 0] >= 0.5).astype(np.int32))],
                names=["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return with_key(docs).mapInArrow(task, "doc_id long, severity double, grade int, p_toxic double, toxic int")


def op9_toxicity(spark, sf_dir):
    """Expected severity, grade and decision for every whole text of ``documents``."""
    return severities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
