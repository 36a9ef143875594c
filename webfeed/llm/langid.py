"""Language identification: script ranges narrow the candidates, then Viterbi over per-word scores.

A word's script (code-point range of its first letter) leaves those languages that write at least
``SCRIPT_SHARE`` of their words in it; letters outside the ranges leave all languages, words without any
letter tell nothing; a word's score under a language is the log
probability of its hashed byte n-grams (1 to 4 bytes with word ends, and the whole word). The best path
through a document's words, with a penalty for each switch of language, labels spans; the document's
language is the one that labels most letters (bytes of words), ties to the smaller name.

Learning uses at most ``SAMPLE`` documents of each language (smallest id hashes) outside the held-out fold, and
the ``LANGUAGES`` languages with most documents; prediction reads every whole text.

Edge cases: null texts and texts without any letter are ``und`` with score 0; every row gives one output
row; a null doc_id counts as the empty text for its fold; null languages are not learned; without any
learned language every text is ``und``; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfeed.llm import words as W
from webfeed.llm.labelled import fold
from webfeed.llm.tables import received, shared, table, with_key, written

SAMPLE, LANGUAGES, BUCKETS, SWITCH, SCRIPT_SHARE = 2_000, 256, 1 << 16, 6.0, 0.01
FOLDS, HELD_OUT, UNKNOWN = 3, 1, "und"
#: Text handled at a time, for four languages; Viterbi steps through all documents of a chunk together.
CHUNK = 8 << 20
# First and last code points of script blocks.
SCRIPTS = [("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
           ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("devanagari", 0x900, 0x97F),
           ("thai", 0xE00, 0xE7F), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF), ("han", 0x4E00, 0x9FFF)]


#: Classes of words besides the scripts: letters of other blocks, no letter at all.
OTHER, NONE = len(SCRIPTS), len(SCRIPTS) + 1


def _classes() -> np.ndarray:
    """Class of every code point: its script, OTHER for other letters, NONE for what is no letter."""
    letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)), bool)
    out = np.where(letter, OTHER, NONE).astype(np.int8)
    for i, (_, lo, hi) in enumerate(SCRIPTS):
        out[lo:hi + 1][letter[lo:hi + 1]] = i
    return out


def _first_code_points(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code point that begins at each byte place (UTF-8)."""
    padded = np.append(raw, np.zeros(3, np.uint8)).astype(np.int64)
    a, b, c, d = (padded[starts + i] for i in range(4))
    return np.select([a < 0x80, a < 0xE0, a < 0xF0],
                     [a, (a & 0x1F) << 6 | b & 0x3F, (a & 0xF) << 12 | (b & 0x3F) << 6 | c & 0x3F],
                     (a & 7) << 18 | (b & 0x3F) << 12 | (c & 0x3F) << 6 | d & 0x3F)


def scripts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
    """Class of each word's first letter; NONE where it has none (digits, signs). ``classes``: those of all code points."""
    classes = _classes() if classes is None else classes
    out = classes[_first_code_points(raw, starts)].astype(np.int64)
    rest = np.flatnonzero(out == NONE)
    n = (ends - starts)[rest]
    owner = np.repeat(rest, n)
    at = np.arange(int(n.sum())) + np.repeat(starts[rest] - (np.cumsum(n) - n), n)
    head = (raw[at] & 0xC0) != 0x80
    owner, kind = owner[head], classes[_first_code_points(raw, at[head])]
    owner, kind = owner[kind != NONE], kind[kind != NONE]
    word, place = np.unique(owner, return_index=True)
    out[word] = kind[place]
    return out


class WordGrams:
    """Distinct words of a chunk and the hashed n-grams of each."""

    def __init__(self):
        self.hasher = W.Hasher()

    def __call__(self, raw: np.ndarray, offsets: np.ndarray):
        low = self.hasher.lower[raw]
        starts, ends, first = self.hasher.spans(raw, offsets)
        hashes = np.concatenate([self.hasher.hash_spans(low[offsets[lo]:offsets[hi]],
                                                        starts[first[lo]:first[hi]] - offsets[lo],
                                                        ends[first[lo]:first[hi]] - offsets[lo])
                                 for lo, hi in W.chunks(offsets)]) if len(starts) else np.zeros(0, np.uint64)
        word, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        return low, starts, ends, first, word, at, which

    @staticmethod
    def grams(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: np.ndarray, buckets: int):
        """(n-gram bucket, word number) pairs, word by word in no fixed order."""
        n = ends - starts + 2  # with a sign for either end
        first = np.cumsum(n) - n
        text = np.zeros(int(n.sum()), np.uint64)
        inner = np.arange(int((n - 2).sum()))
        inside = inner - np.repeat(np.cumsum(n - 2) - (n - 2), n - 2)
        text[inside + np.repeat(first + 1, n - 2)] = low[inside + np.repeat(starts, n - 2)]
        text[first], text[first + n - 1] = 1, 2
        owner = np.repeat(np.arange(len(n)), n)
        last = (first + n)[owner]
        out, who = [word % np.uint64(buckets)], [np.arange(len(n))]
        h = np.zeros(len(text), np.uint64)
        for size in range(1, 5):
            m = len(text) - size + 1
            if m <= 0:
                break
            h = W.mix(h[:m] * np.uint64(257) + text[size - 1:] + np.uint64(size))
            fits = np.flatnonzero(np.arange(m) + size <= last[:m])
            out.append(h[fits] % np.uint64(buckets))
            who.append(owner[fits])
        return np.concatenate(out).astype(np.int64), np.concatenate(who)


def _counts(languages: list[str], buckets: int):
    """Task: sample texts -> counts of n-grams and of scripts by language, one row for the task."""
    number = {name: i for i, name in enumerate(languages)}

    def task(batches):
        get, classes = WordGrams(), _classes()
        grams = np.zeros((len(languages), buckets))
        script = np.zeros((len(languages), NONE + 1))
        for b in batches:
            lang = np.array([number[x] for x in b.column("lang").to_pylist()])
            for name in np.unique(lang):
                raw, offsets = W.text_bytes(b.column("text").take(pa.array(np.flatnonzero(lang == name))))
                for lo, hi in W.chunks(offsets, CHUNK):
                    part = offsets[lo:hi + 1]
                    own = raw[part[0]:part[-1]]
                    low, starts, ends, _, word, at, which = get(own, part - part[0])
                    if not len(word):
                        continue
                    n = np.bincount(which, minlength=len(word))
                    bucket, who = get.grams(low, starts[at], ends[at], word, buckets)
                    grams[name] += np.bincount(bucket, weights=n[who], minlength=buckets)
                    script[name] += np.bincount(scripts(own, starts[at], ends[at], classes), weights=n, minlength=NONE + 1)
        yield pa.RecordBatch.from_arrays([pa.array([grams.tobytes()], pa.binary()),
                                          pa.array([script.tobytes()], pa.binary())], names=["grams", "scripts"])
    return task


def train(docs: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS, most: int = LANGUAGES):
    """(languages, log probabilities by n-gram and language, candidates by script and language).

    Learned from ``sample`` documents of each language at most, those whose ids have the smallest hashes, and from the
    ``most`` languages with most documents; of documents that repeat an id one of each language counts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    ids = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct()
    common = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most).select("lang")
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = ids.join(F.broadcast(common), "lang").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample)
    # bounded by the two parameters
    found = rows.join(F.broadcast(chosen.select("lang", "doc_id")), ["lang", "doc_id"]).groupBy("lang", "doc_id") \
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    part = written(spark, found.select("lang", "text"), "language-sample").coalesce(8)
    languages = sorted(r["lang"] for r in part.select("lang").distinct().collect())  # at most ``most``
    grams, script = np.zeros((len(languages), buckets)), np.zeros((len(languages), NONE + 1))
    if languages:
        for r in part.mapInArrow(_counts(languages, buckets), "grams binary, scripts binary").toLocalIterator():
            grams += np.frombuffer(r["grams"]).reshape(grams.shape)
            script += np.frombuffer(r["scripts"]).reshape(script.shape)
    grams += 0.5
    logs = np.log(grams / grams.sum(1, keepdims=True)).T.astype(np.float32)
    share = script / np.maximum(script.sum(1, keepdims=True), 1)
    candidates = (share >= SCRIPT_SHARE).T
    candidates[~candidates.any(1)] = True  # a script that no language uses tells nothing
    candidates[OTHER:] = True
    return languages, np.ascontiguousarray(logs), candidates


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word; ``first``: first word of each document (and the end)."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    n, start = n[order], first[:-1][order]
    steps = int(n[0]) if len(n) else 0
    came = np.zeros(scores.shape, bool)
    best_before = np.zeros(len(scores), np.int16)
    active = np.searchsorted(-n, -np.arange(steps), side="left")
    value = np.zeros((len(n), scores.shape[1]), scores.dtype)
    for t in range(steps):
        k = active[t]
        at = start[:k] + t
        if t == 0:
            value[:k] = scores[at]
            continue
        v = value[:k]
        top = v.argmax(1)
        over = v[np.arange(k), top][:, None] - switch
        jump = over > v
        came[at], best_before[at] = jump, top
        value[:k] = np.where(jump, over, v) + scores[at]
    path = np.zeros(len(scores), np.int16)
    state = value.argmax(1)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = start[:k] + t
        path[at] = state[:k]
        if t:
            jump = came[at, state[:k]]
            state[:k] = np.where(jump, best_before[at], state[:k])
    return path


def _label(model, spans: bool):
    def task(batches):
        languages, logs, candidates, classes = received(model)
        get, buckets, count = WordGrams(), logs.shape[0], len(languages)
        for b in batches:
            raw, offsets = W.text_bytes(b.column("text"))
            letters = b.column("letters").to_numpy(zero_copy_only=False)
            for lo, hi in W.chunks(offsets, CHUNK * 4 // max(4, count)):
                part = offsets[lo:hi + 1]
                own = raw[part[0]:part[-1]]
                low, starts, ends, first, word, at, which = get(own, part - part[0])
                docs = hi - lo
                share = np.zeros((docs, max(1, count)))
                path = np.zeros(len(starts), np.int16)
                if count and len(word):
                    bucket, who = get.grams(low, starts[at], ends[at], word, buckets)
                    score = np.stack([np.bincount(who, weights=logs[bucket, j], minlength=len(word))
                                      for j in range(count)], 1)
                    score -= np.logaddexp.reduce(score, axis=1, keepdims=True)
                    np.maximum(score, -12, out=score)  # one word never outweighs many
                    kind = scripts(own, starts[at], ends[at], classes)
                    score = np.where(candidates[kind], score, -24)
                    score[kind == NONE] = 0
                    path = viterbi(score.astype(np.float32)[which], first, SWITCH)
                    weight = (ends - starts).astype(np.float64)
                    weight[(kind == NONE)[which]] *= 1e-6  # digits and signs only break ties
                    row = np.repeat(np.arange(docs), np.diff(first))
                    share = np.bincount(row * count + path, weights=weight, minlength=docs * count) \
                        .reshape(docs, count)
                total = share.sum(1)
                known = letters[lo:hi] & (total > 0)
                top = share.argmax(1)
                ok = np.where(known, share[np.arange(docs), top] / np.where(total > 0, total, 1), 0.0)
                names = [languages[t] if k else UNKNOWN for t, k in zip(top, known, strict=True)]
                change = np.ones(len(path), bool)
                change[1:] = path[1:] != path[:-1]
                change[first[:-1][first[:-1] < len(path)]] = True
                change &= count > 0
                head = np.flatnonzero(change)
                cut = np.searchsorted(head, first)
                out = [b.column("doc_id").slice(lo, docs), pa.array(names), pa.array(ok),
                       pa.array(np.diff(cut).astype(np.int64))]
                fields = ["doc_id", "lang_pred", "score", "n_spans"]
                if spans:
                    row = np.repeat(np.arange(docs), np.diff(first))
                    end = np.append(head[1:], len(path))
                    base = first[row[head]] if len(head) else head
                    out.append(pa.ListArray.from_arrays(
                        pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays(
                            [pa.array((head - base).astype(np.int64)), pa.array((end - base).astype(np.int64)),
                             pa.array([languages[p] for p in path[head]], pa.string())],
                            names=["first_word", "end_word", "lang"])))
                    fields.append("spans")
                yield pa.RecordBatch.from_arrays(out, names=fields)
    return task


def identify(docs: DataFrame, learn_from: DataFrame, spans: bool = True, **parameters) -> DataFrame:
    """(doc_id, lang_pred, score, n_spans[, spans]) of every row of ``docs``.

    ``spans``: word ranges (from 0) with their language; ``score``: share of the letters in ``lang_pred``.
    """
    model = shared(docs.sparkSession, (*train(learn_from, **parameters), _classes()))  # bounded by its parameters
    schema = "doc_id long, lang_pred string, score double, n_spans long"
    if spans:
        schema += ", spans array<struct<first_word: long, end_word: long, lang: string>>"
    rows = with_key(docs).select("doc_id", "text", F.col("text").rlike(r"\p{L}").alias("letters"))
    return rows.mapInArrow(_label(model, spans), schema)


def op5_language_id(spark, sf_dir):
    """Language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, docs).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "n_spans", "spans")
