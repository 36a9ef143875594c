"""Quality, language and toxicity: held-out results, what is learned from, awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import awkward, frame, rows_of
from webfeed.llm import langid, quality, toxicity
from webfeed.llm.tables import table

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(np.argsort(score))
    n1 = label.sum()
    return (order[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels").toPandas()


def test_quality_held_out(spark, labels):
    got = quality.op4_quality(spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.score, held.quality) > 0.9 and (held.predicted == held.quality).mean() > 0.9


def test_quality_learns_nothing_from_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs, x) for x in (labels, flipped))
    assert np.array_equal(a[1], b[1]) and np.array_equal(a[2].p["w"], b[2].p["w"])


def test_quality_awkward_rows(spark):
    docs = frame(spark, awkward())
    model = quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    got = quality.quality_scores(docs, model).collect()
    assert len(got) == len(awkward()) and all(0 <= r["score"] <= 1 for r in got)
    untrained = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(docs, untrained, docs).count() == len(awkward())
    kept = quality.keep_good(docs, table(spark, SF, "labels"), table(spark, SF, "documents"))
    assert kept.dtypes == docs.dtypes
    assert quality.quality_scores(docs.limit(0), model).count() == 0


def test_language_held_out(spark):
    docs = table(spark, SF, "documents").toPandas()
    got = langid.op5_language_id(spark, SF).toPandas().merge(docs, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_language_spans_scripts_and_awkward_rows(spark):
    rng = np.random.default_rng(1)
    de, ru = ["und", "nicht", "schule", "haus"], ["и", "дом", "школа", "не"]
    en = ["the", "house", "and", "school"]
    learn = [(i, " ".join(rng.choice(w, 30)), lang) for i, (w, lang) in
             enumerate([(de, "de"), (en, "en"), (ru, "ru"), (en, None)] * 20)]
    mixed = "the house and the school " * 3 + "und nicht schule haus und " * 3 + "дом и школа " * 3 + "12 34"
    asked = [*awkward(), (40, mixed), (41, "12 !!"), (42, "дом"), (43, "und 12")]
    rows = {r["doc_id"]: r for r in langid.identify(frame(spark, asked), frame(spark, learn)).collect()
            if r["doc_id"] not in (None, 3)}
    assert [s["lang"] for s in rows[40]["spans"]][:3] == ["en", "de", "ru"]
    assert [(s["first_word"], s["end_word"]) for s in rows[40]["spans"]][:2] == [(0, 15), (15, 30)]
    assert rows[42]["lang_pred"] == "ru" and rows[43]["lang_pred"] == "de"
    for d in (1, 2, 5, 41):
        assert (rows[d]["lang_pred"], rows[d]["score"]) == ("und", 0.0)
    assert langid.identify(frame(spark, asked), frame(spark, learn)).count() == len(asked)
    nothing = langid.identify(frame(spark, asked), frame(spark, learn).limit(0))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert langid.identify(frame(spark, asked).limit(0), frame(spark, learn)).count() == 0


def test_language_of_letters_outside_the_script_table(spark):
    rng = np.random.default_rng(5)
    bn, ta, ka = ["আমি", "তুমি", "বাংলা", "ভাষা"], ["நான்", "தமிழ்", "மொழி", "இது"], ["მე", "ქართული", "ენა", "ეს"]
    en, vi = ["the", "house", "and", "school"], ["ở", "ấy", "ừ", "ẩm"]
    known = {"bn": bn, "ta": ta, "ka": ka, "en": en, "vi": vi}
    learn = [(i, " ".join(rng.choice(known[lang], 30)), lang) for i, lang in enumerate([*known] * 20)]
    asked = [(n, " ".join(w * 4), lang) for n, (lang, w) in enumerate(known.items())]
    asked += [(10, " ".join(en * 4 + ta * 4)), (11, "2nd “the” house"), (12, "“ – ”"), (13, "১২ ১২")]
    rows = {r["doc_id"]: r for r in langid.identify(frame(spark, asked), frame(spark, learn)).collect()}
    assert [(rows[n]["lang_pred"], rows[n]["score"]) for n in range(5)] == [(lang, 1.0) for lang in known]
    assert [s["lang"] for s in rows[10]["spans"]] == ["en", "ta"]
    assert (rows[11]["lang_pred"], rows[11]["score"]) == ("en", 1.0)
    assert {(rows[n]["lang_pred"], rows[n]["score"]) for n in (12, 13)} == {("und", 0.0)}
    text = "12 “a” ১২ “আমি” – 3д ế".encode()
    raw, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    starts, ends, _ = langid.WordGrams().hasher.spans(raw, offsets)
    x, none = langid.OTHER, langid.NONE
    assert langid.scripts(raw, starts, ends).tolist() == [none, 0, none, x, none, 2, x]


def test_viterbi_against_all_paths():
    import itertools

    rng = np.random.default_rng(2)
    scores = rng.normal(0, 3, (9, 3)).astype(np.float32)
    first = np.array([0, 4, 4, 9])
    path = langid.viterbi(scores, first, 2.0)
    for a, b in ((0, 4), (4, 9)):
        def total(p, a=a, b=b):
            return scores[np.arange(a, b), list(p)].sum() - 2.0 * sum(x != y for x, y in itertools.pairwise(p))
        best = max(itertools.product(range(3), repeat=b - a), key=total)
        assert total(path[a:b]) == pytest.approx(total(best), abs=1e-4)


def test_toxicity_held_out(spark, labels):
    docs, every = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.severities(docs, every.where("doc_id % 2 = 0")).toPandas()
    assert got.severity.between(0, 3).all() and got.grade.between(0, 3).all()
    held = got.merge(every.where("doc_id % 2 = 1").toPandas(), on="doc_id", suffixes=("", "_true"))
    assert auc(held.severity, held.toxic_true) > 0.97
    assert (held[held.toxic_true == 1].toxic == 1).mean() > 0.85
    assert (held[held.toxic_true == 0].toxic == 0).mean() > 0.98


def test_ordinal_recovers_ordered_thresholds():
    rng = np.random.default_rng(3)
    n = 3000
    feature = rng.integers(0, 2, (n, 3))
    z = feature @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=n)
    grade = (z[:, None] > np.array([0.0, 1.5, 3.0])).sum(1)
    row, ids = np.nonzero(feature)
    m = toxicity.Ordinal().fit(grade, row, ids, 8, steps=800, l1=0.0)
    assert np.allclose(m.weights[:3], [2.0, -1.0, 0.0], atol=0.25) and (np.diff(m.thresholds) > 0).all()
    assert np.allclose(m.thresholds, [0.0, 1.5, 3.0], atol=0.25)


def test_toxicity_awkward_rows(spark):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame([(3, 1), (6, 0), (6, 0), (7, 1), (7, 0), (None, 1), (99, 1), (2, None)],
                                   "doc_id long, toxic int")
    got = toxicity.severities(docs, labels).collect()
    assert len(got) == len(awkward())
    none = toxicity.severities(docs, labels.limit(0)).collect()
    assert {(round(r["severity"], 6), r["toxic"]) for r in none} == {(0.0, 0)}
    assert toxicity.severities(docs.limit(0), labels).count() == 0
    assert rows_of(docs.select("doc_id"))


def test_quality_scores_against_plain_python(spark):
    """Every whole text scored token by token by the trained model."""
    import re

    model = quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"), sample=300, vocabulary=500)
    vocabulary, vectors, network = model
    assert network.constant is None
    of = {int(h): i for i, h in enumerate(vocabulary)}
    get = quality.Items()

    def score(text):
        raw = (text or "").encode()
        tokens = re.findall(rb"[^\x00-\x20]+", raw)
        pools = np.zeros((2, vectors.shape[1]))
        again = 0
        for i, token in enumerate(tokens):
            word, shape, _, _ = get(np.frombuffer(token, np.uint8), np.array([0, len(token)]))
            again += i > 0 and token == tokens[i - 1]
            for c, item in enumerate((word[0], shape[0])):
                if int(item) in of:
                    pools[c] += vectors[of[int(item)]]
        n = max(1, len(tokens))
        x = np.concatenate([*(pools / n), [again / n, float(bool(tokens))]])
        z = (x - network.mean) / network.scale
        h = np.tanh(z @ network.p["w"] + network.p["b"])
        return 1 / (1 + np.exp(-(h @ network.p["v"] + network.p["c"][0]) / network.temperature))

    docs = [(r[0], r[1]) for r in table(spark, SF, "documents").select("doc_id", "text").limit(60).collect()] + awkward()
    got = sorted((tuple(r) for r in quality.quality_scores(frame(spark, docs), model).select("doc_id", "score").collect()), key=repr)
    expected = sorted([(d, score(t)) for d, t in docs], key=repr)
    by_id = lambda rows: sorted(((repr(d), s) for d, s in rows))
    for (a, x), (b, y) in zip(by_id(got), by_id(expected), strict=True):
        assert a == b and abs(x - y) < 1e-4


def test_samples_are_bounded_by_documents(spark):
    from webfeed.llm.labelled import labelled_sample

    docs = [(1, f"text {i}") for i in range(50)] + [(i, "other") for i in range(2, 12)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    got = labelled_sample(frame(spark, docs), labels, "quality", 20).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 12))
    assert labelled_sample(frame(spark, docs), labels, "quality", 4).count() == 4


def test_a_rare_language_is_learned(spark):
    rng = random.Random(1)
    common = [(i, " ".join(rng.choice(["the", "and", "house", "garden"]) for _ in range(20)), "en") for i in range(600)]
    rare = [(10_000 + i, " ".join(rng.choice(["og", "hvis", "huset", "haven"]) for _ in range(20)), "da") for i in range(6)]
    docs = frame(spark, common + rare)
    languages, *_ = langid.train(docs, sample=20)
    assert languages == ["da", "en"]
    assert langid.train(docs, most=1)[0] == ["en"]
