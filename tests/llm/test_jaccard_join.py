"""Classes and links against brute force."""

import random

import pytest

from llm_cases import awkward, frame, prose, rows_of, words
from webfeed.llm import jaccard_join as J


def brute(docs, threshold=J.THRESHOLD):
    def runs(text):
        w = words(text)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = [runs(t) for _, t in docs]
    near = [[j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= threshold * len(a | b) - 1e-9]
            for i, a in enumerate(sets)]
    out = []
    for i, (d, _) in enumerate(docs):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen |= set(new)
            todo += new
        out.append((d, min((docs[j][0] for j in seen if docs[j][0] is not None), default=None), len(near[i])))
    return sorted(out, key=repr)


def made(seed, group=25):
    rng = random.Random(seed)
    docs, d = [], 0
    for size, copies in ((120, 8), (300, 3), (60, group), (8, 4), (4, 3)):
        base = prose(rng, size).split()
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, max(1, size // 60)])):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10 ** 6)}"
            docs.append((d, " ".join(text)))
            d += 1
    return docs


@pytest.mark.parametrize("blocks", [(1024, 256), (4, 3)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(J, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(J, "GROUP_BLOCK", blocks[1])
    docs = made(1)
    got = J.jaccard_classes(frame(spark, docs)).select("doc_id", "class_id", "n_links")
    assert rows_of(got) == brute(docs)


def test_awkward_rows_and_one_of_each_class(spark):
    docs = awkward()
    df = frame(spark, docs)
    assert rows_of(J.jaccard_classes(df).select("doc_id", "class_id", "n_links")) == brute(docs)
    kept = J.keep_one_per_class(df)
    assert kept.dtypes == df.dtypes
    # Null ids come last; texts without words stay, each by itself.
    assert sorted(repr(r[0]) for r in kept.collect()) == sorted(map(repr, [-4, None, 1, 2, 5, 6, 8, 10, 11]))


def test_posterior_keeps_likely_pairs():
    looks = J.least_matches(0.8, 1e-6, 128, 16)
    assert [n for n, _ in looks] == list(range(16, 129, 16))
    assert all(0 <= m < 0.8 * n for n, m in looks) and looks[-1][1] > 70


def test_empty_table(spark):
    assert J.jaccard_classes(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert rows_of(J.jaccard_classes(frame(spark, [(1, None)])).select("doc_id", "class_id", "n_links", "stays")) == \
        [(1, 1, 0, True)]
