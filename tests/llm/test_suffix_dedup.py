"""Repeated passages against brute force."""

import collections
import random

import pytest

from llm_cases import awkward, frame, prose, rows_of, words
from webfeed.llm import suffix_dedup as S


def brute(docs, least):
    first = collections.defaultdict(list)
    for d, text in docs:
        w = words(text)
        for i in range(len(w) - least + 1):
            first[tuple(w[i:i + least])].append(d)
    out = []
    for d, text in docs:
        w, span = words(text), None
        for i in range(len(w) - least + 1):
            holders = first[tuple(w[i:i + least])]
            if len(holders) < 2:
                continue
            low = min((h for h in holders if h is not None), default=None)
            if span and i <= span[1]:
                span[1], span[2] = i + least, min((x for x in (span[2], low) if x is not None), default=None)
            else:
                if span:
                    out.append((d, *span))
                span = [i, i + least, low]
        if span:
            out.append((d, *span))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (49, 50, 51, 70, 130)]
    docs = []
    for d in range(40):
        parts = [prose(rng, rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), prose(rng, rng.randrange(40))]
        docs.append((d, " ".join(parts)))
    # Partly shared stretches: right or left halves with other surroundings, and runs of one word.
    a, b = passages[4].split()[:65], passages[4].split()[30:]
    docs += [(100, " ".join(a) + " x " + prose(rng, 50)), (101, prose(rng, 50) + " y " + " ".join(b)),
             (102, "the " * 90), (103, "z " + "the " * 60), (104, passages[3] + " " + passages[3])]
    return docs


@pytest.mark.parametrize("sort_most", [100_000, 1])
def test_against_brute_force(spark, sort_most):
    docs = made(1)
    got = S.repeated_spans(frame(spark, docs), sort_most=sort_most)
    assert rows_of(got.select("doc_id", "first_word", "end_word", "first_id")) == brute(docs, 50)


def test_other_lengths(spark):
    docs = made(2)
    got = S.repeated_spans(frame(spark, docs), min_words=30, gram=6)
    assert rows_of(got.select("doc_id", "first_word", "end_word", "first_id")) == brute(docs, 30)


def test_awkward_rows(spark):
    docs = awkward()
    got = S.repeated_spans(frame(spark, docs)).select("doc_id", "first_word", "end_word", "first_id")
    assert rows_of(got) == brute(docs, 50)


def test_a_row_delivered_many_times(spark):
    """Every copy gets its spans; what is found is found once."""
    docs = [(1, prose(random.Random(1), 80))] * 200 + [(2, "x " + prose(random.Random(1), 80)), (None, prose(random.Random(1), 55))] * 2
    got = S.repeated_spans(frame(spark, docs)).select("doc_id", "first_word", "end_word", "first_id")
    assert rows_of(got) == brute(docs, 50) and got.count() == 204


def test_empty_table(spark):
    assert S.repeated_spans(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert S.repeated_spans(frame(spark, [(1, "a b c"), (2, None)])).count() == 0
