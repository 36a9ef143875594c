"""Repeated line runs against brute force."""

import random

import pytest

from llm_cases import awkward, frame, rows_of, words
from webfeed.llm import line_dedup as L


def brute(docs, least):
    """Lines removed from each distinct (doc_id, text), by comparing every pair of places."""
    order = sorted({(d is not None, d or 0, t or "") for d, t in docs})
    lines = [t.split("\n") for *_, t in order]
    gone = {}
    for b, own in enumerate(lines):
        dead = set()
        for a in range(b + 1):
            for diag in range(-len(lines[a]) + 1, len(own)):
                if a == b and diag <= 0:
                    continue
                run = []
                for i in range(max(0, diag), len(own) + 1):
                    if i < len(own) and i - diag < len(lines[a]) and own[i] == lines[a][i - diag]:
                        run.append(i)
                        continue
                    if sum(len(words(own[x])) for x in run) >= least:
                        dead |= set(run)
                    run = []
        known, d, t = order[b]
        gone[(d if known else None, t)] = dead
    return gone


def made(seed):
    rng = random.Random(seed)
    pool = ["a", "b c", "d e f", "", "g h i j k", "The end."]
    return [(d, "\n".join(rng.choice(pool) + (f" {rng.randrange(30)}" if rng.random() < 0.5 else "")
                          for _ in range(rng.randrange(1, 14)))) for d in range(30)]


def kept(text, dead):
    return "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in dead)


@pytest.mark.parametrize(("seed", "least"), [(1, 4), (2, 1), (3, 9)])
def test_against_brute_force(spark, seed, least):
    docs = made(seed)
    docs += [(50, docs[3][1]), (51, docs[3][1] + "\n" + docs[4][1])]
    gone = brute(docs, least)
    got = L.dedup_line_runs(frame(spark, docs), least).select("doc_id", "text", "__wf_gone", "__wf_kept").collect()
    assert {r[0]: (set(r[2] or ()), r[3]) for r in got} == \
        {d: (gone[(d, t)], kept(t, gone[(d, t)])) for d, t in docs}


@pytest.mark.parametrize("least", [1, 4, 9])
def test_words_are_counted_as_far_as_a_run_needs(spark, monkeypatch, least):
    lines = ["", "--", "a", " a", "a-", "\tÜn?ï c_d é!", "K İ x", "a\u2028b", "𝒳 y", ". a . b . c . d .", "1 b 3 d e 6 7 h",
             "x " * 200_000, "-" * 300_000, "y" * 300_000, "-" * 300_000 + " z z z"]
    docs = [(d, "\n".join([f"own {d}", x, f"other {d} " * 9, x, lines[(i + 3) % 6]]))
            for i, x in enumerate(lines) for d in (i, 100 + i)]
    seen, runs = [], L._shortest_runs
    monkeypatch.setattr(L, "_shortest_runs", lambda found, n: seen.extend(found.collect()) or runs(found, n))
    gone = brute(docs, least)
    got = L.dedup_line_runs(frame(spark, docs), least).select("doc_id", "text", "__wf_gone").collect()
    assert {r[0]: set(r[2] or ()) for r in got} == {d: gone[d, t] for d, t in docs}
    texts = [t.split("\n") for _, t in sorted(docs)]
    place = {n: i for i, n in enumerate(sorted({r["dn"] for r in seen}))}  # every document has repeated lines
    assert len(place) == len(docs) and max(r["words"] for r in seen) == least
    assert all(r["words"] == min(len(words(texts[place[r["dn"]]][r["idx"]])), least) for r in seen)


def test_awkward_rows_and_columns(spark):
    docs = [(d, t if t is None or len(t) < 5000 else t[:3000]) for d, t in awkward()]
    gone = brute(docs, 4)
    df = frame(spark, docs)
    got = L.without_repeated_lines(df)
    assert got.dtypes == df.dtypes
    want = []
    for d, t in docs:
        dead = gone[(d, t or "")]
        if len(dead) < len((t or "").split("\n")):
            text = kept(t, dead) if dead else t
            want.append((d, text, len(text or "")))
    assert rows_of(got.select("doc_id", "text", "n_chars")) == sorted(want, key=repr)


def test_empty_table(spark):
    assert L.without_repeated_lines(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert rows_of(L.without_repeated_lines(frame(spark, [(1, None)])).select("doc_id", "text")) == [(1, None)]
