"""Seeds against all substitutions, and the operator against brute force."""

import itertools
import math
import random

import pytest

from llm_cases import awkward, frame, prose, rows_of, words
from webfeed.llm import decontaminate as D


def test_masks_hit_every_window_with_four_substitutions():
    ones = [[i for i, c in enumerate(m) if c == "1"] for m in D.MASKS]
    for bad in itertools.combinations(range(D.WINDOW), 4):
        good = set(range(D.WINDOW)) - set(bad)
        assert any(all(p + i in good for i in on) for m, on in zip(D.MASKS, ones, strict=True)
                   for p in range(D.WINDOW - len(m) + 1)), bad


@pytest.mark.parametrize("size", range(D.MIN_ITEM_WORDS, D.WINDOW + 1))
def test_masks_hit_every_shorter_window(size):
    ones = [[i for i, c in enumerate(m) if c == "1"] for m in D.MASKS]
    for bad in itertools.combinations(range(size), size - math.ceil(D.AGREE * size - 1e-9)):
        good = set(range(size)) - set(bad)
        assert any(all(p + i in good for i in on) for m, on in zip(D.MASKS, ones, strict=True)
                   for p in range(size - len(m) + 1)), bad


def brute(docs, items):
    out = set()
    for doc_id, text in docs:
        d = words(text)
        for item_id, item in items:
            i = words(item)
            w = min(D.WINDOW, len(i))
            if len(i) < D.MIN_ITEM_WORDS:
                continue
            for diag in range(w - len(i), len(d) - w + 1):
                eq = [0 <= x - diag < len(i) and d[x] == i[x - diag] for x in range(max(0, diag), min(len(d), diag + len(i)))]
                if any(sum(eq[a:a + w]) >= math.ceil(D.AGREE * w) for a in range(len(eq) - w + 1)):
                    out.add((doc_id, item_id))
                    break
    return out


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_against_brute_force(spark, broadcast):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([20, 24, 40]))) for i in range(12)]
    docs = []
    for n in range(60):
        text = prose(rng, 80).split()
        part = items[n % 12][1].split()[: rng.choice([15, 20, 40])]
        for _ in range(rng.choice([0, 0, 2, 4, 5, 8])):
            part[rng.randrange(len(part))] = "subst"
        at = rng.randrange(len(text))
        docs.append((n, " ".join(text[:at] + part + text[at:]) if n % 3 else " ".join(text)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.overlaps(frame(spark, docs), bench, broadcast_seeds=broadcast).select("doc_id", "item_id").collect()
    assert {tuple(r) for r in got} == brute(docs, items)


def test_short_items_with_substitutions(spark):
    rng = random.Random(4)
    items, docs = [], []
    for n, bad in enumerate([(1, 9), (2, 9), (4, 7), (4, 6, 9), (4, 7, 10), (7, 9, 10), (7, 10, 11), (1, 4, 7, 9)]):
        items.append((n, prose(rng, 12 if len(bad) == 2 else 15)))
        part = items[-1][1].split()
        for i in bad:
            part[i] = "subst"
        docs.append((n, f"{prose(rng, 30)} {' '.join(part)} {prose(rng, 30)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in D.overlaps(frame(spark, docs), bench).select("doc_id", "item_id").collect()}
    assert got == brute(docs, items) == {(n, n) for n in range(7)}


def test_items_under_twelve_words_and_scripts_without_spaces(spark):
    rng = random.Random(6)
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(30))
    thai = "".join(chr(0xE01 + rng.randrange(40)) for _ in range(14))
    rare = "".join(chr(0x20000 + rng.randrange(5000)) for _ in range(14))
    items = [(1, "What is the boiling point of water?"), (2, "one two three"), (3, "too short"), (4, prose(rng, 11)),
             (5, f"{han}\u3002"), (6, thai), (7, han[:5]), (8, f"{rare} ?")]
    docs = [(1, f"{prose(rng, 30)} what is the BOILING point, of water {prose(rng, 5)} what is the boiling point of water"),
            (2, "one two three"), (3, "one two four three too short"), (4, items[3][1].replace(" ", "\n")),
            (5, " ".join(["subst", *items[3][1].split()[1:]])), (6, f"abc{han[:10]}\u4dff{han[11:]}\u3002xyz"),
            (7, f"\u0e50{thai[:-1]}\u0e51{thai}"), (8, han[20:] + han[:4]), (9, rare + thai[:3]), (10, "x" + han[:5])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_equal, r.first_word, r.end_word) for r in D.overlaps(frame(spark, docs), bench).collect()}
    assert set(got) == {(1, 1), (2, 2), (4, 4), (6, 5), (6, 7), (7, 6), (9, 8), (10, 7)}
    assert got[1, 1] == (7, 30, 37) and got[4, 4] == (11, 0, 11) and got[10, 7] == (5, 1, 6) and got[9, 8] == (14, 0, 14)


def test_awkward_rows(spark):
    docs = awkward()
    base = docs[0][1]
    items = [(1, " ".join(base.split()[10:60])), (None, base), (1, "short item"), (2, None), (2, ""), (3, "a a a " * 20)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("text", "Text")
    got = rows_of(D.overlaps(frame(spark, docs), bench).select("doc_id", "item_id").distinct())
    hit = [d for d, t in docs if t and base in t]
    assert got == sorted({(d, i) for d in hit for i in (1, None)}, key=repr)
    kept = D.without_contaminated(frame(spark, docs), bench)
    assert kept.columns == frame(spark, docs).columns
    assert sorted(map(repr, (r[0] for r in kept.collect()))) == sorted(repr(d) for d, t in docs if not (t and base in t))


def test_empty_tables(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    bench = spark.createDataFrame([(1, "word " * 30)], "item_id long, text string")
    assert D.overlaps(none, bench).count() == 0
    assert D.overlaps(frame(spark, awkward()), bench.limit(0)).count() == 0
