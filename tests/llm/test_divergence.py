"""Source divergence against a plain-Python version."""

import random
import re
from collections import Counter, defaultdict

import pytest

from llm_cases import rows_of
from webfeed.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, gid long, p string"


def brute(rows, min_docs=3, scale=10 ** 9, most=200):
    docs = [(r[2] or "", r[3] or "", TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")))
            for r in rows]
    df, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        n[lang, source].update(terms)
    kept = {lang: sorted(t for t, c in df[lang].items() if c >= min_docs) for lang, _, _ in docs}
    n |= {(lang, None): sum((n[g] for g in list(n) if g[0] == lang), Counter()) for lang in kept}

    def share(g):
        total = sum(n[g][t] for t in kept[g[0]])
        return {t: 1 + scale * (n[g][t] + 1) // (total + len(kept[g[0]])) for t in kept[g[0]]}

    shares = {g: share(g) for g in n}
    out = []
    for lang, source in [g for g in n if g[1] is not None]:
        mine, lang_p = shares[lang, source], shares[lang, None]
        pairs = [(-sum((mine[t] - q[t]) ** 2 // q[t] for t in mine), h[1].encode(), h[1]) for h, q in shares.items()
                 if h[0] == lang and h[1] not in (None, source)]
        terms = [(-((mine[t] - lang_p[t]) ** 2 // lang_p[t]), t.encode(), t) for t in mine
                 if n[lang, source][t] and mine[t] > lang_p[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
            out += [(lang, source, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out, key=repr)


def made(seed, n=150, sources=9):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["Der", "die", "x1y", "Ünï", "é", "l'eau", f"t{chr(97 + rng.randrange(26))}", f"u{'abc'[i % 3]}"])
                         for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), f"s{int(rng.random() ** 2 * sources)}")
            for i in range(n)]
    rows += [(900, None, "en", "s0"), (901, "", "fr", "only"), (902, "one two", "xx", "p"), (903, "two", "xx", None),
             (None, "Ünï die", "en", None), (5, "der die", "de", "s1"), (5, "der die", "de", "s1"), (5, "der die", "de", "s1"),
             (6, "ab\x00cd É é 中文 K", "en", "z"), (7, "die " * 3000, "de", "s1")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("group_block", "term_block"), [(32, 16384), (2, 3), (1, 1)])
def test_against_brute_force(spark, group_block, term_block):
    rows = made(group_block)
    got = divergence.divergences(frame(spark, rows), group_block=group_block, term_block=term_block)
    assert rows_of(got) == brute(rows)


def test_ranks_are_cut_for_terms_only(spark):
    rows = [(i, " ".join(chr(97 + a) + chr(97 + b) for a in range(26) for b in range(10)) + (" zz" * i), "en", f"s{i % 2}")
            for i in range(6)]
    got = divergence.divergences(frame(spark, rows), term_ranks=7)
    assert rows_of(got) == brute(rows, most=7)


def test_no_kept_terms_and_empty_table(spark):
    rows = [(1, "a b", "en", "s"), (2, "c", "en", "t"), (3, "", "de", "s")]
    assert rows_of(divergence.divergences(frame(spark, rows))) == brute(rows) == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert divergence.divergences(frame(spark, rows).limit(0)).count() == 0
