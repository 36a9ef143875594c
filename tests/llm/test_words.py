"""Vectorised words against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import words
from webfeed.llm import words as W


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é.\n\x00", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_and_hashes(texts, size):
    hasher = W.Hasher()
    seen: dict = {}
    got = []
    for _, hashes, first in W.row_chunks(hasher, pa.array(texts, pa.string()), size):
        got += [hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert [len(x) for x in got] == [len(words(t)) for t in texts]
    for hashes, text in zip(got, texts, strict=True):
        for h, w in zip(hashes, words(text), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_sliced_columns():
    col = pa.array(["a b", None, "c", "d e f"]).slice(2)
    (_, hashes, first), = W.row_chunks(W.Hasher(), col)
    assert first.tolist() == [0, 1, 4] and len(hashes) == 4


def test_shingles():
    hasher = W.Hasher()
    texts = ["", "a", "a b c d", "a b c d e", "a b c d e f", "x a b c d e", "a a a a a a a"]
    (_, hashes, first), = W.row_chunks(hasher, pa.array(texts))
    found, at = W.shingles(hashes, first, 5)
    assert np.diff(at).tolist() == [0, 1, 1, 1, 2, 2, 1]
    sets = [set(found[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert len(sets[3] & sets[4]) == 1 and len(sets[3] & sets[5]) == 1 and not sets[2] & sets[3]


def test_bit_filter_misses_nothing():
    h = W.mix(np.arange(1000, dtype=np.uint64))
    bits = W.BitFilter.empty()
    W.BitFilter.add(bits, h)
    f = W.BitFilter(bits)
    assert f.holds(h).tolist() == list(range(1000))
    assert len(f.holds(W.mix(np.arange(10_000, 20_000, dtype=np.uint64)))) < 10


def test_filters_made_in_slices_are_sized_by_their_hashes(spark, monkeypatch):
    from webfeed.llm.tables import bit_filter

    h = W.mix(np.arange(5000, dtype=np.uint64))
    df = spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "hash long").repartition(5)
    whole = W.BitFilter.empty()
    W.BitFilter.add(whole, h)
    assert bit_filter(df) == whole.tobytes()
    monkeypatch.setattr(W.BitFilter, "SIZE", 1 << 10)
    bits = np.frombuffer(bit_filter(df), np.uint8)
    assert 8 * len(bits) == 1 << 17 and len(W.BitFilter(bits).holds(h)) == 5000
    others = W.mix(np.arange(10_000, 40_000, dtype=np.uint64))
    assert len(W.BitFilter(bits).holds(others)) < 300
    assert not any(bit_filter(df.limit(0)))
    assert W.BitFilter.size_for(10 ** 12) == W.BitFilter.MOST
