"""Byte-level BPE against tiktoken, and the round trip."""

import hashlib

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken

from llm_cases import awkward, frame, rows_of
from webfeed.llm import bpe

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def want(encoding, docs):
    out = []
    for d, t in docs:
        ids = encoding.encode_ordinary(t or "")
        raw = np.array(ids, "<u4").tobytes()
        out.append((d, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_tiktoken(spark, encoding):
    docs = [*awkward(), (20, "日本語 <|endoftext|> 'S 're don't  \n\n  x 　y 😀😀 १२३ ab12"), (21, " " * 50 + "\t\tend  ")]
    got = bpe.encode_digests(frame(spark, docs), PATH, tokenizers.PATTERN)
    assert rows_of(got) == want(encoding, docs)


def test_small_bundles_and_round_trip(spark, encoding):
    docs = [(i, t) for i, (_, t) in enumerate(awkward())]
    encoded = bpe.encode(frame(spark, docs), PATH, tokenizers.PATTERN, bundle_bytes=200)
    got = {r["doc_id"]: r for r in bpe.decode(encoded, PATH).collect()}
    for d, t in docs:
        assert np.frombuffer(bytes(got[d]["ids"]), "<u4").tolist() == encoding.encode_ordinary(t or "")
        assert bytes(got[d]["decoded"]).decode() == (t or "")


def test_every_pretoken_alone_is_encoded_as_in_place(encoding):
    import regex

    for point in [*range(0x20, 0x3000), 0x1F600, 0x10FFFF]:
        if not 0xD800 <= point < 0xE000:
            text = f"a{chr(point)}1{chr(point)} {chr(point)}{chr(point)}"
            alone = [i for w in regex.findall(tokenizers.PATTERN, text) for i in
                     encoding._core_bpe.encode_single_piece(w.encode())]
            assert alone == encoding.encode_ordinary(text)


def test_packing():
    values = np.array([0, 127, 128, 16383, 16384, 2 ** 21 - 1, 2 ** 28, 2 ** 32 - 1])
    assert bpe._unpack(bpe._pack(values)).tolist() == values.tolist()
    assert bpe._unpack(bpe._pack(np.zeros(0, np.int64))).tolist() == []


def test_empty_table(spark):
    assert bpe.encode_digests(frame(spark, [(1, "a")]).limit(0), PATH, tokenizers.PATTERN).count() == 0
