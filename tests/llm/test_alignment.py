"""Alignment of two tokenizers against whole texts encoded by the libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_cases import awkward, frame, prose, rows_of
from webfeed.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(texts, digest=False):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text, by byte ranges of whole encodings."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    of = alignment.byte_values()
    parts, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        x, y = a.encode(raw.decode(), add_special_tokens=False).ids, b.encode(text or "")
        x_bytes = [bytes(of[c] for c in a.id_to_token(i)) for i in x]
        y_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in y]
        if not text or b"".join(x_bytes) != raw or b"".join(y_bytes) != raw:
            parts.append(None)
            continue
        owner = [i for i, t in enumerate(x_bytes) for _ in t], [j for j, t in enumerate(y_bytes) for _ in t]
        links = sorted(set(zip(*owner, strict=True)))
        ends = [{sum(map(len, z[:i + 1])) for i in range(len(z))} if len(z) < 3000 else None for z in (x_bytes, y_bytes)]
        if None in ends:
            ends = [set(__import__("itertools").accumulate(map(len, z))) for z in (x_bytes, y_bytes)]
        cuts = sorted(ends[0] & ends[1])
        groups, lo = [], 0
        for hi in cuts:
            groups.append(",".join(str(x[i]) for i in dict.fromkeys(owner[0][lo:hi])) + "|"
                          + ",".join(str(y[j]) for j in dict.fromkeys(owner[1][lo:hi])))
            lo = hi
        pairs = [(x[i], y[j]) for i, j in links]
        counts.update(pairs)
        parts.append((len(x), len(y), groups, pairs))
    most = Counter()
    for (_, j), c in counts.items():
        most[j] = max(most[j], c)
    out = []
    for p in parts:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = p
        text = ";".join(groups)
        out.append((n_a, n_b, len(groups), len(pairs), sum(counts[q] == most[q[1]] for q in pairs),
                    sum(counts[q] for q in pairs), hashlib.sha256(text.encode()).hexdigest() if digest else text))
    return out


def expected(rows, digest=False):
    return sorted([(r[0], *got) for r, got in zip(rows, brute([r[1] for r in rows], digest), strict=True)], key=repr)


def odd(seed):
    rng = random.Random(seed)
    marks = list(" \n\t\r\x0b\x1c\x85\xa0　▁éé\U0001f600<>|'s123中文;){}") + [
        "  ", "\n\n", "\r\n", " \n", "\n ", "<|endoftext|>", "<s>", "<0x41>", " word", "word", "Straße", "don't", "();\r\n"]
    return [(100 + i, "".join(rng.choice(marks) for _ in range(rng.randrange(1, 40)))) for i in range(400)]


@pytest.mark.parametrize("digest", [False, True])
def test_against_whole_encodings(spark, digest):
    rows = awkward() + odd(3) + [(50, " "), (51, "\n"), (52, "a  b "), (53, " a"), (54, "a\n"), (55, "x\t"), (56, "x \t\n")]
    got = alignment.align(frame(spark, rows), A, B, digest=digest)
    assert rows_of(got) == expected(rows, digest)


def test_bundles_and_slices_do_not_matter(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40, 30) + "\n tail  \n") for i in range(60)] + odd(9)[:100]
    got = alignment.align(frame(spark, rows), A, B, bundle_bytes=300, bundle_pieces=20)
    assert rows_of(got) == expected(rows)
    text = prose(rng, 500) + "\n\n  x \t\r\n end "
    for size in (1, 7, 100):
        parts = list(alignment.slices(text, size, True))
        assert "".join(parts) == text and len(parts) > 1
        assert [p for s in parts for p in __import__("re").findall(alignment._PIECE, s)] == \
            __import__("re").findall(alignment._PIECE, text)


def test_vocabulary_that_joins_over_spaces_is_aligned_whole(spark):
    both = alignment.Tokenizers(open(A, "rb").read(), open(B, "rb").read())
    assert both.breaks
    both.breaks = False
    bundle = alignment._Bundle(both, digest=False)
    text = "one  two\n three"
    bundle.add(1, text)
    bundle.flush()
    assert list(bundle.piece) == [" " + text]
    assert bundle.docs[0].text() == brute([text])[0][-1]


def test_link_counts(spark):
    rows = [(1, "the cat"), (2, "the cat"), (3, "▁"), (4, None)]
    got = {(a, b): n for a, b, n in alignment.link_counts(frame(spark, rows), A, B).collect()}
    assert sum(got.values()) == sum(r[3] for r in brute([r[1] for r in rows])) and set(got.values()) == {2}


def test_empty_table(spark):
    assert alignment.align(frame(spark, [(1, "a")]).limit(0), A, B).count() == 0


def test_ranks_and_merges_give_the_same_ids():
    both = alignment.Tokenizers(open(A, "rb").read(), open(B, "rb").read())
    rng = random.Random(2)
    signs = [chr(i) for i in range(0x250)] * 2 + list("aeiou nrst'")
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 30)))
        assert both.known(text) and both.fast_a(text) == both.a.encode(text, add_special_tokens=False).ids, repr(text)
    assert both.known("\u2019") is None
