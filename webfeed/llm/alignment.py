"""Alignment of two tokenizers' tokens by the bytes they cover.

A (a byte-level BPE of the ``tokenizers`` library) encodes a space and the text, B (a ``sentencepiece`` BPE with
byte fallback) the text, before which it puts a space itself. The cumulative ends of A's and of B's tokens go
into dictionaries from end to index; the intersection of their keys, sorted, cuts both id lists into groups, and
the links (all A-B token pairs whose byte ranges overlap) are expanded group by group. How often two ids are
linked is counted over the whole corpus, and every document's links are then scored by these counts.

Texts are aligned in pieces that begin at a space or a line feed after a character that is no white space. There
both tokenizers always break: A's pattern never joins such characters, and B has no vocabulary entry in which
one precedes a space or that holds a line feed (checked when the vocabulary is read; otherwise texts are
aligned whole). A bundle of documents, of bounded text and bounded distinct pieces, aligns each distinct piece
once and is written once, as one row: its documents as counts of pieces, its pieces as links, its links as pairs
of ids with their number. These numbers are summed over all bundles, and the sums return to the bundles by
joins, so no task holds more than a bundle and no link is a row of its own.

Edge cases: null and empty texts, and texts whose A or B bytes differ from space + text, have no tokens:
zeros and an empty ``groups``, and their links count nowhere; every input row gives one output row, also rows
that repeat a doc_id or a whole row; doc_id may be null; a very long text is read slice by slice; a run
without spaces is one piece; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfeed.llm.bpe import _pack, _unpack
from webfeed.llm.tables import table, written

#: Text and distinct pieces of a bundle (at least one slice of a document), and text that is cut at a time.
BUNDLE_BYTES, BUNDLE_PIECES, SLICE = 64 << 20, 700_000, 1 << 20
#: White space and what follows it; a break comes before a space or line feed that follows anything else.
_PIECE = r"\s*\S+(?:[^\S \n]\s*(?:\S+|\Z))*|\s+"
_WHOLE = r"(?s).+"
# Fixed value: the pattern by which byte-level BPE cuts a text before its merges.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, A tokens, B tokens) up to the end of every group: bytes at which tokens of both end."""
    a_at = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1), strict=True))
    b_at = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1), strict=True))
    common = sorted(a_at.keys() & b_at.keys())
    n = len(common)
    return (np.array(common, np.int64), np.fromiter(map(a_at.__getitem__, common), np.int64, n),
            np.fromiter(map(b_at.__getitem__, common), np.int64, n))


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of all tokens whose byte ranges overlap, in order.

    Two tokens of a group overlap in one stretch, which ends where the first of them does; so in every slice each
    end of either list closes one link.
    """
    ends = _merged(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distinct values of two sorted lists."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return both[np.diff(both, prepend=-1) > 0]


def byte_values() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, with the bytes of every entry; made in each task from the files' contents."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_buffer(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        values = byte_values()
        entries = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(entries.values(), default=-1) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(values[c] for c in entry)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        cut = re.compile("[^▁]▁|\n")
        self.breaks = not any(cut.search(p) for p in pieces) and not self.b.is_unknown(self.space)

        # A's merges in the order of their ids are ranks, which tiktoken applies faster, with the same result. Which signs
        # are letters or digits does not differ between libraries for the first blocks of Unicode.
        import json

        import tiktoken

        model = json.loads(a_json)["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ranked = all(entries.get(x + y) == 256 + i for i, (x, y) in enumerate(pairs)) and not model.get("ignore_merges")
        ranks = {self.a_bytes[i]: i for i in range(256 + len(pairs))} if ranked else {}
        self.known = re.compile("[\x00-\u024F]+").fullmatch if len(ranks) == 256 + len(pairs) else lambda _: None
        self.fast_a = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary \
            if ranks else None
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    def encode(self, pieces: list[str]) -> list[tuple[list[int], list[int]]]:
        """A's and B's ids of every piece of a text (the first of which begins with the added space)."""
        a = [e.ids for e in self.a.encode_batch(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        # B adds no space to nothing; the space that it adds before a line feed stays a token.
        return [(x, [self.space] if p == " " else y if p[0] == " " else y[1:] if y and y[0] == self.space else [])
                for p, x, y in zip(pieces, a, b, strict=True)]

    def same(self, raw: bytes, a, b) -> bool:
        """Whether both id lists stand for these bytes."""
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw

    def encode_all(self, pieces: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(good pieces, bad ones, bytes of each good one, their A ids, their B ids).

        Pieces that begin with a space and end with none make one text, in which both break between them.
        """
        usual: tuple[list[str], list[str]] = [], []
        rest = []
        for p in pieces:
            if self.breaks and p[0] == " " and not p[-1].isspace() and "▁" not in p:
                usual[self.known(p) is None].append(p)
            else:
                rest.append(p)
        good, bad, sizes, a, b = [], [], [], [], []
        for text, encode in zip(usual, (self.fast_a, lambda x: self.a.encode(x, add_special_tokens=False).ids), strict=True):
            if not text:
                continue
            every = "".join(text)
            raw = every.encode("utf-8")
            x, y = encode(every), self.b.encode(every[1:], num_threads=1)
            size = list(map(len, text)) if len(raw) == len(every) else [len(p.encode("utf-8")) for p in text]
            if self.same(raw, x, y) and _all_in(size, self.a_size[x]) and _all_in(size, self.b_size[y]):
                good += text
                sizes += size
                a += x
                b += y
            else:
                rest += text
        for p, (x, y) in zip(rest, self.encode(rest) if rest else (), strict=True):
            raw = p.encode("utf-8")
            if self.same(raw, x, y):
                good.append(p)
                sizes.append(len(raw))
                a += x
                b += y
            else:
                bad.append(p)
        return good, bad, *(np.array(x, np.int64) for x in (sizes, a, b))


def _all_in(sizes: list[int], tokens: np.ndarray) -> bool:
    """Whether a token ends wherever a piece ends."""
    ends, at = np.cumsum(sizes), np.cumsum(tokens)
    return bool((at[np.minimum(np.searchsorted(at, ends), len(at) - 1)] == ends).all())


def slices(text: str, size: int, breaks: bool):
    """The text in slices of at least ``size`` characters that end where a piece does."""
    import re

    cut = re.compile(r"(?<=\S)[ \n]")
    lo = 0
    while lo < len(text):
        found = cut.search(text, lo + size) if breaks and lo + size < len(text) else None
        hi = found.start() if found else len(text)
        yield text[lo:hi]
        lo = hi


class _Doc:
    """A document of a bundle: its groups (or their digest) and its pieces, slice by slice."""

    __slots__ = ("counts", "doc_id", "good", "groups", "held", "kinds")

    def __init__(self, doc_id, good: bool, groups):
        self.doc_id, self.good, self.groups, self.held = doc_id, good, groups, ""
        self.kinds: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, kinds: np.ndarray, groups: str) -> None:
        kind, count = np.unique(kinds, return_counts=True)
        self.kinds.append(kind)
        self.counts.append(count)
        text, self.held = self.held + groups[:-1], ";"  # the sign that ends a slice begins the next
        if isinstance(self.groups, list):
            self.groups.append(text)
        else:
            self.groups.update(text.encode())

    def text(self) -> str:
        if not self.good:
            return ""
        return "".join(self.groups) if isinstance(self.groups, list) else self.groups.hexdigest()

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.good:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.kinds) == 1:
            return self.kinds[0], self.counts[0]
        kind, back = np.unique(np.concatenate(self.kinds), return_inverse=True)
        return kind, np.bincount(back, weights=np.concatenate(self.counts)).astype(np.int64)


class _Bundle:
    """Distinct pieces of some documents, each aligned once, and the documents as numbers of pieces."""

    def __init__(self, both: Tokenizers, digest: bool):
        import re

        self.both, self.digest, self.find = both, digest, re.compile(_PIECE if both.breaks else _WHOLE).findall
        self.piece: dict[str, int] = {}
        self.text: dict[str, str] = {}  # groups of each piece, with an end sign
        self.bad: set[str] = set()
        self.pair: dict[int, int] = {}
        self.size: list[np.ndarray] = []  # A tokens, B tokens, groups, links of each piece
        self.links: list[np.ndarray] = []
        self.docs: list[_Doc] = []
        self.waiting: list[tuple[_Doc, list[str]]] = []
        self.bytes = self.ahead = 0
        a, b = range(len(both.a_bytes)), range(len(both.b_bytes))
        self.signs = [np.array([f"{i}{sign}" for i in ids], object) for ids, sign in ((a, ","), (a, "|"), (b, ","), (b, ";"))]

    def add(self, doc_id, text: str | None) -> None:
        import hashlib

        doc = _Doc(doc_id, bool(text), hashlib.sha256() if self.digest else [])
        self.docs.append(doc)
        for part in slices(" " + text, SLICE, self.both.breaks) if text else ():
            self.waiting.append((doc, self.find(part)))
            self.ahead += len(part)
            if self.ahead >= SLICE:
                self.flush()
        self.bytes += len(text or "")

    def flush(self) -> None:
        """Align the pieces that are new, and give the documents that wait theirs."""
        every = set().union(*(found for _, found in self.waiting))
        self._align([p for p in every if p not in self.piece and p not in self.bad])
        number, text = self.piece.__getitem__, self.text.__getitem__
        for doc, found in self.waiting:
            if self.bad and not self.bad.isdisjoint(found):
                doc.good = False
            if doc.good:
                doc.add(np.fromiter(map(number, found), np.int64, len(found)), "".join(map(text, found)))
        self.waiting, self.ahead = [], 0

    def _align(self, pieces: list[str]) -> None:
        both = self.both
        pieces, bad, sizes, a, b = both.encode_all(pieces)
        self.bad.update(bad)
        if not pieces:
            return
        a_ends, b_ends = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
        ends, a_cut, b_cut = groups_of(a_ends, b_ends)
        la, lb = links_of(a_ends, b_ends)
        piece_ends = np.cumsum(sizes)
        per = [np.searchsorted(x, piece_ends, side="right") for x in (a_ends, b_ends, ends)]
        per.append(np.searchsorted(_merged(a_ends, b_ends), piece_ends, side="right"))
        self.size.append(np.stack([np.diff(x, prepend=0) for x in per], 1))
        # The signs of all groups in order: a group's A ids, then its B ids.
        out = np.empty(len(a) + len(b), object)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[a_cut - 1] = last_b[b_cut - 1] = True
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b, through_a = np.concatenate([[0], b_cut]), a_cut
        out[np.arange(len(a)) + before_b[of_a]] = np.where(last_a, self.signs[1][a], self.signs[0][a])
        out[np.arange(len(b)) + through_a[of_b]] = np.where(last_b, self.signs[3][b], self.signs[2][b])
        signs, stops = out.tolist(), (per[0] + per[1]).tolist()
        lo, n = 0, len(self.piece)
        for p, hi in zip(pieces, stops, strict=True):
            self.text[p] = "".join(signs[lo:hi])
            lo = hi
        self.piece.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        key, back = np.unique(a[la] << 32 | b[lb], return_inverse=True)
        known = self.pair
        self.links.append(np.fromiter((known.setdefault(k, len(known)) for k in key.tolist()), np.int64, len(key))[back])

    def full(self, most_bytes: int, most_pieces: int) -> bool:
        return self.bytes >= most_bytes or len(self.piece) >= most_pieces

    def row(self, name: int) -> pa.RecordBatch:
        """The bundle as one row."""
        self.flush()
        size = np.concatenate([np.zeros((0, 4), np.int64), *self.size])
        held = [d.pieces() for d in self.docs]
        n = np.array([len(k) for k, _ in held], np.int64)
        kind = np.concatenate([k for k, _ in held])
        count = np.concatenate([c for _, c in held])
        links = np.concatenate([np.zeros(0, np.int64), *self.links])
        # Occurrences of every pair in the documents that have tokens.
        seen = np.zeros(len(size), np.int64)
        np.add.at(seen, kind, count)
        total = np.zeros(len(self.pair), np.int64)
        np.add.at(total, links, np.repeat(seen, size[:, 3]))
        doc = np.repeat(np.arange(len(n)), n)
        sums = np.zeros((len(n), 4), np.int64)
        np.add.at(sums, doc, size[kind] * count[:, None])
        docs = pa.record_batch([pa.array([d.doc_id for d in self.docs], pa.int64()),
                                pa.array([d.text() for d in self.docs], pa.string()),
                                *(pa.array(sums[:, i]) for i in range(4))],
                               names=["doc_id", "groups", "n_a", "n_b", "n_groups", "n_links"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as w:
            w.write_batch(docs)
        pairs = np.array(list(self.pair), np.int64)
        blobs = [sink.getvalue().to_pybytes(), _pack(n), _pack(kind), _pack(count), _pack(size[:, 3]), _pack(links)]
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), *(pa.array([x], pa.list_(pa.int64())) for x in (pairs >> 32, pairs & 0xFFFFFFFF, total)),
             *(pa.array([x], pa.binary()) for x in blobs)], names=_ROW)


_ROW = ["bundle", "a", "b", "n", "docs", "kinds", "kind", "count", "size", "links"]
_ROW_SQL = ("bundle long, a array<long>, b array<long>, n array<long>, docs binary, kinds binary, kind binary, "
            "count binary, size binary, links binary")


def _bundles(files, digest: bool, most_bytes: int, most_pieces: int):
    """Task: (doc_id, text) -> a row for each bundle of documents."""
    def task(batches):
        from pyspark import TaskContext

        both = now = None
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            both = both or Tokenizers(*files.value)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                now = now or _Bundle(both, digest)
                now.add(doc_id, text.as_py())
                if now.full(most_bytes, most_pieces):
                    yield now.row(name)
                    name, now = name + 1, None
        if now:
            yield now.row(name)
    return task


def _scored(bundle: pa.Table, pairs: pa.Table) -> pa.Table:
    """A bundle and what the corpus says about its pairs -> its documents with their scores."""
    if not bundle.num_rows:
        return _DOCS.empty_table()
    row = bundle.to_pylist()[0]
    docs = pa.ipc.open_stream(row["docs"]).read_all()
    n, kind, count, size, links = (_unpack(row[c]).astype(np.int64) for c in ("kinds", "kind", "count", "size", "links"))
    known = np.zeros((len(row["a"]), 2), np.int64)
    at = pairs["pair"].to_numpy()
    known[at, 0], known[at, 1] = pairs["best"].to_numpy(), pairs["total"].to_numpy()

    def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(values, 0)])
        end = np.cumsum(lengths)
        return total[end] - total[end - lengths]

    per_doc = sums(sums(known[links], size)[kind] * count[:, None], n)
    out = docs.append_column("n_best", pa.array(per_doc[:, 0])).append_column("count_sum", pa.array(per_doc[:, 1]))
    return out.select(_DOCS.names).cast(_DOCS)


_DOCS = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in
                  ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups", pa.string())])
_DOCS_SQL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
             "groups string")


def _bundled(docs: DataFrame, a_json: str, b_model: str, digest: bool, most_bytes: int, most_pieces: int) -> DataFrame:
    contents = []
    for path in (a_json, b_model):
        with open(path, "rb") as f:
            contents.append(f.read())
    files = docs.sparkSession.sparkContext.broadcast(tuple(contents))  # the vocabularies: a fixed size
    return written(docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(_bundles(files, digest, most_bytes, most_pieces), _ROW_SQL), "aligned")


def _pairs(bundles: DataFrame) -> DataFrame:
    """(bundle, pair, a, b, n): the linked ids of every bundle, by their number in it."""
    return bundles.select("bundle", F.posexplode(F.arrays_zip("a", "b", "n")).alias("pair", "x")) \
        .select("bundle", "pair", "x.a", "x.b", "x.n")


def _totals(bundles: DataFrame) -> DataFrame:
    return _pairs(bundles).where("n > 0").groupBy("a", "b").agg(F.sum("n").alias("total"))


def link_counts(docs: DataFrame, a_json: str, b_model: str) -> DataFrame:
    """(a, b, total): how many links of the corpus hold two ids linked."""
    return _totals(_bundled(docs, a_json, b_model, True, BUNDLE_BYTES, BUNDLE_PIECES))


def align(docs: DataFrame, a_json: str, b_model: str, digest: bool = False, bundle_bytes: int = BUNDLE_BYTES,
          bundle_pieces: int = BUNDLE_PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    ``groups``: A and B ids as ``a1,a2|b1;a3|b2,b3``, with ``digest`` their SHA-256 instead. ``n_best``: links whose
    count is the highest of their B id, ``count_sum``: the counts of all links.
    """
    bundles = _bundled(docs, a_json, b_model, digest, bundle_bytes, bundle_pieces)
    totals = written(docs.sparkSession, _totals(bundles), "links")
    best = totals.groupBy("b").agg(F.max("total").alias("most"))
    known = written(docs.sparkSession, totals.join(best, "b").select(
        "a", "b", "total", (F.col("total") == F.col("most")).cast("long").alias("best")), "link-counts")
    pairs = _pairs(bundles).join(known, ["a", "b"]).select(F.col("bundle").alias("holder"), "pair", "total", "best")
    return bundles.drop("b", "n").groupBy("bundle").cogroup(pairs.groupBy("holder")).applyInArrow(_scored, _DOCS_SQL)


def op12_token_alignment(spark, sf_dir):
    """Every whole text of ``documents``: byte-level BPE tokens against sentencepiece tokens."""
    import public_tokenizers as tokenizers

    return align(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"),
                 tokenizers.path("piece_bpe_32k.model"), digest=True).withColumnRenamed("groups", "groups_sha256")
