"""Stages in order, their effect, and the registered queries."""

import __spark_entry__ as E
import corpus_pipeline as C
import pytest

from llm_cases import frame, words
from webfeed.llm import registry
from webfeed.llm.tables import table, written

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert set(registry.QUERIES) | {"pipeline"} <= set(E.queries())
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["quality", "line_dedup", "jaccard_join", "decontamination", "byte_bpe"]
    seen = [docs.count()]
    for name, stage in C.STAGES[:-1]:
        out = written(spark, stage(spark, docs, SF), f"test-{name}")
        assert out.dtypes == docs.dtypes
        assert out.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        docs = out
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    last = C.STAGES[-1][1](spark, docs, SF)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == seen[-1]
    assert C.run(spark, SF).count() == seen[-1]


def test_clean_documents_stay_and_planted_ones_go(spark):
    docs = table(spark, SF, "documents")
    item = table(spark, SF, "benchmark").first()
    clean = [r for r in docs.orderBy("doc_id").collect() if len(set(words(r["text"]))) > 100][:20]
    extra = ["Before it. " + item["text"] + "\nAfter it."]
    add = spark.createDataFrame([(10_000 + i, t, "en", "src0", len(t)) for i, t in enumerate(extra)], docs.schema)
    kept = C.decontamination(spark, docs.union(add), SF)
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert 10_000 not in ids and len([r for r in clean if r["doc_id"] in ids]) >= 18


@pytest.mark.parametrize("stage", C.STAGES)
def test_empty_input(spark, stage):
    docs = table(spark, SF, "documents").limit(0)
    assert stage[1](spark, docs, SF).count() == 0


def test_extra_columns_pass_through(spark):
    docs = frame(spark, [(1, "some words in a text " * 5), (None, None)])
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        out.collect()


def test_stages_against_brute_force(spark):
    """Line dedup, near copies, decontamination and BPE, each on rows with repeats, nulls, ties and a long text."""
    import hashlib
    import struct

    import public_tokenizers as tokenizers
    import test_decontaminate
    import test_jaccard_join
    import test_line_dedup
    import tiktoken

    from llm_cases import awkward, prose, rows_of
    from webfeed.llm.bpe import read_ranks
    from webfeed.session import new_scratch_path

    sf = new_scratch_path(spark, "sf")
    items = [(1, prose(__import__("random").Random(3), 25)), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = awkward() + test_line_dedup.made(3) + [(300, "start " + items[0][1] + " end"), (301, "start " + items[0][1] + " end")]

    lines = test_line_dedup.brute(docs, 4)
    expected = []
    for d, t in docs:
        dead = lines[d, t or ""]
        if len(dead) < len((t or "").split("\n")):
            expected.append((d, test_line_dedup.kept(t, dead) if dead else t))
    got = [tuple(r) for r in C.line_runs(spark, frame(spark, docs), sf).select("doc_id", "text").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)

    classes = test_jaccard_join.brute(unique := [(i, t) for i, (_, t) in enumerate(docs)])
    stay = {d for d, c, _ in classes if d == c}
    got = {r[0] for r in C.near_copies(spark, frame(spark, unique), sf).select("doc_id").collect()}
    assert got == stay

    bad = {d for d, _ in test_decontaminate.brute(docs, items)}
    got = sorted((r[0] for r in C.decontamination(spark, frame(spark, docs), sf).select("doc_id").collect()), key=repr)
    assert bad == {300, 301} and got == sorted((d for d, _ in docs if d not in bad), key=repr)

    code = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    expected = []
    for d, t in docs:
        ids = code.encode_ordinary(t or "")
        expected.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows_of(C.byte_bpe(spark, frame(spark, docs), sf)) == sorted(expected, key=repr)
