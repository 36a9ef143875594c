"""License scan: exact set-similarity join of text blocks (lines) with license notices, DataFrame functions only.

A block matches a notice when at least ``threshold`` of the notice's distinct words stand in it.
Words are ordered by the number of blocks of all documents that hold them, rarest first; then

- prefix filter: a match shares a word of the notice's first ``|T| - need + 1`` words and of the
  block's first ``b - least need + 1`` words (only words of any notice count in a block);
- length filter: a block with fewer than ``need`` such words cannot match;
- positional filter: the first shared word leaves at most ``min(|T| - i, b - j)`` shared words.

What passes is counted exactly, and must share the word that names the license (``NAMES``): short notices differ
in little else. A notice that is broken over lines matches as a run of its own number of
words and a quarter (two at least) more, for words that comment signs add, which begins and ends on different
lines, none of which matches the notice alone; it is looked for around the notice's rarest words (as in the
prefix filter), and of runs that overlap one is reported, under its first line. Notices are a bounded parameter; their words, and nothing that grows
with the documents, are sent to every task. Besides, places of fixed base phrases are reported.

Edge cases: null text is empty (no words, no labels, score 0); rows that agree in doc_id and text get
the same result; a null doc_id is a value like any other; other columns are ignored; empty tables give
empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfeed.llm.tables import table, with_key

# Base phrases with their labels, and short public license notices.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
NOTICES = [
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("mit-notice", "Released under the MIT License"),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0"),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
]
#: The word of a notice that a match must share.
NAMES = {"apache-2.0-notice": "apache", "gpl-3.0-notice": "general", "mit-notice": "mit", "cc-by-nc-4.0-notice": "cc",
         "mpl-2.0-notice": "mozilla"}
THRESHOLD = 0.8

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words in text whose A-Z are not lowered yet.
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower_ascii(text: Column) -> Column:
    """A-Z lowered, and no other character turned into an ASCII letter (only U+212A and U+0130 would be)."""
    return F.when(text.rlike("[Kİ]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def _tokens(notice: str) -> list[str]:
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", notice.translate(str.maketrans(_UPPER, _LOWER)))


def notice_words(notice: str) -> list[str]:
    """Distinct words of a notice."""
    return sorted(set(_tokens(notice)))


def run_length(notice: str) -> int:
    """Words of text that a notice broken over lines may take."""
    n = len(_tokens(notice))
    return n + max(2, n // 4)


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _named(shared: Column, name: Column) -> Column:
    """Whether the words shared with a notice hold the one that names it (if one does)."""
    return (name == "") | F.array_contains(shared, name)


def _broken_notices(docs: DataFrame, notices: list[tuple[str, list[str], list[str], int, int]]) -> DataFrame:
    """(doc_id, k1, k2, line, label, containment): notices (label, words, rare words, need, run) over several lines."""
    rare = sorted({x for _, _, prefix, _, _ in notices for x in prefix})
    parts = F.transform(F.split(_lower_ascii(F.col("text")), "\n"),
                        lambda b: F.filter(F.split(b, _NOT_WORD), lambda x: x != ""))
    rows = with_key(docs).where(F.col("text").rlike("(?i)" + "|".join(rare))) \
        .select("doc_id", "k1", "k2", parts.alias("parts"))
    rows = rows.select("*", F.flatten("parts").alias("w"),
                       F.flatten(F.transform("parts", lambda p, n: F.transform(p, lambda _: n))).alias("at"))
    known = F.array(*[F.struct(F.lit(label).alias("label"), _strings(words).alias("words"), _strings(prefix).alias("rare"),
                               F.lit(need).alias("need"), F.lit(run).alias("run"), F.lit(NAMES.get(label, "")).alias("name"))
                      for label, words, prefix, need, run in notices])
    rows = rows.select("*", F.explode(known).alias("t")).where(F.arrays_overlap("w", "t.rare"))
    w, at, t = F.col("w"), F.col("at"), F.col("t")
    places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains(t["rare"], w[i]))
    starts = F.array_distinct(F.flatten(F.transform(
        places, lambda i: F.sequence(F.greatest(F.lit(0), i - t["run"] + 1), i))))
    starts = F.filter(starts, lambda s: F.array_contains(t["words"], w[s]))
    runs = F.filter(
        F.transform(starts, lambda s: F.struct(
            s.alias("s"), F.array_intersect(F.slice(w, s + 1, t["run"]), t["words"]).alias("shared"))),
        lambda r: (F.size(r["shared"]) >= t["need"]) & _named(r["shared"], t["name"]))
    # The last word is where the run has all that it shares.
    runs = F.transform(runs, lambda r: F.struct(
        (r["s"] + F.array_max(F.transform(
            r["shared"], lambda x: F.array_position(F.slice(w, r["s"] + 1, t["run"]), x))).cast("int") - 1).alias("end"),
        (-F.size(r["shared"])).alias("less"), (-r["s"]).alias("before")))
    def alone(n: Column) -> Column:
        shared = F.array_intersect(F.col("parts")[n], t["words"])
        return (F.size(shared) >= t["need"]) & _named(shared, t["name"])

    runs = F.array_sort(F.filter(runs, lambda r: (at[-r["before"]] < at[r["end"]]) & ~F.exists(
        F.sequence(at[-r["before"]], at[r["end"]]), alone)))
    # By their ends, each run that begins after the last one reported.
    kind = "struct<end: int, less: int, before: int>"
    state = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("last"))

    def step(acc: Column, r: Column) -> Column:
        last = acc["last"]
        more = F.struct(last["end"].alias("end"), F.least(last["less"], r["less"]).alias("less"), last["before"].alias("before"))
        done = F.when(last.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(last)))
        return F.when(last.isNull() | (-r["before"] > last["end"]), F.struct(done.alias("done"), r.alias("last"))) \
            .otherwise(F.struct(acc["done"].alias("done"), more.alias("last")))

    found = F.aggregate(runs, state, step, lambda acc: F.when(acc["last"].isNull(), acc["done"])
                        .otherwise(F.concat(acc["done"], F.array(acc["last"]))))
    lines = F.transform(found, lambda r: F.struct(
        at[-r["before"]].alias("line"), (-r["less"] / F.size(t["words"])).alias("containment")))
    return rows.select("doc_id", "k1", "k2", t["label"].alias("label"), F.explode(lines).alias("f")) \
        .select("doc_id", "k1", "k2", "f.line", "label", "f.containment")


def notice_matches(docs: DataFrame, notices: list[tuple[str, str]] | None = None,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, k1, k2, line, label, containment): every line that holds enough words of a notice.

    A notice broken over lines is reported under the first of them.
    """
    spark = docs.sparkSession
    run = {label: run_length(notice) for label, notice in (NOTICES if notices is None else notices)}
    notices = [(label, w) for label, notice in (NOTICES if notices is None else notices) if (w := notice_words(notice))]
    need = {label: max(1, math.ceil(threshold * len(w) - 1e-9)) for label, w in notices}
    vocabulary = sorted({x for _, w in notices for x in w})
    least = min(need.values(), default=1)
    lines = with_key(docs).select("doc_id", "k1", "k2", F.posexplode(F.split("text", "\n")).alias("line", "block"))
    words = F.split(_lower_ascii(F.col("block")), _NOT_WORD)

    def held(order: list[str]) -> Column:
        """The notice words of a block, once each, in the order given."""
        return F.array_intersect(_strings(order), words) if order else F.array().cast("array<string>")

    count = {r["w"]: r["n"] for r in lines.select(F.explode(held(vocabulary)).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per notice word at most
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    prefixes, broken = [], []
    for label, w in notices:
        ranked = sorted(w, key=place.__getitem__)
        broken.append((label, w, ranked[:len(w) - need[label] + 1], need[label], run[label]))
        prefixes += [(t, label, ranked, i, need[label], NAMES.get(label, ""))
                     for i, t in enumerate(ranked[:len(w) - need[label] + 1])]
    small = spark.createDataFrame(prefixes, "token string, label string, notice array<string>, i int, need int, name string")
    blocks = lines.select("doc_id", "k1", "k2", "line", held(order).alias("own")).where(F.size("own") >= least)
    probes = blocks.select("*", F.posexplode(F.slice("own", F.lit(1), F.size("own") - least + 1)).alias("j", "token"))
    pairs = probes.join(F.broadcast(small), "token") \
        .where((F.size("own") >= F.col("need"))
               & (F.least(F.size("notice") - F.col("i"), F.size("own") - F.col("j")) >= F.col("need")))
    shared = F.array_intersect("own", "notice")
    whole = pairs.where((shared[0] == F.col("token")) & (F.size(shared) >= F.col("need")) & _named(shared, F.col("name"))) \
        .select("doc_id", "k1", "k2", "line", "label", (F.size(shared) / F.size("notice")).alias("containment"))
    return whole.union(_broken_notices(docs, broken)) if broken else whole


def license_scan(docs: DataFrame, notices: list[tuple[str, str]] | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks) of every document."""
    matched = notice_matches(docs, notices, threshold).groupBy("doc_id", "k1", "k2").agg(
        F.collect_set("label").alias("notices"), F.max("containment").alias("best"),
        F.countDistinct("line").alias("blocks"))
    text = F.col("text")
    maybe = text.rlike("(?i)(?:mit|apache|general" + _GAP + "public)" + _GAP + "license")
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(_lower_ascii(text), _NOT_WORD, " ")), F.lit(" "))
    any_phrase = " (?:" + "|".join(p for p, _ in PHRASES) + ") "
    found = with_key(docs).select(
        "doc_id", "k1", "k2", F.regexp_count(text, F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"),
        F.when(maybe, spaced).alias("spaced"))
    base = found.select(
        "doc_id", "k1", "k2", "n_words",
        *[F.coalesce(F.regexp_count("spaced", F.lit(f"(?= {p} )")), F.lit(0)).alias(label) for p, label in PHRASES],
        F.regexp_extract("spaced", "(?s)^(.*?)" + any_phrase, 1).alias("before_first"),
        F.regexp_extract("spaced", "(?s)^(.*)" + any_phrase, 1).alias("before_last"))
    n_base = sum((F.col(label) for _, label in PHRASES[1:]), F.col(PHRASES[0][1]))

    def words_in(prefix: str) -> Column:
        return F.when(n_base > 0, F.length(prefix) - F.length(F.replace(F.col(prefix), F.lit(" "), F.lit("")))) \
            .cast("long")

    base_labels = F.sort_array(F.filter(F.array(*[F.when(F.col(label) > 0, F.lit(label)) for _, label in PHRASES]),
                                        lambda x: x.isNotNull()))
    m = matched.withColumnsRenamed({"doc_id": "m_id", "k1": "m1", "k2": "m2"})
    both = base.join(m, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2"))
                     & F.col("doc_id").eqNullSafe(F.col("m_id")), "left")
    labels = F.sort_array(F.array_distinct(F.concat(base_labels, F.coalesce("notices", F.array().cast("array<string>")))))
    return both.select(
        "doc_id", "n_words", n_base.cast("long").alias("n_base"), words_in("before_first").alias("first_word"),
        words_in("before_last").alias("last_word"), F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.when(n_base > 0, 1.0).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("blocks", F.lit(0)).cast("long").alias("n_blocks"))


def op7_license_scan(spark, sf_dir):
    """Every whole text of ``documents`` against the base phrases and the license notices."""
    return license_scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    notices = " UNION ALL ".join(
        f"SELECT '{label}' AS label, {notice_words(notice)!r} AS words, '{NAMES.get(label, '')}' AS name"
        for label, notice in NOTICES)
    places = " UNION ALL ".join(
        f"SELECT rid, '{label}' AS label, i FROM (SELECT rid, w, unnest(range(0, len(w))) AS i FROM d) WHERE "
        + " AND ".join(f"w[i + {n + 1}] = '{x}'" for n, x in enumerate(p.split())) for p, label in PHRASES)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"""
    WITH t AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {low} AS low FROM documents),
    d AS MATERIALIZED (SELECT rid, doc_id, regexp_extract_all(low, '{word}') AS w FROM t),
    n AS ({notices}),
    b AS MATERIALIZED (SELECT rid, line, list_distinct(regexp_extract_all(block, '{word}')) AS own FROM (
        SELECT rid, unnest(string_split(low, chr(10))) AS block,
               generate_subscripts(string_split(low, chr(10)), 1) AS line FROM t)),
    m AS (SELECT rid, line, label, len(list_intersect(own, words)) / len(words) AS c, len(words) AS size,
                 len(list_intersect(own, words)) AS shared FROM b, n WHERE name = '' OR list_contains(own, name)),
    s AS (SELECT rid, list(DISTINCT label) AS labels, max(c) AS best, count(DISTINCT line) AS blocks FROM m
          WHERE shared >= ceil({THRESHOLD} * size - 1e-9) GROUP BY 1),
    p AS ({places}),
    a AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM p GROUP BY 1)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(a.n, 0) AS BIGINT) AS n_base,
           CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
           coalesce(array_to_string(list_sort(a.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(a.labels, s.labels))), ','), '') AS labels,
           CASE WHEN a.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score,
           CAST(coalesce(blocks, 0) AS BIGINT) AS n_blocks
    FROM d LEFT JOIN a USING (rid) LEFT JOIN s USING (rid)"""


ORACLE_SQL = _oracle()
