"""Small tables with the awkward rows that every operator must take, and plain-Python words."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    """documents of (doc_id, text) or (doc_id, text, lang) rows, with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(3)
    extra = ("k1", "k2", "score", "line", "words", "name", "rep", "label", "ids", "Bundle", "n_words", "a.b", "toxic")
    return df.withColumns({c: F.lit("x") for c in extra})


def awkward(seed=5):
    """Null and empty texts, null, repeated and negative ids, repeated rows, ties, a very long text."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    long_text = "\n".join(prose(rng, 60) for _ in range(400))
    return [(None, base), (None, None), (1, None), (2, ""), (3, base), (3, base), (3, base + " tail"), (-4, base),
            (5, "!!! ???\n\n"), (6, "one two"), (7, "one two"), (8, long_text), (9, long_text + " end"),
            (10, "Ünï cödé ÄÖ x K İ"), (11, "\x00 \x1c a\tb\r\nc")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
