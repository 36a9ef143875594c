"""License scan against brute force; the plan has no Python."""

import math
import re

from llm_cases import awkward, frame, rows_of, words
from webfeed.llm import licenses as L


def brute(docs, notices=L.NOTICES):
    out = []
    for d, t in docs:
        w = words(t)
        places = [(label, i) for p, label in L.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        best, labels, blocks = 0.0, set(), set()
        for n, line in enumerate((t or "").split("\n")):
            for label, notice in notices:
                need = set(words(notice))
                share = len(need & set(words(line)))
                named = label not in L.NAMES or L.NAMES[label] in words(line)
                if need and named and share >= max(1, math.ceil(L.THRESHOLD * len(need) - 1e-9)):
                    best = max(best, share / len(need))
                    labels.add(label)
                    blocks.add(n)
        base = sorted({x for x, _ in places})
        out.append((d, len(w), len(places), min((i for _, i in places), default=None),
                    max((i for _, i in places), default=None), ",".join(base), ",".join(sorted({*base, *labels})),
                    1.0 if places else best, len(blocks)))
    return sorted(out, key=repr)


CASES = [
    (30, "MIT LICENSE mit license\nApache  License! the general, public\nlicense x"),
    (31, "mit\nlicense, submit license mit licenses mitlicense"),
    (32, "Licensed under the Apache License, Version 3.0\nlicensed under cc by nc 4.0 mit license"),
    (33, "this work is under the GNU general public license, version 3. Extra words here"),
    (34, "liCensed under the apache x y version 2.0 mit license"),
    (35, "the Kelvin K Mit Lİcense mit lıcense"),
    (36, "redistribution and use in source and binary forms with or without are permitted"),
    (37, "  .. mit license"),
]


def test_against_brute_force(spark):
    docs = [*awkward(), *CASES, (None, CASES[0][1]), (30, CASES[0][1])]
    assert rows_of(L.license_scan(frame(spark, docs))) == brute(docs)


def test_other_notices(spark):
    notices = [("one", "alpha"), ("none", "!!!"), ("pair", "alpha beta"), ("five", "a b c d e")]
    docs = [(1, "alpha"), (2, "ALPHA beta\na b c d"), (3, "a b c"), (4, None)]
    assert rows_of(L.license_scan(frame(spark, docs), notices)) == brute(docs, notices)


MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
MIT = "dnl Released under\ndnl the MIT\ndnl License"


def test_notices_broken_over_lines(spark):
    docs = [
        (1, f"int x;\n{MPL}\nint y;"), (2, BSD), (3, f"{MPL}\r\n\r\n{BSD}"), (4, MIT),
        (5, f"{BSD}\n{BSD}\n{MIT}\nReleased under the MIT License\n{BSD}"),
        (6, BSD.replace("binary", "object").replace("source", "text").replace("Redistribution", "Copying")),
        (7, "Released\nunder the MIT License\nfor all"),  # the second line matches alone, once
        (8, "released under\n" + "other words " * 5 + "\nthe mit license"),
    ]
    got = {r.doc_id: (r.labels, r.n_blocks, r.score) for r in L.license_scan(frame(spark, docs)).collect()}
    assert got[1] == ("mpl-2.0-notice", 1, 1.0)
    assert got[2] == ("bsd-notice", 1, 1.0)
    assert got[3] == ("bsd-notice,mpl-2.0-notice", 2, 1.0)
    assert got[4][:2] == ("mit-notice", 1)
    assert got[5][:2] == ("bsd-notice,mit,mit-notice", 5)
    assert got[6] == ("", 0, 0.0)
    assert got[7][:2] == ("mit,mit-notice", 1)
    assert got[8][:2] == ("mit", 0)


def test_native_plan_and_empty_table(spark):
    got = L.license_scan(frame(spark, CASES).limit(0))
    assert got.count() == 0
    plan = L.license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


def test_the_word_that_names_a_license_is_shared(spark):
    docs = [(1, "Released under the Apache License"), (2, "released under the GPL license"),
            (3, "Licensed under the Eclipse License, version 2.0"), (4, "Licensed\nunder the Eclipse License,\nversion 2.0"),
            (5, "released under the mit software"), (6, "Released under\nthe GPL\nlicense"), (7, "Released under\nthe MIT terms")]
    got = {r.doc_id: r.labels for r in L.license_scan(frame(spark, docs)).collect()}
    assert got == {1: "apache", 2: "", 3: "", 4: "", 5: "mit-notice", 6: "", 7: "mit-notice"}
