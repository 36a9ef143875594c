"""Property tests: any well-formed manifest parses back to what was written."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import manifest_text
from webfeed import manifests

name_chars = st.characters(whitelist_categories=("Ll", "Lu", "Nd"), whitelist_characters="-_.")
file_name = st.text(name_chars, min_size=1, max_size=20).map(lambda s: s + ".tsv.gz")
digest = st.text("0123456789abcdefABCDEF", min_size=32, max_size=32)
size = st.integers(min_value=0, max_value=2**40)
data_entry = st.fixed_dictionaries({"name": file_name, "md5": digest, "size": size,
                                    "records": st.integers(min_value=0, max_value=2**40)})
lookup_entry = st.fixed_dictionaries({"name": file_name, "md5": digest, "size": size})


@st.composite
def manifest(draw):
    data = draw(st.lists(data_entry, min_size=0, max_size=6))
    lookups = draw(st.lists(lookup_entry, min_size=1, max_size=2))
    return {"version": draw(st.sampled_from(["1.0", "2.1", " 1.0"])), "lookups": lookups, "data": data,
            "n_lookup": len(lookups), "n_data": len(data),
            "total": draw(st.integers(min_value=0, max_value=2**50))}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(m=manifest(), crlf=st.booleans(), pad=st.booleans())
def test_manifest_round_trip(spark, m, crlf, pad):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    text = manifest_text(m)
    if pad:
        text = text.replace(": ", ":   ").replace("\n", "  \n")
    if crlf:
        text = text.replace("\n", "\r\n")
    with open(os.path.join(d, "feed_2024-02-29.txt"), "w", newline="") as f:
        f.write(text)
    r = manifests(spark, d, "feed").collect()[0]
    assert r.problems == []
    assert (r.n_lookup_files, r.n_data_files, r.total_records) == (m["n_lookup"], m["n_data"], m["total"])
    assert [(e.name.strip(), e.md5, e.size) for e in r.lookup_files] == \
        [(x["name"], x["md5"].lower(), x["size"]) for x in m["lookups"]]
    assert [(e.name.strip(), e.md5, e.size, e.record_count) for e in r.data_files] == \
        [(x["name"], x["md5"].lower(), x["size"], x["records"]) for x in m["data"]]
