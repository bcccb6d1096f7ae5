"""Licence scans (op4) against a direct search, and no Python in the plan."""
import re

from llm_cases import awkward, documents, prose

from tidewatch.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def naive(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    places, labels = [], set()
    for label, phrase in L.BASE:
        p = phrase.split()
        at = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_equal_a_direct_search(spark):
    mit = next(t for label, t in L.TEMPLATES if label == "mit").replace("[", "").replace("]", "")
    rows = awkward() + [
        (100, "Released Under-The MIT, License; under the mit license"), (101, "under the mit\nlicense " * 300),
        (102, "Apache License, Version 2.0 and CC BY-NC 4.0"), (103, "cc by ncé cc bye nc apache license version 20"),
        (104, prose(1, 50) + " " + mit + " " + prose(2, 50)), (105, mit.replace("granted", "given")), (106, mit.replace("person", "people")),
        (107, "under the mit license" + "x"), (108, "K under the mit license worK"), (109, "All rights reserved."), (110, "cc cc by by nc cc by nc nc"),
    ]
    df = L.license_scan(documents(spark, rows))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = {r.doc_id: r for r in df.collect()}
    for d, t, *_ in rows:
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == naive(t), d
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[104].labels == "mit" and got[106].labels == "mit" and got[105].labels == "" and got[109].labels == "all-rights-reserved"
    assert got[106].score < got[104].score and got[104].score > 0.999999 and got[7].labels == "" and got[7].score == 0
    assert sum(r.doc_id == 9 for r in df.collect()) == 2
    assert L.license_scan(documents(spark, [])).count() == 0


def test_a_million_words_of_one_phrase_take_seconds(spark):
    import time
    rows = documents(spark, [(1, "under the mit license " * 250_000)])
    start = time.monotonic()
    (r,) = L.license_scan(rows).collect()
    assert time.monotonic() - start < 60
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (1_000_000, 250_000, 0, 999_996, "mit")
