"""Quality rules (op1)."""
import re
from collections import Counter

from llm_cases import awkward, documents, prose

from tidewatch.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def naive(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_metrics_equal_naive_on_awkward_rows(spark):
    rows = awkward() + [(20, "x y z\nx y z\n\n\n a|b <c> \n x y z"), (21, "a a a a a a a")]
    got = sorted(map(repr, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                            for r in Q.quality_rules(documents(spark, rows)).collect())))
    want = []
    for d, t, *_ in rows:
        m = naive(t)
        want.append((d, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    assert got == sorted(map(repr, want))


def test_limits_adapt_to_the_group_and_keep_clean_rows(spark):
    clean = [(k, prose(k, 60), "en", "plain") for k in range(300)]
    # a source whose normal style has many symbols keeps its documents; strays in the plain source go
    tables = [(1000 + k, " | ".join(prose(k + 5000, 60).split()), "en", "tables") for k in range(300)]
    stray = [(2000, " | ".join(prose(9, 60).split()), "en", "plain"), (2001, " | ".join(prose(10, 60).split()), "en", "tiny")]
    kept = {r.doc_id: r.kept for r in Q.quality_rules(documents(spark, clean + tables + stray)).collect()}
    assert all(kept[k] for k in range(300)) and all(kept[1000 + k] for k in range(300))
    assert not kept[2000]


def test_sketches_merge(spark):
    df = documents(spark, [(k, prose(k, 30), "en", f"s{k % 3}") for k in range(60)])
    rows = Q.measured(df)
    whole = sorted(map(tuple, Q.sketch(rows, ["lang"]).select("lang", "feature", "bucket", "n").collect()))
    merged = sorted(map(tuple, Q.merge(Q.sketch(rows, ["lang", "source"]), ["lang"]).select("lang", "feature", "bucket", "n").collect()))
    assert whole == merged


def test_empty_table(spark):
    assert Q.quality_rules(documents(spark, [])).count() == 0
