"""Benchmark decontamination (op3)."""
import random
from collections import Counter

from llm_cases import awkward, documents, prose

from tidewatch.llm import decontam as D

ITEM = "item_id long, text string, score double"


def index_of(texts_):
    rows = [(i, t.encode(), s) for i, t in enumerate(texts_) for s in range(-(-len(D.words_of(t.encode())) // D.SEGMENT))]
    segs = [D.words_of(t)[s * D.SEGMENT:(s + 1) * D.SEGMENT] for _, t, s in rows]
    df = Counter(w for s in segs for w in set(s))
    return D.Index(rows, df, len(rows), sum(map(len, segs)) / len(segs)), segs


def test_search_equals_exhaustive_scores():
    r = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    index, segs = index_of([" ".join(r.choice(words) for _ in range(r.randint(3, 40))) for _ in range(120)])
    for _ in range(60):
        terms = sorted(r.sample(range(len(index.vocabulary)), r.randint(1, 25)))
        for threshold in (0.2, 0.5, 0.8):
            score = Counter()
            for t in terms:
                for s, x in zip(index.segments[t], index.impacts[t]):
                    score[s] += x
            want = sorted(s for s, x in score.items() if x >= threshold - 1e-9)
            assert sorted(s for s, _ in index.search(terms, threshold)) == want


def test_batch_bound_loses_no_passage(monkeypatch):
    r = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    index, _ = index_of([" ".join(r.choice(words) for _ in range(30)) for _ in range(400)])
    docs = [(k, D.words_of(" ".join(r.choice(words) for _ in range(r.randint(0, 200))).encode())) for k in range(30)]
    docs += [(99, index.texts[5].split() + docs[0][1])]
    some = D.find(docs, index, 0.3)
    monkeypatch.setattr(D.Index, "likely", lambda self, stride, term, n, threshold: range(n - 1))
    assert D.find(docs, index, 0.3) == some and any(x[:2] == (99, 5) for x in some)
    monkeypatch.undo()
    monkeypatch.setattr(D, "LONG", 1)  # most words by their largest impact only
    other, _ = index_of([t.decode() for t in index.texts])
    assert D.find(docs, other, 0.3) == some
    monkeypatch.setattr(D, "HELD", 500)  # several rounds of strides
    assert D.find(docs, other, 0.3) == some


def test_planted_items_are_found_and_clean_rows_left(spark):
    items = [(k, prose(100 + k, 40 + k) + ". " + prose(300 + k, 6) + ".") for k in range(20)]
    items += [(50, None), (51, ""), (52, "..."), (53, prose(77, 300) + ". " + prose(78, 9) + "."), (3, items[3][1])]
    t = dict(items)
    rows = awkward() + [
        (100, prose(501, 200) + " " + t[0] + " " + prose(502, 100)), (101, t[5].upper()), (102, prose(503, 777) + "\n" + t[53]),
        (103, t[7].replace(" ", "  ")), (104, prose(504, 3000) + t[8] + prose(505, 3000)), (105, prose(506, 90)),
        (106, t[9].split(". ")[0] + " " + prose(507, 30)),  # the question without its answer
        (107, t[1] + " " + t[2]), (100, "a second row with one id " + t[0]),
    ]
    items = spark.createDataFrame([(a, b, 0.5) for a, b in items], ITEM)
    want = [(100, 0), (101, 5), (102, 53), (103, 7), (104, 8), (107, 1), (107, 2)]
    for shard in (10_000, 5):
        got = sorted((r.doc_id, r.item_id) for r in D.contaminated(documents(spark, rows), items, shard).collect())
        assert got == want
        kept = D.drop_contaminated(documents(spark, rows), items, shard)
        assert kept.columns == documents(spark, []).columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in dict(want))
    assert D.contaminated(documents(spark, []), items).count() == 0
    assert D.contaminated(documents(spark, rows), spark.createDataFrame([], ITEM)).count() == 0
    assert D.drop_contaminated(documents(spark, rows), spark.createDataFrame([], ITEM)).count() == len(rows)
