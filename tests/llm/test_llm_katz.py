"""Katz backoff (op7) against a direct dictionary version, and exact normalisation."""
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import awkward, documents

from tidewatch.llm import katz as K


class Direct:
    def __init__(self, docs, order):
        self.order = order
        self.every = [(d, (t or "").encode().lower().split() + [b"</s>"]) for d, t in docs]
        self.train = [w for d, w in self.every if zlib.crc32(b"" if d is None else str(d).encode()) % 10]
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for w in self.train:
            p = [b"<s>"] * (order - 1) + w
            for k in self.counts:
                self.counts[k].update(tuple(p[i - k + 1:i + 1]) for i in range(order - 1, len(p)))
        self.d = {k: K.discounts([sum(n == r for n in c.values()) for r in range(1, K.K + 2)]) for k, c in self.counts.items()}
        self.after = {k: defaultdict(dict) for k in self.counts}
        for k, c in self.counts.items():
            for g, n in c.items():
                self.after[k][g[:-1]][g[-1]] = n
        self.total = sum(self.counts[1].values())

    def kept(self, k, n):
        return n * (self.d[k][n] if n <= K.K else 1.0)

    def p(self, h, w):
        f = self.after[len(h) + 1].get(h)
        if not h:
            if not f:
                return 1.0
            n = sum(f.values())
            freed = 1 - sum(self.kept(1, x) for x in f.values()) / n
            return self.kept(1, f[w]) / n if w in f else freed
        if not f:
            return self.p(h[1:], w)
        n, k = sum(f.values()), len(h) + 1
        freed = sum(x - self.kept(k, x) for x in f.values()) / n
        rest = 1 - sum(self.p(h[1:], x) for x in f)
        if rest <= 1e-12:
            return f.get(w, 0) / n
        if freed <= 0:
            return f[w] / (n + 0.5) if w in f else 0.5 / (n + 0.5) / rest * self.p(h[1:], w)
        return self.kept(k, f[w]) / n if w in f else freed / rest * self.p(h[1:], w)

    def rows(self):
        v, out = len(self.counts[1]), []
        for d, w in self.every:
            p = [b"<s>"] * (self.order - 1) + w
            score = sum(math.log10(self.p(tuple(p[i - self.order + 1:i]), p[i])) for i in range(self.order - 1, len(p)))
            base = sum(math.log10((self.counts[1][t,] + 0.1) / (self.total + 0.1 * (v + 1))) for t in w)
            out.append((d, zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0, len(w), sum((t,) in self.counts[1] for t in w), self.total, base, score))
        return out


DOCS = [(k, f"the cat {'sat' if k % 3 else 'ran'} on the {'mat' if k % 2 else 'Mat'} {k % 7} " * (1 + k % 4)) for k in range(60)] + [
    (k, " ".join(f"w{(k * j * j) % 23}" for j in range(40))) for k in range(60, 90)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_direct_version(spark, monkeypatch, order):
    monkeypatch.setattr(K, "CHUNK", 300)  # many chunks
    rows = DOCS + [(d, t if t is None or len(t) < 20_000 else t[:9_000]) for d, t, *_ in awkward()]
    got = sorted(map(tuple, K.score_documents(documents(spark, rows).repartition(3), order).collect()), key=repr)
    want = sorted(Direct(rows, order).rows(), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 1e-6


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(order):
    m = Direct(DOCS, order)
    for h in list(m.after[order])[:40]:
        assert abs(sum(m.p(h, w[0]) for w in m.counts[1]) + m.p(h, b"never seen") - 1) < 1e-9


def test_no_training_rows_and_empty_table(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    (r,) = K.score_documents(documents(spark, [(held, "a b")])).collect()
    assert tuple(r) == (held, True, 3, 0, 0, 0.0, 0.0)
    assert K.score_documents(documents(spark, [])).count() == 0


def test_the_query_scores_with_trigrams(spark, tmp_path):
    rows = DOCS[::4]
    documents(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.score) for r in K.q_op7(spark, str(tmp_path)).collect())
    want = sorted((d, score) for d, *_, score in Direct(rows, 3).rows())
    bigrams = sorted((d, score) for d, *_, score in Direct(rows, 2).rows())
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(abs(g[1] - w[1]) < 1e-6 for g, w in zip(got, want))
    assert any(abs(w[1] - b[1]) > 0.1 for w, b in zip(want, bigrams))


def test_stored_tables_score_other_documents(spark, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 300)
    rare = [(100 + k, " ".join(f"r{j}" for j in range(k))) for k in range(9)]  # words with small counts
    training = [(d, t) for d, t in DOCS + rare if zlib.crc32(str(d).encode()) % 10]
    others = [(d, t) for d, t in DOCS if not zlib.crc32(str(d).encode()) % 10] + [(1000, "the cat ran w3 never w4 seen"), (1001, None)]
    model = K.train(documents(spark, training).repartition(3))
    got = sorted(map(tuple, K.score(documents(spark, others), model).collect()))
    m = Direct(training, 3)
    v = len(m.counts[1])
    for (d, t), g in zip(sorted(others), got):
        w = (t or "").encode().lower().split() + [b"</s>"]
        p = [b"<s>"] * 2 + w
        assert g[0] == d and g[2] == len(w) and g[3] == sum((x,) in m.counts[1] for x in w) and g[4] == m.total
        assert abs(g[5] - sum(math.log10((m.counts[1][x,] + 0.1) / (m.total + 0.1 * (v + 1))) for x in w)) < 1e-6
        assert abs(g[6] - sum(math.log10(m.p(tuple(p[i - 2:i]), p[i])) for i in range(2, len(p)))) < 1e-6
    # the tables hold every n-gram once, by part, and nothing else
    for level in (1, 2, 3):
        keys = [x for r in model.counts[level].collect() for x in K._unpack_keys(r["keys"]).tolist()]
        assert len(keys) == len(set(keys)) == len(m.counts[level])
    assert K.score(documents(spark, []), model).count() == 0


def test_four_words_read_the_counts_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 300)
    rows = DOCS[::3]
    got = sorted(map(tuple, K.score_documents(documents(spark, rows), 4).collect()))
    want = sorted(Direct(rows, 4).rows())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[6] - w[6]) < 1e-6 for g, w in zip(got, want))


def test_tables_between_the_steps_stay_small(spark, monkeypatch):
    """What lies in stage tables at once, in bytes a token (8.7 when they held every P and the histories of a whole level);
    the histories of a level move in turns."""
    monkeypatch.setattr(K, "CHUNK", 20_000)
    monkeypatch.setattr(K, "shuffle_parts", lambda _: 3)
    write, drop, weigh = K.materialise, K.discard, K.weigh
    live, peak, ranges = {}, [], []

    def materialise(df, name, bucket=None):
        out = write(df, name, bucket)
        kinds = [c for c, kind in out.dtypes if kind == "binary"]
        live[id(out)] = out, name, sum(len(r[c]) for r in out.select(*kinds).collect() for c in kinds if r[c] is not None)
        peak.append(sum(x[2] for x in live.values()))
        return out

    def discard(df):
        live.pop(id(df))
        drop(df)

    def spied(held, stats, parts, level, start, end):
        ranges.append((level, parts, start, end))
        return weigh(held, stats, parts, level, start, end)

    monkeypatch.setattr(K, "materialise", materialise)
    monkeypatch.setattr(K, "discard", discard)
    monkeypatch.setattr(K, "weigh", spied)
    words = random.Random(1)
    rows = [(k, " ".join(f"w{int(words.paretovariate(0.7))}" for _ in range(400))) for k in range(150)]
    assert K.score_documents(documents(spark, rows).coalesce(1)).count() == len(rows)
    assert max(peak) < 5 * 150 * 401
    for level in (2, 3):
        mine = [(a, b) for x, _, a, b in ranges if x == level]
        assert len(mine) == 2 and [k for a, b in mine for k in range(a, b)] == list(range(6))
