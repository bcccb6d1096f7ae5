"""Cross-tokenizer alignment (op12) against a direct version on the libraries themselves."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import awkward, documents, prose
from tokenizers import Tokenizer

from tidewatch.llm import alignment as L


@pytest.fixture(scope="module")
def direct():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # byte-level alphabet: printable characters stand for themselves, the rest follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}

    def bytes_a(k):
        return bytes(char[c] for c in first.id_to_token(k))

    def bytes_b(k):
        p = second.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and p.endswith(">") else p.replace("▁", " ").encode()

    def spans(ids, spell):
        out, at = [], 0
        for k in ids:
            out.append((at, at + len(spell(k))))
            at = out[-1][1]
        return out

    def one(text):
        """ids of A and B, groups, links as places."""
        if not text:
            return [], [], [], []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        whole = b" " + text.encode()
        if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            return [], [], [], []
        sa, sb = spans(a, bytes_a), spans(b, bytes_b)
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, lo = [], 0
        for hi in cuts:
            groups.append(([x for x, (s, e) in zip(a, sa) if lo <= s and e <= hi], [x for x, (s, e) in zip(b, sb) if lo <= s and e <= hi]))
            lo = hi
        links = [(i, j) for i, (s, e) in enumerate(sa) for j, (u, v) in enumerate(sb) if s < v and u < e]
        return a, b, groups, links

    def every(rows):
        done = [(d, one(t)) for d, t, *_ in rows]
        count = Counter((a[i], b[j]) for _, (a, b, _, links) in done for i, j in links)
        best = defaultdict(int)
        for (_, y), n in count.items():
            best[y] = max(best[y], n)
        out = []
        for d, (a, b, groups, links) in done:
            pairs = [(a[i], b[j]) for i, j in links]
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((d, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs),
                        hashlib.sha256(text.encode()).hexdigest() if a else ""))
        return sorted(out, key=repr)

    return every


ODD = [(50, "</s>[INST] <|endoftext|> <s><unk><0x41> <|endoftext|>"), (51, "a▁b"), (52, "x" * 3_000), (53, " " * 900 + "y"), (54, "日本語" * 200),
       (55, "tab\tnew\nline\r\n\x0b\x00 nul"), (56, "éá 🏳️‍🌈 👩‍👩‍👧 ‮ ﻿ ﬁ ½"), (57, "  two  spaces  "), (58, " "), (59, "1234567890" * 40)]


@pytest.mark.parametrize("lane, chunk, block", [(L.LANE, L.CHUNK, L.BLOCK), (7, 500, 300)])
def test_rows_equal_the_direct_version(spark, monkeypatch, direct, lane, chunk, block):
    for name, value in (("LANE", lane), ("CHUNK", chunk), ("BLOCK", block)):
        monkeypatch.setattr(L, name, value)  # the second values make many walkers and chunks
    rows = [(d, t if t is None or len(t) < 9_000 else t[:4_000]) for d, t, *_ in awkward()] + ODD
    got = L.align_documents(documents(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == direct(rows)


def test_a_third_of_all_rows_alike_and_a_long_text(spark, direct, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 400)
    same = prose(9, 30)
    rows = [(k, same if k % 3 == 0 else prose(k, 25)) for k in range(90)] + [(500, prose(77, 300))]
    assert sorted(map(tuple, L.align_documents(documents(spark, rows).repartition(6)).collect()), key=repr) == direct(rows)


def test_no_rows_and_no_tokens(spark):
    assert L.align_documents(documents(spark, [])).count() == 0
    got = L.align_documents(documents(spark, [(1, None), (2, ""), (None, "a▁b")])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, None)], key=repr)


def test_merging_equals_pairwise_overlaps():
    r = random.Random(5)
    for _ in range(60):
        size = r.randint(1, 120)
        a, b = (np.array(sorted({*r.sample(range(1, size + 1), r.randint(0, size)), size})) for _ in "ab")
        got = L.merge(a, b, r.choice([1, 3, 16, 500]))
        begin_a, begin_b = [0, *a[:-1]], [0, *b[:-1]]
        want = sorted((i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i])
        assert sorted(zip(*map(np.ndarray.tolist, got[:2]))) == want
        assert sorted(a[got[2]].tolist()) == sorted(b[got[3]].tolist()) == sorted({*a.tolist()} & {*b.tolist()})
    assert [len(x) for x in L.merge(np.zeros(0, int), np.zeros(0, int))] == [0, 0, 0, 0]


def test_whole_table(spark, direct):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text or "") < 3_000]
    sample = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, L.align_documents(sample).collect()), key=repr) == direct(rows)
    assert L.q_op12(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
