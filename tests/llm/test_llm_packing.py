"""Best-fit packing (op6): ids, gapless sequences, few sequences."""
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from llm_cases import awkward, documents
from tokenizers import Tokenizer

from tidewatch.llm import packing as P
from tidewatch.llm.bpe import encoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_over_all_of_unicode(tokenizer):
    e = encoder()
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(chars), 2048):
        part = chars[k:k + 2048]
        texts = ["".join(f"a{c}{c}b {c}1 {c}\n" for c in part[j:j + 256]) for j in range(0, len(part), 256)] + ["".join(part)]
        for t in texts:
            assert e.encode(t, allowed_special="all") == tokenizer.encode(t, add_special_tokens=False).ids
    t = "x<|endoftext|>y  <|endoftext|>"
    assert e.encode(t, allowed_special="all") == tokenizer.encode(t, add_special_tokens=False).ids


def check(rows, docs, capacity, tokenizer):
    by, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append((r.offset, r.length))
    for d, texts in docs.items():
        want = Counter()
        for t in texts:
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
            first, start = len(ids) % capacity or capacity, 0
            for k in range(-(-len(ids) // capacity)):
                n = first if k == 0 else capacity
                want[k, start, n, zlib.crc32(struct.pack(f"<{n}I", *ids[start:start + n]))] += 1
                start += n
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by[d]) == want
    for places in seq.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    return len(seq), sum(r.length for r in rows) / capacity


def test_awkward_documents(spark, tokenizer):
    rows = awkward()
    docs = defaultdict(list)
    for d, t, *_ in rows:
        docs[d].append(t)
    df = documents(spark, rows).repartition(4)
    check(P.pack(df).collect(), docs, 2048, tokenizer)
    check(P.pack(df, capacity=32).collect(), docs, 32, tokenizer)
    ids = P.pack(df, capacity=32, with_ids=True).collect()
    assert all(zlib.crc32(struct.pack(f"<{r.length}I", *r.ids)) == r.ids_crc32 for r in ids)
    assert P.pack(documents(spark, [])).count() == 0


def test_whole_table_uses_few_sequences(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    docs = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        docs[r.doc_id].append(r.text)
    used, least = check(P.q_op6(spark, sf).collect(), docs, 2048, tokenizer)
    assert used <= least * 1.01 + 1


def test_plans_cover_all_pieces_and_match_best_fit_decreasing():
    r = random.Random(2)
    for case in range(12):
        capacity = r.choice([10, 64, 2048])
        counts = {k: r.randint(0, 50) for k in r.sample(range(1, capacity + 1), min(capacity, 40))}
        counts = {k: n for k, n in counts.items() if n}
        seq, seen = defaultdict(list), Counter()
        for length, a, b, first, m, place in P.plan(counts, capacity):
            for rank in range(a, b):
                seen[length, rank] += 1
                seq[first + (rank - a) // m].append((place + (rank - a) % m * length, length))
        assert seen == Counter({(x, k): 1 for x, n in counts.items() for k in range(n)})
        for places in seq.values():
            at = 0
            for o, n in sorted(places):
                assert o == at
                at += n
            assert at <= capacity
        bins: list[int] = []
        for x in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
            fit = [k for k, left in enumerate(bins) if left >= x]
            if fit:
                bins[min(fit, key=bins.__getitem__)] -= x
            else:
                bins.append(capacity - x)
        assert len(seq) <= len(bins) * 1.02 + 2
    assert P.plan({}) == []
