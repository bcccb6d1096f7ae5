"""Packing along a space-filling curve (op11): ids, gapless sequences, no padding, neighbours on the curve."""
import itertools
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import awkward, documents, prose
from tokenizers import Tokenizer

from tidewatch.llm import curve_packing as P


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer, capacity=1024):
    """Every id of every document once, sequences without gaps, and full or a power of two long."""
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    want, got = Counter(), Counter()
    for d, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.update((d, k, x) for k, x in enumerate(ids))
    left = {d: [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for e, t in texts if e == d] for d in {d for d, _ in texts}}
    for d, pieces in by.items():
        for r in pieces:
            fits = [x for x in left[d] if len(x) == r.doc_tokens and zlib.crc32(struct.pack(f"<{r.length}I", *x[r.start:r.start + r.length])) == r.ids_crc32]
            assert fits, r
            got.update((d, r.start + k, x) for k, x in enumerate(fits[0][r.start:r.start + r.length]))
    assert got == want
    short = 0
    for places in sequences.values():
        at = 0
        for o, n in sorted(places):
            assert o == at and n > 0
            at += n
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
        short += at < capacity
    assert short <= capacity.bit_length()


@pytest.mark.parametrize("capacity", [1024, 32])
def test_awkward_documents(spark, tokenizer, capacity):
    rows = awkward() + [(60, "x<|endoftext|>y"), (61, " ")]
    df = documents(spark, rows).repartition(4)
    got = P.pack_along_curve(df, capacity, with_ids=True).collect()
    assert all(zlib.crc32(struct.pack(f"<{r.length}I", *r.ids)) == r.ids_crc32 for r in got)
    check(got, [(d, t) for d, t, *_ in rows], tokenizer, capacity)


def test_empty_table_and_one_row(spark, tokenizer):
    assert P.pack_along_curve(documents(spark, [])).count() == 0
    (r,) = P.pack_along_curve(documents(spark, [(None, None)])).collect()
    assert tuple(r) == (None, 0, 1, zlib.crc32(bytes(4)), 1, 0, 0)


def test_whole_table_copies_and_tail(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(P.q_op11(spark, sf).collect(), texts, tokenizer)
    same = prose(3, 50)
    rows = [(k, same if k % 3 else prose(k, 30)) for k in range(120)]  # copies share one place on the curve
    check(P.pack_along_curve(documents(spark, rows).repartition(7)).collect(), rows, tokenizer)


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_meets_every_cell_and_moves_one_step(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = P.hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_line_cuts_are_powers_of_two():
    for total in (0, 1, 1023, 1024, 1025, 5_000, 10 ** 12 + 777):
        ends = [total - total % 1024, *P.line_cuts(total, 1024)]
        steps = [b - a for a, b in zip(ends, ends[1:])]
        assert ends[-1] == total and all(s & (s - 1) == 0 for s in steps) and steps == sorted(steps, reverse=True)


def test_like_documents_meet(spark):
    """Six vocabularies, dealt at random: along the curve the next document is of the same kind over twice as often as by chance."""
    r = random.Random(1)
    words = [prose(100 + k, 60).split() for k in range(6)]
    kind = {k: r.randrange(6) for k in range(600)}
    rows = [(k, " ".join(r.choices(words[kind[k]], k=60))) for k in kind]
    pieces = P.pack_along_curve(documents(spark, rows).repartition(5)).collect()
    line = [x.doc_id for x in sorted(pieces, key=lambda x: (x.sequence_id, x.offset)) if x.start == 0]
    assert sum(kind[a] == kind[b] for a, b in zip(line, line[1:])) / len(line) > 2 / 6
