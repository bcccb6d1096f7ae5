"""Alignment of two tokenizers over the same bytes, by lockstep merging.

Both encodings of a text cut the same bytes.  Two pointers, one per encoding, walk
over them: the tokens they stand on overlap (a *link*); the one that ends first moves
on, both move where both end (a *cut*, the end of a group).  All documents of a batch
walk at once: one NumPy state vector holds the pointers, every step emits a link for
each walker, the cuts, and the moves, and finished walkers are compacted away.

A long document would leave the others waiting, so its bytes are dealt to several
walkers of ``LANE`` bytes each.  A link belongs to the walker in whose range its
overlap begins, so each link is found exactly once, wherever the ranges are cut.

Counts of id pairs are over all links of the corpus:

* documents become *chunks* of about ``CHUNK`` links, written once: per document its
  figures, and which of the chunk's distinct id pairs it links how often;
* each chunk's distinct pairs with their counts are summed by (b, a), so the most
  frequent pair ships one row per chunk and is pre-added per task; a partner count
  that is the highest of its B id is marked (a B id has at most as many partners as
  the other vocabulary has entries);
* the sums go back to the chunks that asked, in a co-group by chunk, where n_best and
  count_sum follow by one weighted sum.  Nothing passes through the driver, and a
  group has at most the size of one chunk.

Defined cases: null and empty texts, and texts whose joined token bytes differ from
a space and the text in either encoding (such as texts that hold U+2581), have no
tokens: zeros and an empty groups_sha256; they count no links.  Null ids are kept,
repeated rows are documents of their own, an empty table gives no rows, extra columns
are ignored.
"""
from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bpe import RANKS, encoder
from tidewatch.llm.common import (map_batches, materialise, pack_planes, pack_sorted, pick, table, texts, unpack_planes,
                                  unpack_sorted)

PIECES = "piece_bpe_32k.model"
#: Bytes that one walker covers, text bytes merged at once, links of a chunk.
LANE, BLOCK, CHUNK = 384, 1 << 20, 1 << 21
#: Bits of an id inside a pair's key; a vocabulary has at most 2 ** BITS entries.
BITS = 20
FIGURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
CHUNKS = "chunk long, docs binary, places binary, times binary, pairs binary, counts binary"
SPACE = "▁"


# --- vocabularies --------------------------------------------------------------------

class Spelling:
    """Byte strings of codes 0, 1, ..., laid end to end."""

    def __init__(self, entries: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.lengths = np.array([*map(len, entries)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def write(self, codes: np.ndarray) -> np.ndarray:
        """The bytes of all codes, joined."""
        n = self.lengths[codes]
        at = np.repeat(self.starts[codes] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return self.flat[at]


class Vocabulary(NamedTuple):
    encode: object
    size: int
    bytes: Spelling


def vocabulary(encode, entries: list[bytes]) -> Vocabulary:
    if len(entries) > 1 << BITS:
        raise ValueError(f"a vocabulary may have {1 << BITS} entries, not {len(entries)}")
    return Vocabulary(encode, len(entries), Spelling(entries))


@functools.lru_cache(maxsize=4)
def byte_level(ranks: str = RANKS) -> Vocabulary:
    """A: ids of byte-level BPE without special tokens, and the bytes of every id."""
    e = encoder(ranks)
    entries = [e.decode_single_token_bytes(k) for k in range(e.n_vocab)]

    def encode(rows: list[str]) -> list[np.ndarray]:
        return [e.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in rows]

    return vocabulary(encode, entries)


@functools.lru_cache(maxsize=4)
def pieces(model: str = PIECES) -> Vocabulary:
    """B: ids of the piece model, and the bytes of every id."""
    import public_tokenizers
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model if os.path.isabs(model) else public_tokenizers.path(model))
    entries = [bytes([int(p.id_to_piece(k)[1:-1], 16)]) if p.is_byte(k) else p.id_to_piece(k).replace(SPACE, " ").encode()
               for k in range(p.get_piece_size())]

    def encode(rows: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in p.encode(rows, num_threads=1)]

    return vocabulary(encode, entries)


# --- lockstep merging -------------------------------------------------------------------

def merge(ends_a: np.ndarray, ends_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (places in A, places in B) and cuts (place in A, place in B) of many documents laid end to end.

    ``ends_*``: end offsets of the tokens in the bytes of all documents together; both
    encodings end where a document does, so no link reaches over that border.
    """
    start = np.arange(0, int(ends_a[-1]) if len(ends_a) else 0, lane)
    stop = start + lane
    a, b = np.searchsorted(ends_a, start, "right"), np.searchsorted(ends_b, start, "right")  # tokens that hold a range's first byte
    begin_a, begin_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    # an overlap that begins before the range belongs, with the cut at its end, to the walker before
    ours = np.maximum(begin_a[a], begin_b[b]) >= start if len(a) else np.zeros(0, bool)
    link_a, link_b, cut_a, cut_b = [], [], [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        if ours is not None:
            link_a.append(a[ours])
            link_b.append(b[ours])
            both, ours = both & ours, None
        else:
            link_a.append(a)
            link_b.append(b)
        cut_a.append(a[both])
        cut_b.append(b[both])
        on = np.minimum(end_a, end_b) < np.minimum(stop, ends_a[-1])  # the next overlap begins there
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        if not on.all():
            a, b, stop = a[on], b[on], stop[on]
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (link_a, link_b, cut_a, cut_b))


class Aligned(NamedTuple):
    """Figures per document, and the links of a block (document, A id, B id)."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    shas: list[str]
    doc: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray


def groups(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
    """Codes 4 * id + kind in the order of the groups' text: of each group its A ids, then its B ids.

    kind: bit 0 for B, bit 1 for the last id of its side of the group.
    """
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[cut_a], last_b[cut_b] = 1, 1
    cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    before_b = np.concatenate([[0], cut_b + 1])  # B ids before each group
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    out[np.arange(len(ids_a)) + before_b[group_a]] = 4 * ids_a + 2 * last_a
    out[np.arange(len(ids_b)) + (cut_a + 1)[group_b]] = 4 * ids_b + 2 * last_b + 1
    return out


@functools.lru_cache(maxsize=2)
def _marks(size: int) -> Spelling:
    """Text of every code: the id and what follows it."""
    ends = (b",", b",", b"|", b";")
    return Spelling([b"%d%s" % (k, ends[j]) for k in range(size) for j in range(4)])


def _same_bytes(whole: list[bytes], ids: list[np.ndarray], v: Vocabulary) -> np.ndarray:
    """Whether the joined bytes of each row's ids are the row's."""
    lengths = np.array([v.bytes.lengths[x].sum() for x in ids], np.int64)
    same = lengths == np.array([*map(len, whole)], np.int64)
    at = np.flatnonzero(same)  # the others differ in length
    if len(at):
        want = np.frombuffer(b"".join([whole[n] for n in at]), np.uint8)
        differ = np.flatnonzero(want != v.bytes.write(np.concatenate([ids[n] for n in at])))
        same[at[np.searchsorted(np.cumsum(lengths[at]), differ, "right")]] = False
    return same


def align(rows: list[bytes | None], a: Vocabulary, b: Vocabulary, lane: int = LANE) -> Aligned:
    """Both encodings of some texts, merged in lockstep."""
    known = [k for k, t in enumerate(rows) if t]
    strings = [rows[k].decode("utf-8", "replace") for k in known]
    ids_a, ids_b, whole = a.encode(strings), b.encode(strings), [b" " + rows[k] for k in known]
    sound = np.flatnonzero(_same_bytes(whole, ids_a, a) & _same_bytes(whole, ids_b, b)) if known else []
    rows_of = np.array([known[n] for n in sound], np.int64)
    size_a, size_b = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    size_a[rows_of], size_b[rows_of] = [len(ids_a[n]) for n in sound], [len(ids_b[n]) for n in sound]
    none = [np.zeros(0, np.int64)]
    all_a, all_b = np.concatenate([ids_a[n] for n in sound] or none), np.concatenate([ids_b[n] for n in sound] or none)
    ends_a, ends_b = np.cumsum(a.bytes.lengths[all_a]), np.cumsum(b.bytes.lengths[all_b])
    link_a, link_b, cut_a, cut_b = merge(ends_a, ends_b, lane)
    doc_a = np.repeat(np.arange(len(rows)), size_a)
    doc = doc_a[link_a]
    n_groups, n_links = np.bincount(doc_a[cut_a], minlength=len(rows)), np.bincount(doc, minlength=len(rows))
    marks = _marks(max(a.size, b.size))
    codes = groups(all_a, all_b, cut_a, cut_b)
    text, upto = marks.write(codes).tobytes(), np.cumsum(marks.lengths[codes])
    shas, at, lo = [], 0, 0
    for n in (size_a + size_b).tolist():
        at += n
        hi = int(upto[at - 1]) if at else 0
        shas.append(hashlib.sha256(text[lo:hi - 1]).hexdigest() if n else "")  # without the last ";"
        lo = hi
    return Aligned(size_a, size_b, n_groups, n_links, shas, doc, all_a[link_a], all_b[link_b])


# --- chunks --------------------------------------------------------------------------------

class Chunk:
    """Documents in the making of a chunk: figures, and their distinct id pairs with multiplicities."""

    def __init__(self) -> None:
        self.rows, self.keys, self.times, self.sizes, self.links = [], [], [], [], 0

    def add(self, ids: list, x: Aligned) -> None:
        key = np.sort((x.doc << 2 * BITS) | (x.ids_b << BITS) | x.ids_a)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.times.append(np.diff(first, append=len(key)))
        key = key[first]
        self.keys.append(key & ((1 << 2 * BITS) - 1))
        sizes = np.bincount(key >> 2 * BITS, minlength=len(ids))
        self.rows += zip(ids, x.n_a.tolist(), x.n_b.tolist(), x.n_groups.tolist(), x.n_links.tolist(), x.shas, sizes.tolist())
        self.links += len(x.doc)

    def row(self, number: int) -> tuple:
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        distinct, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, times, len(distinct)).astype(np.int64)
        kinds = [pa.int64()] * 5 + [pa.string(), pa.int64()]
        meta = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*self.rows), kinds)],
                                          ["doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "size"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, meta.schema) as w:
            w.write_batch(meta)
        sizes = meta.column("size").to_numpy()
        steps = np.diff(place, prepend=0)  # places rise within a document
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[first] = place[first]
        return (number, sink.getvalue().to_pybytes(), pack_planes(steps), pack_planes(times), pack_sorted(distinct.astype(np.uint64)),
                pack_planes(counts))


def read_places(packed: bytes, sizes: np.ndarray) -> np.ndarray:
    """Places of the pairs of all documents of a chunk, from their steps."""
    total = np.cumsum(unpack_planes(packed))
    before = np.concatenate([[0], total])[np.cumsum(sizes) - sizes]
    return total - np.repeat(before, sizes)


def chunks(docs: DataFrame, ranks: str = RANKS, model: str = PIECES) -> DataFrame:
    """All documents aligned, as chunks."""
    size, block, lane = CHUNK, BLOCK, LANE
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(ranks), pieces(model)
        number, chunk = TaskContext.get().partitionId() << 32, Chunk()

        def out():
            nonlocal number, chunk
            row = chunk.row(number)
            number, chunk = number + 1, Chunk()
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if k == 0 else pa.binary()) for k, x in enumerate(row)], names)

        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), texts(batch.column("text"))
            lo, held = 0, 0
            for hi, t in enumerate([*rows, None]):
                if hi == len(rows) or (hi > lo and held + len(t or b"") > block):
                    if hi > lo:
                        chunk.add(ids[lo:hi], align(rows[lo:hi], a, b, lane))
                        if chunk.links >= size:
                            yield out()
                    lo, held = hi, 0
                held += len(t or b"")
        if chunk.rows:
            yield out()

    return map_batches(pick(docs, "doc_id", "text"), run, CHUNKS)


def asked_pairs(stored: DataFrame) -> DataFrame:
    """(chunk, place, b, a, n): each chunk's distinct id pairs, in order, with their links in the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, pairs, counts in zip(*(c.to_pylist() for c in b.columns)):
                key, n = unpack_sorted(pairs).astype(np.int64), unpack_planes(counts)
                for k in range(0, len(key), 1 << 16):
                    part = key[k:k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), chunk)), pa.array(np.arange(k, k + len(part), dtype=np.int32)),
                         pa.array((part >> BITS).astype(np.int32)), pa.array((part & ((1 << BITS) - 1)).astype(np.int32)), pa.array(n[k:k + (1 << 16)])],
                        ["chunk", "place", "b", "a", "n"])

    return map_batches(stored.select("chunk", "pairs", "counts"), run, "chunk long, place int, b int, a int, n long")


def pair_counts(asked: DataFrame) -> DataFrame:
    """(b, a, count, best): links of every id pair in the corpus, and whether no pair of that B id has more."""
    counts = materialise(asked.groupBy("b", "a").agg(F.sum("n").alias("count")), "align-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("b", "a", "count", (F.col("count") == F.col("top")).alias("best"))


def align_documents(docs: DataFrame, ranks: str = RANKS, model: str = PIECES) -> DataFrame:
    """FIGURES of every document."""
    stored = materialise(chunks(docs, ranks, model), "align-chunks")
    asked = asked_pairs(stored)
    answers = asked.join(pair_counts(asked), ["b", "a"]).select("chunk", "place", "count", "best")

    def evaluate(answer: pa.Table, chunk: pa.Table) -> pa.Table:
        docs_of, places, times = (chunk.column(k)[0].as_py() for k in ("docs", "places", "times"))
        meta = pa.ipc.open_stream(pa.BufferReader(docs_of)).read_all()
        sizes = meta.column("size").to_numpy()
        at, times = read_places(places, sizes), unpack_planes(times)
        place, n = answer.column("place").to_numpy(), len(answer)
        per = []
        for name in ("best", "count"):
            value = np.zeros(n, np.int64)
            value[place] = answer.column(name).to_numpy()
            total = np.concatenate([[0], np.cumsum(times * value[at])])
            upto = np.cumsum(sizes)
            per.append(pa.array(total[upto] - total[upto - sizes]))
        return pa.table([*(meta.column(k) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *per, meta.column("sha")],
                        names=[c.split()[0] for c in FIGURES.split(", ")])

    kept = stored.select("chunk", "docs", "places", "times")
    return answers.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(evaluate, FIGURES)


def q_op12(spark, sf_dir):
    return align_documents(table(spark, sf_dir, "documents"))
