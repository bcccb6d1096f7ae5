"""Packing along a space-filling curve.

Neighbouring documents should share a sequence, and no sequence should be padded:

1. every document's ids are counted into ``HASHED`` signed buckets (weight 1 + log of
   the count, unit length) and projected to ``DIMS`` dimensions by a fixed random
   projection; the ids are written once, next to the projection;
2. each dimension is cut at quantiles of all documents, from Spark's mergeable sketch,
   into 2 ** ``BITS`` cells of about equal weight;
3. the cells' place on the Hilbert curve is the key; rows without ids are
   range-sorted by it (then by doc_id, task and number, so that any number of
   documents in one cell, such as copies, spreads over tasks);
4. token counts are summed along the order: a running sum per sort partition, and
   one row per partition for the sums before it, give every document its place on the
   line of all tokens;
5. the line is cut every ``capacity`` tokens; what is left at its end is cut at its
   binary digits, since sequences whose length is a power of two need no padding.  So
   no sequence is padded, and documents meet their neighbours on the curve;
6. the places go back to the ids by an equi-join on (task, number), a key that no two
   rows share, and each document is cut into its pieces there.

Defined cases: null text is empty (one token, the end id), its projection is the
origin; repeated rows are packed as often as they occur, ties of the key are ordered
as above; a document of any length is one row of ids (two bytes each) and becomes
pieces in a stream; an empty table gives no rows; null doc_id is kept; extra columns
are ignored.
"""
from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bpe import RANKS, encoder
from tidewatch.llm.common import map_batches, materialise, pick, table, texts

CAPACITY = 1024
END_ID = 0
HASHED, DIMS, BITS, SEED = 512, 4, 7, 11
#: Ids counted at once.
SLICE = 1 << 20
#: Accuracy of the quantile sketch: ranks are right to one part in this many.
ACCURACY = 4096
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# --- numpy kernels ---------------------------------------------------------------------

def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (dimensions * bits up to 63).

    From the highest bit down, each level's corner is undone by reflections and swaps of
    the lower bits; the Gray code of what remains, read across dimensions, is the place.
    """
    x = [cells[:, j].astype(np.int64) for j in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        top, low = np.int64(1 << level), np.int64((1 << level) - 1)
        for j in range(len(x)):
            turned = (x[j] & top) != 0
            swap = np.where(turned, 0, (x[0] ^ x[j]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if j:
                x[j] = x[j] ^ swap
    for j in range(1, len(x)):
        x[j] ^= x[j - 1]
    carry = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((x[-1] >> level) & 1, np.int64((1 << level) - 1), 0)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for y in x:
            key = key << 1 | ((y ^ carry) >> level) & 1
    return key


@functools.lru_cache(maxsize=2)
def _projection(size: int, hashed: int, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and sign of every id, and the projection of the buckets."""
    with np.errstate(over="ignore"):
        h = (np.arange(size, dtype=np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    sign = ((h >> np.uint64(62)) & np.uint64(1)).astype(np.int8) * 2 - 1
    return (h >> np.uint64(32)).astype(np.int64) % hashed, sign, np.random.default_rng(SEED).standard_normal((hashed, dims)) / np.sqrt(dims)


def project(ids: list[np.ndarray], size: int, hashed: int = HASHED, dims: int = DIMS) -> np.ndarray:
    """Projected hashed vectors of some documents."""
    bucket, sign, axes = _projection(size, hashed, dims)
    v = np.zeros(len(ids) * hashed)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), [*map(len, ids)])
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    for k in range(0, len(flat), SLICE):
        some = flat[k:k + SLICE]
        at = doc[k:k + SLICE].astype(np.int64) * hashed + bucket[some]
        v += np.bincount(at, sign[some], len(v))
    v = v.reshape(len(ids), hashed)
    v = np.sign(v) * np.log1p(np.abs(v))
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return (v / np.where(norm > 0, norm, 1)) @ axes


def line_cuts(total: int, capacity: int) -> list[int]:
    """Ends of the sequences after the last full one: the binary digits of what is left, largest first."""
    left, at, out = total % capacity, total - total % capacity, []
    while left:
        step = 1 << left.bit_length() - 1
        at, left = at + step, left - step
        out.append(at)
    return out


# --- Spark ------------------------------------------------------------------------------

def encoded(docs: DataFrame, ranks: str = RANKS, hashed: int = HASHED, dims: int = DIMS) -> DataFrame:
    """Ids of all documents (little-endian, two or four bytes), with their number, the task that made them and the projection."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        width = "<u2" if e.n_vocab <= 1 << 16 else "<u4"
        part, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = [np.append(e.encode_to_numpy((t or b"").decode("utf-8", "replace"), allowed_special="all"), np.uint32(END_ID)) for t in texts(b.column("text"))]
            n = len(ids)
            where = project([x[:-1] for x in ids], e.n_vocab, hashed, dims)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seen, seen + n)), pa.array([*map(len, ids)], pa.int64()),
                 pa.array([x.astype(width).tobytes() for x in ids], pa.binary()), *(pa.array(where[:, j]) for j in range(dims))],
                [c.split()[0] for c in schema.split(", ")])
            seen += n

    schema = "doc_id long, part int, nth long, tokens long, ids binary, " + ", ".join(f"x{j} double" for j in range(dims))
    return map_batches(pick(docs, "doc_id", "text"), run, schema)


def curve_keys(stored: DataFrame, dims: int = DIMS, bits: int = BITS) -> DataFrame:
    """doc_id, part, nth, tokens and the place on the curve."""
    cells = 1 << bits
    shares = [k / cells for k in range(1, cells)]
    # dims * (cells - 1) numbers
    cuts = stored.agg(*[F.percentile_approx(f"x{j}", shares, ACCURACY).alias(f"x{j}") for j in range(dims)]).first()
    edges = [np.array(cuts[f"x{j}"] if cuts[f"x{j}"] is not None else []) for j in range(dims)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.stack([np.searchsorted(edges[j], b.column(f"x{j}").to_numpy(), "right") for j in range(dims)], 1)
            yield pa.RecordBatch.from_arrays([b.column(k) for k in kept] + [pa.array(hilbert_key(at, bits))], [*kept, "key"])

    kept = ["doc_id", "part", "nth", "tokens"]
    return map_batches(stored.select(*kept, *[f"x{j}" for j in range(dims)]), run, "doc_id long, part int, nth long, tokens long, key long")


def places(keyed: DataFrame) -> tuple[DataFrame, int]:
    """(part, nth, place): where each document starts on the line of all tokens in curve order, and the line's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("tokens").to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("nth"), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n),
                                              b.column("tokens")], ["part", "nth", "sorted_part", "local", "tokens"])
            at = int(ends[-1]) if len(n) else at

    order = ["key", "doc_id", "part", "nth"]
    line = materialise(map_batches(keyed.repartitionByRange(*order).sortWithinPartitions(*order), run,
                                   "part int, nth long, sorted_part int, local long, tokens long"), "curve-line")
    # one row per sort partition
    sums = sorted((r["sorted_part"], r["n"]) for r in line.groupBy("sorted_part").agg(F.sum("tokens").alias("n")).collect())
    before, total = [], 0
    for part, n in sums:
        before.append((part, total))
        total += n
    start = line.sparkSession.createDataFrame(before, "sorted_part int, before long")
    return line.join(F.broadcast(start), "sorted_part").select("part", "nth", (F.col("before") + F.col("local")).alias("place")), total


def pack_along_curve(docs: DataFrame, capacity: int = CAPACITY, ranks: str = RANKS, with_ids: bool = False,
                     hashed: int = HASHED, dims: int = DIMS, bits: int = BITS) -> DataFrame:
    """PIECE of every piece of every document (and its ids, if asked for)."""
    stored = materialise(encoded(docs, ranks, hashed, dims), "curve-ids")
    where, total = places(curve_keys(stored, dims, bits))
    full, tail = total // capacity, np.array(line_cuts(total, capacity), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = "<u2" if encoder(ranks).n_vocab <= 1 << 16 else "<u4"
        for b in batches:
            rows, cut_ids = [], []
            for doc, n, packed, place in zip(*(b.column(k).to_pylist() for k in ("doc_id", "tokens", "ids", "place"))):
                ids = np.frombuffer(packed, width).astype("<u4")
                last = min((place + n - 1) // capacity, full)
                ends = np.arange(place // capacity + 1, last + 1) * capacity
                ends = np.unique(np.concatenate([ends, tail, [place + n]]))
                ends = ends[(ends > place) & (ends <= place + n)]
                at = place
                for end in ends.tolist():
                    piece = ids[at - place:end - place]
                    if at < full * capacity:
                        sequence, first = divmod(at, capacity)
                    else:
                        k = int(np.searchsorted(tail, at, "right"))
                        sequence, first = full + k, at - (int(tail[k - 1]) if k else full * capacity)
                    rows.append((doc, at - place, end - at, zlib.crc32(piece.tobytes()), n, sequence, first))
                    if with_ids:
                        cut_ids.append(piece.astype(np.int32))
                    at = end
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 7
            if with_ids:
                offsets = np.cumsum([0, *map(len, cut_ids)], dtype=np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cut_ids) if cut_ids else np.zeros(0, np.int32))))
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = PIECE + ", ids array<int>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    joined = stored.select("doc_id", "tokens", "ids", "part", "nth").join(where, ["part", "nth"])
    return map_batches(joined.select("doc_id", "tokens", "ids", "place"), run, schema)


def q_op11(spark, sf_dir):
    return pack_along_curve(table(spark, sf_dir, "documents"))
