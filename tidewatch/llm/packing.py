"""Best-fit packing by linear grouping.

The pieces of all documents are packed into sequences of ``capacity`` tokens:

1. lengths above a part of the capacity are cut, from the longest on, into groups
   of equal cardinality and each is rounded up to the longest of its group;
2. with these few sizes, the best mix of configurations (how many of each size
   in a sequence) is found by column generation: a linear programme over
   configurations whose new columns come from an exact knapsack;
3. actual pieces take the places of their group, longest first, which leaves
   the space that rounding had claimed;
4. small pieces, longest first, go to the sequence they leave least space in.

All planning works on the number of pieces per length, at most ``capacity``
numbers, whatever the size of the corpus; sequences with equal contents are
one *run*.  Its result is a small table: pieces of length L with ranks r0 to
r1 go to the sequences from s0 on, m in each, from place p.  Spark numbers the
pieces of each length (a running number per task while they are written, and
prefix sums of the tasks' counts) and joins the two.

Defined cases: null text is empty (one token, the end id); repeated rows are
packed as often as they occur; an empty table gives no rows; null doc_id is
kept; extra columns are ignored.
"""
from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.bpe import RANKS, encoder
from tidewatch.llm.common import map_batches, materialise, pick, table, texts

CAPACITY = 2048
END_ID = 0
#: (groups, divisor): lengths up to capacity / divisor are small.  Planning is cheap, so every
#: setting is tried and the one with fewest sequences taken.
SETTINGS = ((40, 2), (80, 3), (60, 4), (60, 8))
PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"


# --- planning on counts per length (driver; bounded by the capacity) ---------

def _knapsack(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of sizes within the capacity."""
    use = [j for j in range(len(sizes)) if values[j] > 1e-12]
    if not use:
        return 0.0, np.zeros(len(sizes), int)
    s, v = np.array([sizes[j] for j in use]), values[use]
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(s)
    s, v, use = s[order], v[order], [use[k] for k in order]
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = bisect.bisect_right(s, c)
        if k:
            gain = best[c - s[:k]] + v[:k]
            j = int(gain.argmax())
            if gain[j] > best[c] + 1e-15:
                best[c], took[c] = gain[j], j
    counts, c = np.zeros(len(sizes), int), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[use[took[c]]] += 1
            c -= s[took[c]]
    return best[capacity], counts


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """[(items of each size, sequences)] that cover the demand exactly: column generation, rounded down, then the rest greedily."""
    m = len(sizes)
    d = np.array(demand, float)
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    x = d / basis.diagonal()
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(m))
        value, column = _knapsack(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        u = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        r = int(ratio.argmin())
        basis[:, r] = column
        x = np.maximum(np.linalg.solve(basis, d), 0)
    out, left = [], np.array(demand, np.int64)
    for k in np.argsort(-x):
        a = basis[:, k].astype(np.int64)
        n = min([int(x[k] + 1e-6), *(left[a > 0] // a[a > 0])])
        if n > 0:
            out.append((a, n))
            left -= a * n
    while left.any():
        a, room = np.zeros(m, np.int64), capacity
        for j in range(m):  # sizes come longest first
            a[j] = min(left[j], room // sizes[j])
            room -= a[j] * sizes[j]
        n = int((left[a > 0] // a[a > 0]).min())
        out.append((a, n))
        left -= a * n
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY, settings=SETTINGS) -> list[tuple[int, int, int, int, int, int]]:
    """[(length, first rank, end rank, first sequence, pieces per sequence, place)] for all pieces."""
    return min((_plan(counts, capacity, g, d) for g, d in settings), key=lambda p: p[0])[1]


def _plan(counts: dict[int, int], capacity: int, groups: int, small: int) -> tuple[int, list]:
    """Number of sequences and the plan under one setting."""
    lengths = sorted((x for x in counts if counts[x] > 0), reverse=True)
    big = [x for x in lengths if x > capacity // small]
    total = sum(counts[x] for x in big)
    # 1. groups of equal cardinality; a length may be in two groups
    each = -(-total // groups) if total else 1
    sizes, demand, queues = [], [], []
    room = 0
    for x in big:
        n = counts[x]
        while n:
            if not room:
                sizes.append(x)
                demand.append(0)
                queues.append([])
                room = each
            k = min(n, room)
            demand[-1] += k
            queues[-1].append([x, k])
            n, room = n - k, room - k
    merged: dict[int, int] = {}
    for j, s in enumerate(sizes):  # groups rounded to the same length are one size
        if s in merged:
            demand[merged[s]] += demand[j]
            queues[merged[s]] += queues[j]
        else:
            merged[s] = j
    keep = sorted(merged.values())
    sizes, demand, queues = ([z[j] for j in keep] for z in (sizes, demand, queues))
    # 2. and 3. runs of sequences with equal contents, actual lengths substituted
    runs: list[list] = []  # [sequences, contents as [(length, copies)]]
    for a, n in configurations(sizes, demand, capacity) if sizes else []:
        cuts, slots = {0, n}, []
        for j in np.flatnonzero(a):
            for _ in range(a[j]):
                at, parts = 0, []
                while at < n:
                    x, k = queues[j][0]
                    t = min(k, n - at)
                    parts.append((at, x))
                    at += t
                    cuts.add(at)
                    if t == k:
                        queues[j].pop(0)
                    else:
                        queues[j][0][1] -= t
                slots.append(parts)
        edges = sorted(cuts)
        for lo, hi in zip(edges, edges[1:]):
            content = [next(x for at, x in reversed(parts) if at <= lo) for parts in slots]
            runs.append([hi - lo, [(x, 1) for x in content]])
    # 4. best fit of the small ones
    free: dict[int, list] = {}  # space left -> runs
    spaces: list[int] = []

    def put(run: list) -> None:
        r = capacity - sum(x * k for x, k in run[1])
        if r not in free:
            free[r] = []
            bisect.insort(spaces, r)
        free[r].append(run)

    for run in runs:
        put(run)
    for x in (y for y in lengths if y <= capacity // small):
        n = counts[x]
        while n:
            at = bisect.bisect_left(spaces, x)
            if at < len(spaces):
                r = spaces[at]
                seqs, content = free[r].pop()
                if not free[r]:
                    del free[r]
                    spaces.pop(at)
            else:
                r, content = capacity, []
                seqs = -(-n // (capacity // x))
            m = r // x
            whole = min(seqs, n // m)
            n -= whole * m
            if whole:
                put([whole, [*content, (x, m)]])
                seqs -= whole
            if seqs and n and n < m:
                put([1, [*content, (x, n)]])
                n, seqs = 0, seqs - 1
            if seqs and content:
                put([seqs, content])
    # places and ranks
    out, rank, first = [], dict.fromkeys(lengths, 0), 0
    for seqs, content in (run for r in sorted(free) for run in free[r]):
        place = 0
        for x, m in content:
            out.append((x, rank[x], rank[x] + seqs * m, first, m, place))
            rank[x] += seqs * m
            place += x * m
        first += seqs
    assert all(rank[x] == counts[x] for x in lengths)
    return first, out


# --- Spark ---------------------------------------------------------------------

def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: only the first may be short."""
    first = n % capacity or capacity
    return [(0, first), *((k, capacity) for k in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, with the task that made them and a running number per task and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks).encode_to_numpy
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in batches:
            rows, ids = [], []
            for doc, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                x = np.append(encode((t or b"").decode("utf-8", "replace"), allowed_special="all"), END_ID).astype("<u4")
                for k, (start, n) in enumerate(cut(len(x), capacity)):
                    piece = x[start:start + n]
                    rows.append((doc, k, start, n, zlib.crc32(piece.tobytes()), part, seen[n]))
                    seen[n] += 1
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))))
            yield pa.RecordBatch.from_arrays(cols, names)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
    schema = PIECE + ", part int, nth long" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return map_batches(pick(docs, "doc_id", "text"), run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and place: columns of PIECE, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    p = materialise(pieces(docs, capacity, ranks, with_ids), "pack-pieces")
    per = p.groupBy("part", "length").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows reach the driver
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = spark.createDataFrame(plan(counts, capacity), "p_length int, r0 long, r1 long, s0 long, m long, place long")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    base = per.select(F.col("part").alias("b_part"), F.col("length").alias("b_length"),
                      F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = p.join(base, (p["part"] == base["b_part"]) & (p["length"] == base["b_length"])).withColumn("rank", F.col("base") + F.col("nth"))
    # the plan has a few thousand rows at any size of input: lengths are at most ``capacity``
    placed = ranked.join(F.broadcast(steps), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("r0")) & (F.col("rank") < F.col("r1")))
    k = F.col("rank") - F.col("r0")
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         (F.col("s0") + F.floor(k / F.col("m"))).alias("sequence_id"),
                         (F.col("place") + (k % F.col("m")) * F.col("length")).alias("offset"), *(["ids"] if with_ids else []))


def q_op6(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
