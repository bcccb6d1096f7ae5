"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

Test items are cut into segments of at most ``SEGMENT`` words; an inverted
index holds for every word its postings (segment, impact) in blocks with the
block's largest impact.  Impacts are BM25 contributions divided by the score
the segment gets from itself, so one threshold fits all segments.

Every passage of every document (windows of two strides, one stride apart,
the whole text) is a query of its distinct words.  Bounds from the largest
impacts of blocks, summed for all passages of a batch at once, settle most of
them; the others go through document-at-a-time block-max WAND, which returns
every segment above the threshold.  A hit counts if both the question (all
sentences of the item but the last) and the answer (the last sentence; the
last quarter of the words, if there is one only) share enough word runs with
the passage's neighbourhood.

The index goes to the tasks in shards of at most ``SHARD`` segments, one scan
of the documents each, so what is broadcast has a fixed bound.  Document
frequencies are those of all segments.

Defined cases: null and empty texts have no passages; items without words are
never found; repeated document rows are one document; repeated items with one
id are separate segments under that id; an empty table on either side gives no
rows; extra columns are ignored.
"""
from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, materialise, pick, table, texts

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTENCE = re.compile(rb"(?<=[.!?\n])\s+")
STRIDE = 32
SEGMENT = 64
BLOCK = 4
#: A word in more blocks than this enters the batch bound with its largest impact instead of block by block.
LONG = 64
#: (stride, block) bounds held at once.
HELD = 4_000_000
K1, B = 1.2, 0.75
THRESHOLD = 0.45
RUN = 3
MIN_QUESTION = 0.6
MIN_ANSWER = 0.6
SHARD = 20_000


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def question_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer."""
    sentences = [w for s in SENTENCE.split(text) if (w := words_of(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


class Index:
    """Postings of a shard; ``rows`` are (item, text, segment number), ``df`` and ``n`` count all segments."""

    def __init__(self, rows: list[tuple[int, bytes, int]], df: dict[bytes, int], n: int, mean: float):
        self.items = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        postings: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for k, (_, text, s) in enumerate(rows):
            words = words_of(text)[s * SEGMENT:(s + 1) * SEGMENT]
            norm = K1 * (1 - B + B * len(words) / mean)
            parts = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(words).items()}
            own = sum(parts.values())
            for w, x in parts.items():
                postings[w].append((k, x / own))
        self.vocabulary = {w: k for k, w in enumerate(sorted(postings))}
        self.segments, self.impacts, self.block_max, self.most = [], [], [], []
        for w in sorted(postings):
            seg, imp = zip(*postings[w])
            self.segments.append(seg)
            self.impacts.append(imp)
            self.block_max.append([max(imp[a:a + BLOCK]) for a in range(0, len(imp), BLOCK)])
            self.most.append(max(imp))
        # block lists of all words one after the other, for the batch bound
        self.n_blocks = -(-len(rows) // BLOCK)
        long, ends, blocks, tops = [], [0], [], []
        for seg, imp, most in zip(self.segments, self.impacts, self.most):
            tops_of: dict[int, float] = {}
            for k, x in zip(seg, imp):
                tops_of[k // BLOCK] = max(x, tops_of.get(k // BLOCK, 0.0))
            long.append(most if len(tops_of) > LONG else 0.0)
            if len(tops_of) <= LONG:
                blocks += tops_of.keys()
                tops += tops_of.values()
            ends.append(len(blocks))
        self.long, self.ends = np.array(long), np.array(ends)
        self.blocks, self.tops = np.array(blocks, np.int64), np.array(tops)

    def likely(self, stride: np.ndarray, term: np.ndarray, n: int, threshold: float) -> np.ndarray:
        """Strides s of 0 .. n-2 whose passage (s and s + 1) may reach the threshold in some block.

        (stride, term) are distinct pairs, sorted by stride.  Every block's largest impacts
        are summed per stride; words with long lists add their largest impact to all blocks.
        """
        out = []
        step = max(2, HELD // max(1, self.n_blocks))
        for lo in range(0, n, step - 1):
            a, b = np.searchsorted(stride, [lo, lo + step])
            s, t = stride[a:b] - lo, term[a:b]
            size = self.ends[t + 1] - self.ends[t]
            at = np.repeat(self.ends[t] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            sums = np.bincount(np.repeat(s, size) * self.n_blocks + self.blocks[at], self.tops[at], step * self.n_blocks)
            top = sums.reshape(step, self.n_blocks)
            rest = np.bincount(s, self.long[t], step)
            bound = (top[:-1] + top[1:]).max(1) + rest[:-1] + rest[1:]
            out.append(lo + np.flatnonzero(bound >= threshold - 1e-9))
        return np.concatenate(out)

    def search(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Every (segment, score) with score >= threshold for the distinct ``terms``: block-max WAND."""
        out = []
        limit = threshold - 1e-9
        # cursor: [current segment, place, term]
        cursors = [[self.segments[t][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += self.most[c[2]]
                if total >= limit:
                    pivot = k
                    break
            if pivot < 0:
                break
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            bound, edge = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
            for c in cursors[:pivot + 1]:  # blocks that hold the pivot
                seg = self.segments[c[2]]
                place = bisect_left(seg, at, c[1])
                if place < len(seg):
                    block = place // BLOCK
                    bound += self.block_max[c[2]][block]
                    edge = min(edge, seg[min(len(seg), (block + 1) * BLOCK) - 1] + 1)
            if bound >= limit and cursors[0][0] == at:
                score = sum(self.impacts[c[2]][c[1]] for c in cursors[:pivot + 1])
                if score >= limit:
                    out.append((at, score))
                goal = at + 1
            else:
                goal = at if bound >= limit else max(edge, at + 1)
            for c in cursors[:pivot + 1]:
                if c[0] < goal:
                    seg = self.segments[c[2]]
                    c[1] = bisect_left(seg, goal, c[1])
                    c[0] = seg[c[1]] if c[1] < len(seg) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out


def overlap(part: list[bytes], near: list[bytes], grams: dict[int, set]) -> float:
    """Share of the part's word runs that stand in ``near``; 1 for an empty part."""
    n = min(RUN, len(part))
    if not n:
        return 1.0
    if n not in grams:
        grams[n] = set(zip(*(near[k:] for k in range(n))))
    want = list(zip(*(part[k:] for k in range(n))))
    return sum(x in grams[n] for x in want) / len(want)


def find(docs: list[tuple[int | None, list[bytes]]], index: Index, threshold: float = THRESHOLD) -> list[tuple]:
    """(doc, item, score, question overlap, answer overlap) of all verified hits."""
    size = len(index.vocabulary)
    ids = [np.fromiter(map(index.vocabulary.get, w, repeat(-1)), np.int64, len(w)) for _, w in docs]
    strides = np.array([-(-len(w) // STRIDE) for _, w in docs])
    first = np.concatenate([[0], np.cumsum(strides + 1)])  # one empty stride after each document
    where = [f + np.arange(len(x)) // STRIDE for f, x in zip(first, ids)]
    ids, where = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, where))
    key = np.unique(where[ids >= 0] * size + ids[ids >= 0]) if size else np.zeros(0, np.int64)
    stride, term = (key // size, key % size) if size else (key, key)
    out = []
    hits: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for s in index.likely(stride, term, int(first[-1]), threshold) if len(stride) else ():
        a, b = np.searchsorted(stride, [s, s + 2])
        doc = int(np.searchsorted(first, s, "right")) - 1
        for seg, score in index.search(np.unique(term[a:b]).tolist(), threshold):
            hits[doc][index.items[seg]].append((-score, int(s - first[doc]) * STRIDE, seg))
    for doc, items in hits.items():
        name, words = docs[doc]
        for item, found in items.items():
            best = None
            for score, start, seg in sorted(found):
                question, answer = question_answer(index.texts[seg])
                margin = len(question) + len(answer)
                near, grams = words[max(0, start - margin):start + 2 * STRIDE + margin], {}
                q, a = overlap(question, near, grams), overlap(answer, near, grams)
                if q >= MIN_QUESTION and a >= MIN_ANSWER:
                    best = (name, item, -score, q, a)
                    break
            if best:
                out.append(best)
    return out


def segments(benchmark: DataFrame) -> DataFrame:
    """(item_id, text, segment, words): segments of all items."""
    def run(batches):
        for b in batches:
            rows = [(i, t, s, words[s * SEGMENT:(s + 1) * SEGMENT]) for i, t in zip(b.column("item_id").to_pylist(), texts(b.column("text")))
                    if (words := words_of(t)) for s in range(-(-len(words) // SEGMENT))]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                                              pa.array(cols[3], pa.list_(pa.binary()))], ["item_id", "text", "segment", "words"])

    return map_batches(pick(benchmark, "item_id", "text"), run, "item_id long, text binary, segment int, words array<binary>")


def indexes(benchmark: DataFrame, shard: int = SHARD) -> Iterator[Index]:
    """One index after the other, each of about ``shard`` segments."""
    seg = materialise(segments(benchmark), "decontam-segments")
    total = seg.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean")).first()
    if not total["n"]:
        return
    parts = -(-total["n"] // shard)
    seg = seg.withColumn("part", F.pmod(F.xxhash64("item_id", "segment"), F.lit(parts)))
    seen = seg.select("part", F.explode(F.array_distinct("words")).alias("word"))
    df = seen.groupBy("word").agg(F.count("*").alias("df"))
    for k in range(parts):
        rows = seg.filter(F.col("part") == k).orderBy("item_id", "segment", "text").collect()
        mine = seen.filter(F.col("part") == k).select("word").distinct().join(df, "word").collect()
        yield Index([(r["item_id"], bytes(r["text"]), r["segment"]) for r in rows], {bytes(r["word"]): r["df"] for r in mine},
                    total["n"], total["mean"])


def contaminated(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, score, question_overlap, answer_overlap."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(benchmark, shard):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for b in batches:
                rows = find([(d, words_of(t)) for d, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text")))], shared.value)
                cols = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in schema.split(", ")])

        part = map_batches(pick(docs, "doc_id", "text"), run, schema)
        out = part if out is None else out.union(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    # an item with segments in several shards, or a repeated document
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """The rows of ``docs`` in whose text no test item is found, all columns as they are."""
    for index in indexes(benchmark, shard):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for b in batches:
                rows = [(k, words_of(t)) for k, t in enumerate(texts(b.column("text")))]
                bad = {hit[0] for hit in find(rows, shared.value)}
                yield b.filter(pa.array([k not in bad for k, _ in rows], pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
    return docs


def q_op3(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
