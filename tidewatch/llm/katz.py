"""Language-model scores by Katz backoff.

    P(w | h) = d_c * c(h, w) / c(h)       if the n-gram was seen c times
             = alpha(h) * P(w | h')       else (h' drops the oldest word)
             = P(w | h')                  if h was never seen

with Good-Turing discounts d_c (c up to ``K``) and alpha(h) such that the
probabilities after h sum to 1 exactly: the mass the discounts free, over the
lower-order mass of the words not seen after h.  Lowest level: discounted
words, and one class for all unknown words that holds the freed mass.

All counts are over all training documents.  They are dealt by hash and never in
one place, in two tables per level: ``counts`` (n-grams by the hash of the whole
n-gram, so that the followers of a frequent history lie in all parts) and
``weights`` (histories: how many followers have each small count, and the
lower-order mass of all followers, from which alpha follows).  ``train`` stores
them; scores of the same documents need the answers only.

* Documents become *chunks* of up to ``CHUNK`` tokens, written once and bucketed
  by chunk: word hashes, and tokens as places in them.
* For each level a chunk sends each part its distinct n-grams with their
  training counts (a frequent n-gram costs one entry per chunk).  The part sums
  them and answers; of the chunks that hold an n-gram in training text the first
  one is told that it speaks for it.
* c(h) needs no question: it is the count of the n-gram that ends one token
  before, at the level below.
* A chunk adds up, per history, the n-grams it speaks for; parts by history sum
  these to the weights, and answer for the histories that the chunk has to back
  off from.  This is done in ``TURNS`` turns over the parts, so that only one
  turn's histories lie on disk at a time.  The chunk then evaluates one step of
  the recursion for each token; answers and the step before are deleted.
* Of a step only the counts, the kinds of the histories and P of the unseen
  n-grams are kept: P of a seen one follows from its counts.

A history's counts of counts make alpha(h) a function of the discounts, so
these, known only after the counts, need no second pass.  ``train`` keeps the
tables as a model, and ``score`` reads other documents against them.

Tokens: words without space or \\t-\\r, A-Z lower-cased, and one end per
document.  Words, n-grams and histories are 64-bit hashes.

Defined cases: null text is empty (one token, the end); a null id is in the
fold of the empty text; repeated rows are trained on and scored as often as
they occur; without training rows every token is unknown with probability 1;
an empty table gives no rows; extra columns are ignored.  Where the discounts
free nothing after h (no small counts), half a count is set aside; where all
words follow h, its counts are not discounted.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import (discard, fold, map_batches, materialise, pack, pack_planes, pick, release_shuffles, runs, shuffle_parts, table, texts,
                                  unpack, unpack_planes)

FOLDS = 10
ORDER = 3
K = 5
CHUNK = 1_000_000
TURNS = 2
END, BEGIN = (xxhash.xxh3_64_intdigest(x) for x in (b" end", b" begin"))  # no word has a space
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _pack_values(x: np.ndarray) -> bytes:
    """Floats as they are, or where many are equal the distinct ones and their places."""
    values, place = np.unique(x, return_inverse=True)
    if 2 * len(values) > len(x):
        return bytes(4) + x.tobytes()
    places = pack_planes(place)
    return len(places).to_bytes(4, "little") + places + values.tobytes()


def _unpack_values(x: bytes) -> np.ndarray:
    x = bytes(x)
    n = int.from_bytes(x[:4], "little")
    values = np.frombuffer(x[4 + n:], np.float64)
    return values[unpack_planes(x[4:4 + n])] if n else values


def _pack_keys(x: np.ndarray) -> bytes:
    """Sorted hashes by the byte planes of their steps."""
    return pack_planes(np.diff(x, prepend=np.uint64(0)))


def _unpack_keys(x: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(x)).view(np.uint64)


def _deal(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash; sorted hashes have sorted parts."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


# --- formulas ----------------------------------------------------------------------

def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d_0 .. d_K (d_0 unused); counts_of_counts are n_1 .. n_{K+1}."""
    n = [0, *counts_of_counts]
    d = np.ones(K + 1)
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        x = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
        d[r] = x if 0 < x < 1 else (r - 0.5) / r  # too few counts for the estimate
    return d


def discount(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c <= K, d[np.minimum(c, K)], 1.0)


def unigram(c: np.ndarray, stats: dict) -> np.ndarray:
    """P(w) by training count; 0 is the class of unknown words."""
    if not stats["total"]:
        return np.ones(len(c))
    d = discounts(stats["n"])
    r = np.arange(1, K + 1)
    freed = float(((1 - d[1:]) * r * np.array(stats["n"][:K])).sum()) / stats["total"]
    total = stats["total"]
    if freed <= 0:  # no small counts
        freed, total = 0.5 / (total + 0.5), total + 0.5
    return np.where(c > 0, discount(c, d) * c / total, freed)


#: How a history gives mass to unseen words: by its discounts, half a count set aside (it has no
#: small counts), or not at all (all words follow it).
BY_DISCOUNT, SET_ASIDE, NOTHING = 0, 1, 2


def seen(c: np.ndarray, c_h: np.ndarray, kind: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(w | h) by token, for words seen after h."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = discount(c, d) * c / c_h
        for k, more in ((NOTHING, 0.0), (SET_ASIDE, 0.5)):
            at = np.flatnonzero(kind == k)
            out[at] = c[at] / (c_h[at] + more)
    return out


def backoff(lower: np.ndarray, c: np.ndarray, c_h: np.ndarray, kind: np.ndarray, small: np.ndarray, mass: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(w | h) by token.  kind, small (followers of h with counts 1 .. K) and mass (lower-order
    probability of h's followers) are those of the token's history; the last two are read for unseen words only."""
    with np.errstate(divide="ignore", invalid="ignore"):
        freed = ((1 - d[1:]) * np.arange(1, K + 1) * small).sum(1) / c_h
        left = np.select([kind == NOTHING, kind == SET_ASIDE], [np.zeros(len(c)), 0.5 / (c_h + 0.5)], freed)
        alpha = np.where(kind == NOTHING, 0.0, left / (1 - mass))
    return np.where(c_h == 0, lower, np.where(c > 0, seen(c, c_h, kind, d), alpha * lower))


# --- chunks ------------------------------------------------------------------------

class Chunk:
    """Documents as places in a list of word hashes (frequent words first)."""

    def __init__(self, lengths: np.ndarray, train: np.ndarray, words: np.ndarray, tokens: np.ndarray):
        self.lengths, self.words, self.tokens = lengths, words, tokens
        self.train = np.repeat(train, lengths)

        self.starts = np.cumsum([0, *lengths[:-1]])

    def histories(self, k: int) -> np.ndarray:
        """Hash of the k - 1 words before each token."""
        w = self.words[self.tokens]
        place = np.arange(len(w)) - np.repeat(self.starts, self.lengths)
        h = np.full(len(w), k, np.uint64)
        for j in range(k - 1, 0, -1):
            word = np.full(len(w), BEGIN, np.uint64)
            word[j:] = w[:-j]
            word[place < j] = BEGIN
            h = _mix(h, word)
        return h

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct k-grams in order, and each token's place among them."""
        w = self.words[self.tokens]
        return np.unique(_mix(self.histories(k), w) if k > 1 else w, return_inverse=True)

    def before(self, x: np.ndarray, first) -> np.ndarray:
        """What x is at the token before; ``first`` at a document's first token."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.starts] = first
        return out


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * _ODD
    return h ^ (h >> np.uint64(31))


def _chunk(row) -> Chunk:
    return Chunk(unpack(row["lengths"], np.int64), unpack(row["train"], bool), unpack(row["words"], np.uint64),
                 unpack_planes(row["tokens"]))


CHUNKS = "chunk long, docs array<long>, lengths binary, train binary, words binary, tokens binary"


def chunks(docs: DataFrame, training: bool | None = None) -> DataFrame:
    """Documents in chunks; ``training``: all count (True), none (False), or those outside fold 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, lengths, held, places = [], [], [], {}

        def done():
            words = np.array([END if w == b"" else xxhash.xxh3_64_intdigest(w) for w in places], np.uint64)
            tokens = np.concatenate(held)
            order = np.argsort(-np.bincount(tokens), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            train = np.array([fold(d, FOLDS) != 0 if training is None else training for d in ids], bool)
            cols = [number, ids, pack(np.array(lengths, np.int64)), pack(train), pack(words[order]), pack_planes(rank[tokens])]
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)], [x.split()[0] for x in CHUNKS.split(", ")])

        size = 0
        for b in batches:
            for d, t in zip(b.column("doc_id").to_pylist(), texts(b.column("text"))):
                words = t.lower().split() if t else []
                words.append(b"")
                held.append(np.array([places.setdefault(w, len(places)) for w in words], np.uint32))
                ids.append(d)
                lengths.append(len(words))
                size += len(words)
                if size >= CHUNK:
                    yield done()
                    number, size = number + 1, 0
                    ids, lengths, held, places = [], [], [], {}
        if ids:
            yield done()

    return map_batches(pick(docs, "doc_id", "text"), run, CHUNKS)


# --- tables ------------------------------------------------------------------------

class Model(NamedTuple):
    """Stored tables by level, and the sums over all n-grams of each level."""

    parts: int
    stats: dict[int, dict]
    counts: dict[int, DataFrame]
    weights: dict[int, DataFrame]

    @property
    def order(self) -> int:
        return max(self.stats)


#: Counts by word at level 1, by token at the level before the last one (null: as by word) and at the last one; there, kinds of the
#: histories by token, and P of the tokens that were not seen.
KNOWN = "chunk long, counts binary, prior binary, last binary, kinds binary, p binary"
ASKED = "chunk long, part int, keys binary, counts binary"
COUNTED = "chunk long, part int, keys binary, counts binary, speaks binary, stats array<long>"
PLACED = "chunk long, now binary, speaks binary"
WEIGHED = "chunk long, part int, histories binary, small binary, mass binary, wanted binary"
WEIGHTS = "chunk long, part int, histories binary, kinds binary, small binary, mass binary"


def _frame(rows: list, schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")]).astype({"chunk": "Int64", "part": "Int32"})


def _joined(rows: pd.DataFrame, field: str, read, axis: int = 0) -> np.ndarray:
    """The arrays of all parts, in the order of the parts."""
    return np.concatenate([read(x) for x in rows.sort_values("part")[field]], axis)


def _pack_bits(x: np.ndarray) -> bytes:
    return len(x).to_bytes(4, "little") + pack(np.packbits(x))


def _bits(x: bytes) -> np.ndarray:
    return np.unpackbits(unpack(x[4:], np.uint8), count=int.from_bytes(x[:4], "little")).astype(bool)


def ask(held: DataFrame, parts: int, level: int) -> DataFrame:
    """Distinct n-grams of every chunk with their training counts, by part."""
    def run(left: pd.DataFrame) -> pd.DataFrame:
        c = _chunk(left.iloc[0])
        keys, gram = c.grams(level)
        counts = np.bincount(gram[c.train], minlength=len(keys)).astype(np.uint32)
        return _frame([(left["chunk"].iloc[0], p, _pack_keys(keys[a:b]), pack_planes(counts[a:b])) for p, a, b in runs(_deal(keys, parts))], ASKED)

    return held.groupBy("chunk").applyInPandas(run, ASKED)


def count(asked: DataFrame, keep: bool = False) -> DataFrame:
    """Answers (training counts in the order asked), and per part one row (chunk null) of sums, with ``keep`` also of the
    table of counts."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("chunk")
        asked_keys = [_unpack_keys(x) for x in g["keys"]]
        keys, place = np.unique(np.concatenate(asked_keys), return_inverse=True)
        counts = np.concatenate([unpack_planes(x) for x in g["counts"]])
        total = np.bincount(place, counts, len(keys)).astype(np.int64)
        training = np.flatnonzero(counts)[::-1]
        first = np.full(len(keys), -1)
        first[place[training]] = training
        speaks = np.zeros(len(place), bool)
        speaks[first[first >= 0]] = True
        cuts = np.cumsum([0, *map(len, asked_keys)])
        part = int(g["part"].iloc[0])
        rows = [(c, part, None, pack_planes(total[place[a:b]]), _pack_bits(speaks[a:b]), None)
                for c, a, b in zip(g["chunk"], cuts, cuts[1:])]
        known = total > 0
        some = total[known]
        stats = [int(some.sum()), len(some), *np.bincount(np.minimum(some, K + 2), minlength=K + 3)[1:K + 2].tolist()]
        stored = (_pack_keys(keys[known]), pack_planes(some)) if keep else (None, None)
        return _frame([*rows, (None, part, *stored, None, stats)], COUNTED)

    return asked.groupBy("part").applyInPandas(run, COUNTED)


def look_up_counts(asked: DataFrame, stored: DataFrame) -> DataFrame:
    """The same answers from a stored table of counts."""
    def run(g: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys, totals = ((_unpack_keys(known["keys"].iloc[0]), unpack_planes(known["counts"].iloc[0])) if len(known)
                        else (np.empty(0, np.uint64), np.empty(0, np.int64)))
        rows = []
        for c, part, x in zip(g["chunk"], g["part"], g["keys"]):
            found = _find(keys, totals, _unpack_keys(x))
            rows.append((c, part, None, pack_planes(found), _pack_bits(np.zeros(len(found), bool)), None))
        return _frame(rows, COUNTED)

    return asked.groupBy("part").cogroup(stored.groupBy("part")).applyInPandas(run, COUNTED)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, 0 for unknown ones (``keys`` in order)."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def word_level(held: DataFrame, answers: DataFrame) -> DataFrame:
    """Training counts of each chunk's words; P of a token at level 1 follows from them (``p`` is null)."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = _chunk(left.iloc[0])
        counts = np.empty(len(c.words), np.int64)
        counts[np.argsort(c.words)] = _joined(right, "counts", unpack_planes)
        return pd.DataFrame({"chunk": [left["chunk"].iloc[0]], "counts": [pack_planes(counts)], "prior": [None], "last": [None],
                             "kinds": [None], "p": [None]})

    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, KNOWN)


def _token_counts(row, c: Chunk) -> np.ndarray:
    """Training count of each token's word."""
    return unpack_planes(row["counts"])[c.tokens]


def _lower(row, c: Chunk, stats: dict, level: int) -> np.ndarray:
    """P of every token at ``level``, the one that is known."""
    if level == 1:
        return unigram(unpack_planes(row["counts"]), stats[1])[c.tokens]
    counts = unpack_planes(row["last"])
    out = seen(counts, _history_counts(row, c, "prior"), unpack(row["kinds"], np.uint8), discounts(stats[level]["n"]))
    out[counts == 0] = _unpack_values(row["p"])
    return out


def _history_counts(row, c: Chunk, below: str = "last") -> np.ndarray:
    """c(h) of every token at the next level (``prior``: at the one that is known): the count of what ends one token before,
    or of the documents."""
    words = _token_counts(row, c)
    return c.before(words if row[below] is None else unpack_planes(row[below]), words[c.lengths[0] - 1])


def _asks(counts: np.ndarray, c_h: np.ndarray, stats: dict) -> np.ndarray:
    """Tokens whose step needs their history's weights.  A seen n-gram with a small count tells that its history has one, an only
    follower with a large count that it has none, as long as not all words can follow."""
    sure = (counts > 0) & (c_h < stats[1]["distinct"]) & ((counts <= K) | (counts == c_h))
    return (c_h > 0) & ~sure


def place_counts(held: DataFrame, answers: DataFrame, level: int) -> DataFrame:
    """Every token's count, and one token of each n-gram that the chunk speaks for."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys, gram = _chunk(left.iloc[0]).grams(level)
        counts, speaks = _joined(right, "counts", unpack_planes), _joined(right, "speaks", _bits)
        place = np.empty(len(keys), np.int64)
        place[gram] = np.arange(len(gram))
        own = np.zeros(len(gram), bool)
        own[place[speaks]] = True
        return pd.DataFrame({"chunk": [left["chunk"].iloc[0]], "now": [pack_planes(counts[gram])], "speaks": [_pack_bits(own)]})

    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, PLACED)


def turns(parts: int) -> list[tuple[int, int]]:
    """Ranges of parts that are weighed one after the other."""
    cuts = [parts * k // TURNS for k in range(TURNS + 1)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def weigh(held: DataFrame, stats: dict, parts: int, level: int, start: int, end: int) -> DataFrame:
    """Per chunk and part of the histories (``start`` to before ``end``): what the chunk's n-grams add to their weights and
    which of them it asks for (``held``: chunks with what is known of the level below, and the tokens' counts as ``now``)."""
    def run(left: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        c = _chunk(row)
        counts, h = unpack_planes(row["now"]), c.histories(level)
        part = _deal(h, parts)
        here = (part >= start) & (part < end)
        place = np.flatnonzero(_bits(row["speaks"]) & here)
        own, at = np.unique(h[place], return_inverse=True)
        small = np.bincount(at * (K + 1) + np.minimum(counts[place], K + 1) - 1, minlength=len(own) * (K + 1)).reshape(-1, K + 1)[:, :K]
        mass = np.bincount(at, _lower(row, c, stats, level - 1)[place], len(own))
        wanted = np.unique(h[_asks(counts, _history_counts(row, c), stats) & here])
        numbers = np.arange(start, end + 1)
        cut, cut_wanted = (np.searchsorted(_deal(x, parts), numbers) for x in (own, wanted))
        rows = [(row["chunk"], p, _pack_keys(own[a:b]), pack_planes(small[a:b].T.ravel()), _pack_values(mass[a:b]), _pack_keys(wanted[x:y]))
                for p, a, b, x, y in zip(numbers, cut, cut[1:], cut_wanted, cut_wanted[1:]) if b > a or y > x]
        return _frame(rows, WEIGHED)

    return held.groupBy("chunk").applyInPandas(run, WEIGHED)


def _small(x: bytes) -> np.ndarray:
    return unpack_planes(x).reshape(K, -1)


def weights(weighed: DataFrame, keep: bool = False) -> DataFrame:
    """Answers for the histories asked for, and with ``keep`` per part one row (chunk null) of the table of weights."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("chunk")
        histories, at = np.unique(np.concatenate([_unpack_keys(x) for x in g["histories"]]), return_inverse=True)
        small = np.concatenate([_small(x) for x in g["small"]], 1)
        small = np.stack([np.bincount(at, x, len(histories)) for x in small]).astype(np.int64)
        mass = np.bincount(at, np.concatenate([_unpack_values(x) for x in g["mass"]]), len(histories))
        kinds = np.where(1 - mass <= 1e-12, NOTHING, np.where(small.any(0), BY_DISCOUNT, SET_ASIDE)).astype(np.uint8)
        part = int(g["part"].iloc[0])
        rows = _weight_answers(g, histories, kinds, small, mass)
        if keep:
            rows.append((None, part, _pack_keys(histories), pack(kinds), pack_planes(small.ravel()), _pack_values(mass)))
        return _frame(rows, WEIGHTS)

    return weighed.groupBy("part").applyInPandas(run, WEIGHTS)


def look_up_weights(weighed: DataFrame, stored: DataFrame) -> DataFrame:
    """The same answers from a stored table of weights."""
    def run(g: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(g) or not len(known):
            return _frame([], WEIGHTS)
        k = known.iloc[0]
        return _frame(_weight_answers(g, _unpack_keys(k["histories"]), unpack(k["kinds"], np.uint8), _small(k["small"]), _unpack_values(k["mass"])), WEIGHTS)

    return weighed.groupBy("part").cogroup(stored.groupBy("part")).applyInPandas(run, WEIGHTS)


def _weight_answers(g: pd.DataFrame, histories, kinds, small, mass) -> list[tuple]:
    rows = []
    for c, part, x in zip(g["chunk"], g["part"], g["wanted"]):
        at = np.searchsorted(histories, _unpack_keys(x))  # a history that was seen has followers
        if len(at):
            rows.append((c, part, None, pack(kinds[at]), pack_planes(small[:, at].ravel()), _pack_values(mass[at])))
    return rows


def probabilities(row, c: Chunk, answers: pd.DataFrame, stats: dict, level: int) -> tuple[np.ndarray, np.ndarray]:
    """P and kind of history of every token at ``level`` (above 1), from the level below and the weights of the histories asked for."""
    out, counts, c_h = _lower(row, c, stats, level - 1), unpack_planes(row["now"]), _history_counts(row, c)
    d = discounts(stats[level]["n"])
    kinds = np.where(counts <= K, BY_DISCOUNT, SET_ASIDE).astype(np.uint8)
    asked = np.flatnonzero(_asks(counts, c_h, stats))
    if len(asked):
        _, h = np.unique(c.histories(level)[asked], return_inverse=True)
        kinds[asked] = _joined(answers, "kinds", lambda x: unpack(x, np.uint8))[h]
        unseen = counts[asked] == 0
        at, h = asked[unseen], h[unseen]
        small, mass = _joined(answers, "small", _small, 1)[:, h].T, _joined(answers, "mass", _unpack_values)[h]
        out[at] = backoff(out[at], counts[at], c_h[at], kinds[at], small, mass, d)
    return np.where(counts > 0, seen(counts, c_h, kinds, d), out), kinds


def next_level(held: DataFrame, answers: DataFrame, stats: dict, level: int) -> DataFrame:
    """What is known of each chunk after ``level`` (``held``: with the level below, and the tokens' counts as ``now``)."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        p, kinds = probabilities(row, _chunk(row), right, stats, level)
        return pd.DataFrame({"chunk": [row["chunk"]], "counts": [row["counts"]], "prior": [row["last"]], "last": [row["now"]],
                             "kinds": [pack(kinds)], "p": [_pack_values(p[unpack_planes(row["now"]) == 0])]})

    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, KNOWN)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(row, c: Chunk, p: np.ndarray, stats: dict) -> pd.DataFrame:
    """One row per document of the chunk from P of its tokens."""
    counts = _token_counts(row, c)
    total, distinct = stats[1]["total"], stats[1]["distinct"]
    per = lambda x: np.add.reduceat(x, c.starts)
    base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
    ids = [None if d is None or d != d else int(d) for d in row["docs"]]
    return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "held_out": [fold(d, FOLDS) == 0 for d in ids], "n_tokens": c.lengths,
                         "n_known": per((counts > 0).astype(np.int64)), "train_tokens": total, "base_score": per(base), "score": per(np.log10(p))})


def evaluate(held: DataFrame, answers: DataFrame | None, stats: dict, level: int) -> DataFrame:
    """The documents' scores by the last level (level 1 has no answers)."""
    def words(left: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        c = _chunk(row)
        return _scores(row, c, _lower(row, c, stats, 1), stats)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        c = _chunk(row)
        return _scores(row, c, probabilities(row, c, right, stats, level)[0], stats)

    if answers is None:
        return held.groupBy("chunk").applyInPandas(words, SCORED)
    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, SCORED)


# --- runs --------------------------------------------------------------------------

def _stats(counted: DataFrame) -> dict:
    """Sums over the parts: a few numbers."""
    cols = [F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(K + 3)]
    r = [int(x or 0) for x in counted.filter("chunk IS NULL").agg(*cols).first()]
    return {"total": r[0], "distinct": r[1], "n": r[2:]}


def _run(docs: DataFrame, order: int, training: bool | None, model: Model | None = None, keep: bool = False) -> tuple[DataFrame | None, Model]:
    """Levels 1 to ``order`` over all documents: their scores, or with ``keep`` the tables instead.  A ``model`` answers in
    place of the documents' own counts."""
    parts = model.parts if model else 2 * shuffle_parts(docs.sparkSession)
    own = Model(parts, dict(model.stats) if model else {}, {}, {})
    held, known = materialise(chunks(docs, training), "katz-chunks", bucket="chunk"), None
    stored = lambda df, name, *cols: materialise(df.filter("chunk IS NULL").select("part", *cols), name, bucket="part")
    for level in range(1, order + 1):
        asked = ask(held, parts, level)
        counted = materialise(look_up_counts(asked, model.counts[level]) if model else count(asked, keep), f"katz-counted-{level}")
        if not model:
            own.stats[level] = _stats(counted)
        if keep:
            own.counts[level] = stored(counted, f"katz-counts-{level}", "keys", "counts")
        answers = counted.filter("chunk IS NOT NULL").select("chunk", "part", "counts", "speaks")
        if level == 1:
            known = materialise(word_level(held, answers), "katz-known-1", bucket="chunk")
            discard(counted)
            continue
        release_shuffles(docs.sparkSession)
        now = materialise(place_counts(held, answers, level), f"katz-now-{level}", bucket="chunk")
        discard(counted)
        state, answered = held.join(known, "chunk").join(now, "chunk"), []
        for start, end in turns(parts):
            release_shuffles(docs.sparkSession)
            weighed = weigh(state, own.stats, parts, level, start, end)
            answered.append(materialise(look_up_weights(weighed, model.weights[level].filter(F.col("part").between(start, end - 1))) if model
                                        else weights(weighed, keep), f"katz-answered-{level}"))
        answers = reduce(DataFrame.unionByName, answered)
        if keep:
            own.weights[level] = stored(answers, f"katz-weights-{level}", "histories", "kinds", "small", "mass")
        answers = answers.filter("chunk IS NOT NULL")
        release_shuffles(docs.sparkSession)
        if level < order:
            found = materialise(next_level(state, answers, own.stats, level), f"katz-known-{level}", bucket="chunk")
        elif not keep:
            return evaluate(state, answers, own.stats, level), own
        for t in (known, now, *answered):
            discard(t)
        release_shuffles(docs.sparkSession)
        known = found if level < order else None
    if keep:
        discard(held)
        return None, own
    return evaluate(held.join(known, "chunk"), None, own.stats, 1), own


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """The tables of all of ``docs``, stored under the checkpoint folder."""
    return _run(docs, order, True, keep=True)[1]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document, scored by the stored tables; columns as of ``score_documents``."""
    return _run(docs, model.order, False, model)[0]


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score and score (log10), trained on the same
    documents without fold 0."""
    return _run(docs, order, None)[0]


def q_op7(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))
