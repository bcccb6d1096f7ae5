"""Quality rules with thresholds that adapt to each language and source.

Every document gets a few ratios (per mille, whole numbers).  Their
distribution is kept per (lang, source) in a mergeable quantile sketch: a
histogram whose buckets keep the top six bits of a value, so any quantile is
right to 1/32 of its value, and two sketches merge by adding counts (the
group-by does it, map-side first).  Limits are fences around the median taken
from the group's sketch; a group with few rows uses the merged sketch of its
language, and a language with few rows the merged sketch of all rows.  The
limits, one row per group, are then joined to the documents.

Defined cases: null text counts as empty (n_words 0, base_failed, not kept);
null lang or source form groups of their own; repeated rows give repeated
result rows; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, materialise, pick, texts

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
RUN = 5
#: Groups with fewer rows than this use the next wider sketch.
MIN_ROWS = 200
#: Copies of each group's limits; a hot source is spread over so many join keys.
SALTS = 32
#: feature -> (spreads allowed from the median, slack below or None, slack above)
FENCES = {
    "symbols_pm": (4, None, 50),
    "dup_lines_pm": (4, None, 350),
    "repeats_pm": (4, None, 100),
    "word_len_pc": (4, 250, 250),
}
METRICS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """Words that stand in a window of ``run`` words found twice or more."""
    windows = list(zip(*(words[k:] for k in range(run))))
    seen: set = set()
    twice: set = set()
    if len(set(windows)) == len(windows):
        return 0
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered = bytearray(len(words))
    mark = b"\1" * run
    for i, w in enumerate(windows):
        if w in twice:
            covered[i:i + run] = mark
    return sum(covered)


def measure(text: bytes | None) -> tuple[int, ...]:
    """The METRICS of one text."""
    text = text or b""
    words = text.split()
    chars = len(text.translate(None, SPACE + CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = list(zip(*(measure(t) for t in texts(b.column("text"))))) or [()] * len(METRICS)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("lang"), b.column("source"), *(pa.array(c, pa.int64()) for c in rows)],
            ["doc_id", "lang", "source", *METRICS])


def measured(docs: DataFrame) -> DataFrame:
    """One row per document: its metrics, ``base_failed`` and the per-mille features."""
    m = map_batches(pick(docs, "doc_id", "lang", "source", "text"), _measure_batches,
                    "doc_id long, lang string, source string, " + ", ".join(f"{x} long" for x in METRICS))
    per = lambda a, b, k: F.expr(f"({k} * {a}) div greatest({b}, 1)")
    return (m.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
            .withColumn("symbols_pm", per("n_symbols", "word_chars", 1000))
            .withColumn("dup_lines_pm", per("n_dup_lines", "n_lines", 1000))
            .withColumn("repeats_pm", per("n_repeat_words", "n_words", 1000))
            .withColumn("word_len_pc", per("word_chars", "n_words", 100)))


def bucket(value: Column) -> Column:
    """Lower edge of a value's bucket: its top six bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts per group, feature and bucket: the mergeable form."""
    long = rows.select(*by, F.expr("stack({}, {}) AS (feature, value)".format(
        len(FENCES), ", ".join(f"'{f}', {f}" for f in FENCES))))
    return long.groupBy(*by, "feature", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "feature", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: rows seen and the quartiles of each feature."""
    key = [*by, "feature"]
    w = Window.partitionBy(*key)  # at most a few hundred buckets per feature
    run = F.sum("n").over(w.orderBy("bucket"))
    s = sketches.withColumn("upto", run).withColumn("total", F.sum("n").over(w))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bucket")))
    s = s.groupBy(*key).agg(F.max("total").alias("total"), *[at(k).alias(f"q{k}") for k in (1, 2, 3)])
    return s.groupBy(*by).agg(
        F.max("total").alias("rows"),
        *[F.max(F.when(F.col("feature") == f, F.col(f"q{k}"))).alias(f"{f}_q{k}") for f in FENCES for k in (1, 2, 3)])


def limits(sketches: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source): low and high limit of each feature, and the sketch they come from."""
    own = quantiles(sketches, ["lang", "source"]).withColumn("level", F.lit(0))
    lang = quantiles(merge(sketches, ["lang"]), ["lang"]).withColumns({"source": F.lit(None).cast("string"), "level": F.lit(1)})
    every = quantiles(merge(sketches, []).withColumn("lang", F.lit(None).cast("string")), ["lang"]).withColumns(
        {"source": F.lit(None).cast("string"), "level": F.lit(2)})
    levels = own.unionByName(lang).unionByName(every).withColumnsRenamed({"lang": "l_lang", "source": "l_source", "level": "l_level"})
    nothing = F.lit(None).cast("string")
    wanted = sketches.select("lang", "source").distinct().select("lang", "source", F.explode(F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang").alias("k_lang"), F.col("source").alias("k_source")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("k_lang"), nothing.alias("k_source")),
        F.struct(F.lit(2).alias("level"), nothing.alias("k_lang"), nothing.alias("k_source")))).alias("k"))
    x = wanted.join(levels, (F.col("k.level") == F.col("l_level")) & F.col("k.k_lang").eqNullSafe(F.col("l_lang"))
                    & F.col("k.k_source").eqNullSafe(F.col("l_source")))
    x = x.filter((F.col("rows") >= min_rows) | (F.col("l_level") == 2))
    x = x.groupBy("lang", "source").agg(F.min_by(F.struct("l_level", *[f"{f}_q{k}" for f in FENCES for k in (1, 2, 3)]), "l_level").alias("x")).select("lang", "source", "x.*")
    cols = []
    for f, (spreads, below, above) in FENCES.items():
        q1, mid, q3 = (F.col(f"{f}_q{k}") for k in (1, 2, 3))
        # features bounded below by 0 use the spread of the lower half, which junk cannot widen
        up = mid + spreads * ((q3 - mid) if below is not None else (mid - q1)) + above
        down = mid - spreads * (mid - q1) - below if below is not None else F.lit(0).cast("long")
        cols += [down.alias(f"{f}_low"), up.alias(f"{f}_high")]
    level = F.element_at(F.array(*map(F.lit, ["own", "lang", "all"])), F.col("l_level") + 1)
    return x.select("lang", "source", level.alias("limits_from"), *cols)


def quality_rules(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """All documents with metrics, limits used and the decision ``kept``."""
    rows = materialise(measured(docs), "quality-metrics")
    sk = sketch(rows.filter(~F.col("base_failed")), ["lang", "source"])
    lim = materialise(limits(sk, min_rows), "quality-limits")
    lim = (lim.withColumnRenamed("lang", "g_lang").withColumnRenamed("source", "g_source")
           .withColumn("g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(lim, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
                         & (F.col("salt") == F.col("g_salt")), "left")
    inside = reduce(lambda a, b: a & b, [F.col(f).between(F.col(f"{f}_low"), F.col(f"{f}_high")) for f in FENCES])
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop(
        "salt", "g_salt", "g_lang", "g_source")


def q_op1(spark, sf_dir):
    from tidewatch.llm.common import table
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_FENCE_SQL = ", ".join(
    (f"mid_{f} - {k} * (mid_{f} - lo_{f}) - {b} AS {f}_low, mid_{f} + {k} * (hi_{f} - mid_{f}) + {a} AS {f}_high" if b is not None
     else f"0 AS {f}_low, mid_{f} + {k} * (mid_{f} - lo_{f}) + {a} AS {f}_high") for f, (k, b, a) in FENCES.items())
ORACLE_OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, lang, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
toks AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
win AS (SELECT rid, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
        || ' ' || lead(word, 4) OVER o AS g FROM toks WINDOW o AS (PARTITION BY rid ORDER BY pos)),
rep AS (SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE g IS NOT NULL) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT pos + k) AS n FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM lines
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT w.rid, doc_id, lang, source, len(ws) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
        coalesce(ln.n, 0) AS n_lines, coalesce(ln.dup, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN ln ON w.rid = ln.rid LEFT JOIN cov ON w.rid = cov.rid),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        (1000 * n_symbols) // greatest(word_chars, 1) AS symbols_pm, (1000 * n_dup_lines) // greatest(n_lines, 1) AS dup_lines_pm,
        (1000 * n_repeat_words) // greatest(n_words, 1) AS repeats_pm, (100 * word_chars) // greatest(n_words, 1) AS word_len_pc
      FROM m),
l AS (UNPIVOT (SELECT lang, source, symbols_pm, dup_lines_pm, repeats_pm, word_len_pc FROM f WHERE NOT base_failed)
      ON symbols_pm, dup_lines_pm, repeats_pm, word_len_pc INTO NAME feature VALUE v),
b AS (SELECT lang, source, feature, (v // (1::BIGINT << greatest(length(bin(v)) - 6, 0)::INT)) * (1::BIGINT << greatest(length(bin(v)) - 6, 0)::INT) AS bucket,
        count(*) AS n FROM l GROUP BY ALL),
s AS (SELECT 0 AS lv, lang, source, feature, bucket, n FROM b
      UNION ALL SELECT 1, lang, NULL, feature, bucket, sum(n) FROM b GROUP BY lang, feature, bucket
      UNION ALL SELECT 2, NULL, NULL, feature, bucket, sum(n) FROM b GROUP BY feature, bucket),
c AS (SELECT *, sum(n) OVER (PARTITION BY lv, lang, source, feature ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY lv, lang, source, feature) AS total FROM s),
q AS (SELECT lv, lang, source, feature, max(total) AS total, min(bucket) FILTER (upto * 4 >= total) AS lo,
        min(bucket) FILTER (upto * 4 >= total * 2) AS mid, min(bucket) FILTER (upto * 4 >= total * 3) AS hi FROM c GROUP BY ALL),
p AS (SELECT lv, lang, source, max(total) AS total, {", ".join(f"max(lo) FILTER (feature = '{f}') AS lo_{f}, max(mid) FILTER (feature = '{f}') AS mid_{f}, max(hi) FILTER (feature = '{f}') AS hi_{f}" for f in FENCES)}
      FROM q GROUP BY lv, lang, source),
t AS (SELECT lv, lang, source, total, {_FENCE_SQL} FROM p),
pairs AS (SELECT lang, source FROM t WHERE lv = 0),
pick AS (SELECT pairs.lang, pairs.source, t.* EXCLUDE (lang, source),
           row_number() OVER (PARTITION BY pairs.lang, pairs.source ORDER BY t.lv) AS k
         FROM pairs JOIN t ON (t.lv = 0 AND t.lang IS NOT DISTINCT FROM pairs.lang AND t.source IS NOT DISTINCT FROM pairs.source)
           OR (t.lv = 1 AND t.lang IS NOT DISTINCT FROM pairs.lang) OR t.lv = 2
         WHERE t.total >= {MIN_ROWS} OR t.lv = 2)
SELECT f.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce({" AND ".join(f"{x} BETWEEN {x}_low AND {x}_high" for x in FENCES)}, FALSE) AS kept
FROM f LEFT JOIN pick ON f.lang IS NOT DISTINCT FROM pick.lang AND f.source IS NOT DISTINCT FROM pick.source AND pick.k = 1
"""
