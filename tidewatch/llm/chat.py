"""Chat formatting by token-level assembly.

Every turn is encoded on its own: its text is escaped, encoded as plain text,
and reserved ids (above the vocabulary) are spliced around it, so no text can
ever produce a reserved id.  The loss mask is the prefix sum of +1 / -1 steps
at the reserved ids of assistant turns, and a segment's place in its
conversation the prefix sum of lengths, both carried along the sorted rows.

Template: ``[INST]text[/INST]`` for user, ``<s>text</s>`` for assistant,
``<<SYS>>text<</SYS>>`` for system, ``<|role|>role<|text|>text<|end|>`` for any
other role.  A control string inside a text (or role) gets one more backslash
after its first character, whatever number it already has; reading back
removes one.

Encoding and escaping happen row by row before the shuffle.  After it each
conversation is one ordered stream in constant memory, since a digest of a
whole conversation needs its turns in order; nothing is gathered, also where
one conversation holds a third of all rows.

Defined cases: null text is empty, null role is the empty role; turns with the
same number go by role, then by the md5 of the text; null turns come first;
repeated rows are formatted as often as they occur; an empty table gives no
rows; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bpe import RANKS, encoder
from tidewatch.llm.common import map_batches, pick, table, texts

CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>"]
ESCAPED = [*CONTROL, "<|endoftext|>"]
FIRST_ID = 50_257
IDS = {c: FIRST_ID + k for k, c in enumerate(CONTROL)}
FRAME = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OPENED = {IDS[a]: role for role, (a, _) in FRAME.items()}
_ANY = "|".join(sorted((f"{re.escape(c[0])}(?=\\\\*{re.escape(c[1:])})" for c in ESCAPED), reverse=True))
_ESCAPE = re.compile(f"({_ANY})")
_UNESCAPE = re.compile("({})\\\\".format("|".join(sorted((f"{re.escape(c[0])}(?=\\\\+{re.escape(c[1:])})" for c in ESCAPED), reverse=True))))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def segment(role: str, text: str, ranks: str = RANKS) -> np.ndarray:
    """Ids of one turn."""
    encode = encoder(ranks).encode_ordinary
    body = encode(escape(text))
    if role in FRAME:
        a, b = FRAME[role]
        ids = [IDS[a], *body, IDS[b]]
    else:
        ids = [IDS["<|role|>"], *encode(escape(role)), IDS["<|text|>"], *body, IDS["<|end|>"]]
    return np.array(ids, np.int32)


def loss_mask(ids: np.ndarray) -> np.ndarray:
    """1 for tokens of assistant texts: prefix sums of steps at the assistant's reserved ids."""
    steps = np.zeros(len(ids) + 1, np.int8)
    steps[1:] += ids == IDS["<s>"]  # from the next token on
    steps[:-1] -= ids == IDS["</s>"]
    return np.cumsum(steps[:-1], dtype=np.int8)


def decode(ids: np.ndarray, ranks: str = RANKS) -> str:
    """Text of plain ids; reserved ids give nothing."""
    return encoder(ranks).decode_bytes(ids[ids < FIRST_ID].tolist()).decode("utf-8")


def rendered(ids: np.ndarray, ranks: str = RANKS) -> str:
    """The formatted text: control strings for reserved ids, texts escaped."""
    out, cut = [], np.flatnonzero(ids >= FIRST_ID)
    at = 0
    for k in cut:
        out += [decode(ids[at:k], ranks), CONTROL[ids[k] - FIRST_ID]]
        at = k + 1
    return "".join(out) + decode(ids[at:], ranks)


def turns(ids: np.ndarray, ranks: str = RANKS) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn in a run of ids."""
    cut = np.flatnonzero(ids >= FIRST_ID)
    k = 0
    while k < len(cut):
        a = ids[cut[k]]
        part = lambda n: unescape(decode(ids[cut[n] + 1:cut[n + 1]], ranks))
        if a in OPENED:
            yield OPENED[a], part(k)
            k += 2
        else:
            yield part(k), part(k + 1)
            k += 3


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), kind))


def _numpy(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a - ends[0]:b - ends[0]] for a, b in zip(ends, ends[1:])]


def format_conversations(conversations: DataFrame, ranks: str = RANKS) -> DataFrame:
    """One row per turn, ordered within its conversation: conv_id, turn, start, ids, loss_mask.

    ``start`` is the place of the segment's first token in its conversation.
    """
    def encode(batches):
        for b in batches:
            rows = [segment((r or b"").decode(), (t or b"").decode(), ranks)
                    for r, t in zip(texts(b.column("role")), texts(b.column("text")))]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), b.column("o_role"), b.column("o_text"),
                                              _lists(rows, pa.int32())], ["conv_id", "turn", "o_role", "o_text", "ids"])

    def assemble(batches):
        conv, start = object(), 0
        for b in batches:
            rows, starts = _numpy(b.column("ids")), []
            for c, ids in zip(b.column("conv_id").to_pylist(), rows):
                if c != conv:
                    conv, start = c, 0
                starts.append(start)
                start += len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), pa.array(starts, pa.int64()), b.column("ids"),
                 _lists([loss_mask(x) for x in rows], pa.int8())], ["conv_id", "turn", "start", "ids", "loss_mask"])

    rows = pick(conversations, "conv_id", "turn", "role", "text")
    rows = rows.withColumn("o_role", F.coalesce("role", F.lit("")))
    rows = rows.withColumn("o_text", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    rows = map_batches(rows, encode, "conv_id long, turn long, o_role string, o_text binary, ids array<int>")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "o_role", "o_text")
    return map_batches(rows, assemble, "conv_id long, turn long, start long, ids array<int>, loss_mask array<tinyint>")


def read_back(segments: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Digests per conversation from the formatted tokens alone (rows ordered as formatted)."""
    def run(batches):
        conv, state = None, None
        done: list[tuple] = []

        def end():
            if state is not None:
                n, turns_sha, chars, loss_sha, formatted = state
                done.append((conv, n, turns_sha.hexdigest(), chars, loss_sha.hexdigest(), formatted))

        def flush():
            cols = list(zip(*done)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            done.clear()
            return batch

        for b in batches:
            for c, ids, mask in zip(b.column("conv_id").to_pylist(), _numpy(b.column("ids")), _numpy(b.column("loss_mask"))):
                if state is None or c != conv:
                    end()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in turns(ids, ranks):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                learned = unescape(decode(ids[mask > 0], ranks))
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(rendered(ids, ranks))
            yield flush()
        end()
        yield flush()

    return map_batches(segments, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


def q_op5(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    given = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(given.unionByName(more)))


_ESC_SQL = ("regexp_replace({x}, '(<)(\\\\*)(s>|/s>|<SYS>>|</SYS>>|\\|role\\|>|\\|text\\|>|\\|end\\|>|\\|endoftext\\|>)"
            "|(\\[)(\\\\*)(INST\\]|/INST\\])', '\\1\\4\\\\\\2\\5\\3\\6', 'g')")
ORACLE_OP5 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, md5(text) AS m FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, m)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, m) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESC_SQL.format(x='text')}) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
      ELSE 23 + length({_ESC_SQL.format(x='role')}) END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""
