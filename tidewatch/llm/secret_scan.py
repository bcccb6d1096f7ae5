"""Secret scans: fixed patterns, and guess costs of values in a credential context.

The fixed kinds are ``assign``, ``access`` and ``hex``.  The method adds
``guess``: a value that follows a credential word and ``:`` or ``=`` and that
would take many guesses, unless it lies inside an ``assign`` span (both are
kept if only a part of it does).  The cost is the minimum over all segmentations of
the value into dictionary words, dates, repeated characters, keyboard walks (along
rows, columns and the alphabet, of any length) and brute-force characters, found by
dynamic programming (log10 of guesses, added over segments).  The dictionary is a
short list of frequent passwords and the words of a public tokenizer's vocabulary,
whose order is that of frequency; its file is a parameter.

Values that are plainly something else are left alone: addresses without user data,
calls and member chains of code, placeholders, and quoted sentences of dictionary
words (but not after ``passphrase``).

Defined cases: null text counts as empty (no spans, hash of the empty text);
repeated rows give repeated result rows; an empty table gives no rows;
positions are code points, ends exclusive; extra columns are ignored (``redact`` keeps
them); a text and a value may have any length, the cost takes time in proportion.
"""
from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.bpe import RANKS, encoder
from tidewatch.llm.common import map_batches, pick, table, texts

KINDS = ["assign", "access", "hex", "guess"]
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are whole: a shorter run cannot start a match
HEX_BYTES = re.compile(rb"[0-9a-f]{16,}")
#: Context words start a word, also inside a camel-case name; a quoted value ends at its closing quote, others at space , ; < > or a quote.
CONTEXT = re.compile(r"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z]))"
                     r"(?i:(password|passwd|passphrase|passcode|pass|pwd|secret|token|api[_-]?key|credentials?|login|auth))"
                     r"[\"']?[\x20\t]*(?:[:=]|=>)[\x20\t]*"
                     r"(?:([\"'])(?!\s)((?:(?!\2)[^\\\r\n]|\\.)++)(?=\2)|[\"']?([^\s\"'<>,;]+))", re.A)
HINTS = (b"pass", b"pwd", b"secret", b"token", b"api", b"credential", b"login", b"auth")

#: Guesses, as a power of ten, from which a value counts as a secret.
MIN_COST = 10.0
SEGMENT_COST = 0.3
#: Frequent words and passwords, most frequent first; the rank is the number of guesses.
WORDS = ("password pass admin login welcome letmein qwerty dragon monkey master hello secret freedom shadow sunshine "
         "princess football baseball superman batman trustno iloveyou whatever michael jordan hunter ranger killer "
         "pepper joshua maggie summer winter spring autumn love money test user guest root default changeme change "
         "example sample value token key none null true false your here this that with from have the and for you").split()
#: Vocabulary whose words follow, and their least length.
VOCABULARY = RANKS
SHORTEST_WORD = 3
LEET = str.maketrans("430157@$!", "aeoistasi")
ROWS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz"]
#: Columns of the keyboard; a walk may go on from the foot of one at the head of the next.
COLUMNS = ["1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm"]
STEPS = {(a, b) for r in ROWS + COLUMNS for a, b in [*zip(r, r[1:]), *zip(r[1:], r)]}
STEPS |= {(a[-1], b[k]) for a, b in zip(COLUMNS, COLUMNS[1:]) for k in (0, 1)} | {(a[k], b[-1]) for b, a in zip(COLUMNS, COLUMNS[1:]) for k in (0, 1)}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01]))?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d", re.A)
YEAR_COST, DATE_COST = math.log10(130), math.log10(365 * 130)
WALK_COST = math.log10(47 * 4)


def brute_cost(c: str) -> float:
    """log10 of the characters of ``c``'s class."""
    if c.isascii() and c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33)


@functools.lru_cache(maxsize=2)
def dictionary(vocabulary: str = VOCABULARY) -> tuple[dict[str, float], int]:
    """log10 of the rank of every word, and the longest word's length."""
    e = encoder(vocabulary)
    rank: dict[str, int] = {}
    found = (e.decode_single_token_bytes(k).strip().lower() for k in range(e.n_vocab - 1))
    for w in (*WORDS, *(x.decode() for x in found if len(x) >= SHORTEST_WORD and x.isalpha() and x.isascii())):
        rank.setdefault(w, len(rank) + 2)
    return {w: math.log10(r) for w, r in rank.items()}, max(map(len, rank))


def word_cost(s: str, words: dict[str, float]) -> float:
    """Cost of ``s`` as a word, in another case (+0.6) or with letters written as digits (+0.6)."""
    low = s.lower()
    plain = words.get(low, math.inf)
    spelled = words.get(low.translate(LEET), math.inf) + 0.6
    return min(plain, spelled) + (0.6 if low != s else 0.0)


def guess_cost(value: str, vocabulary: str = VOCABULARY) -> float:
    """log10 of the guesses of the cheapest segmentation of ``value``; 0 for the empty text.

    Words and dates are short, so all that end at a character are tried.  Of the repeats and
    walks that end there, those that begin near the beginning of their run are enough: one
    that begins later, with the run's head as another such segment, is dearer than the two
    as one, and only a word or date can make up the head more cheaply.
    """
    words, longest = dictionary(vocabulary)
    best = [0.0] * (len(value) + 1)
    low = value.lower()
    if len(low) != len(value):  # a letter whose lower case is longer
        low = "".join(c if len(c.lower()) > 1 else c.lower() for c in value)
    short = max(longest, 10)
    same = walk = 1  # lengths of the runs that end at the current character
    upper = 0  # last capital of the text so far, counted from 1
    for j in range(1, len(value) + 1):
        if low[j - 1] != value[j - 1]:
            upper = j
        cost = best[j - 1] + brute_cost(value[j - 1])
        if j > 1:
            same = same + 1 if value[j - 1] == value[j - 2] else 1
            walk = walk + 1 if (low[j - 2], low[j - 1]) in STEPS else 1
        for n in range(2, min(j, short) + 1):
            s = value[j - n:j]
            p = word_cost(s, words) if n <= longest else math.inf
            if 4 <= n <= 10 and DATE.fullmatch(s):
                p = min(p, YEAR_COST if n == 4 and s[:2] in ("19", "20") else DATE_COST)
            if p < math.inf:
                cost = min(cost, best[j - n] + p + SEGMENT_COST)
        if same >= 3:
            unit = brute_cost(value[j - 1])
            for n in range(max(3, same - short), same + 1):
                cost = min(cost, best[j - n] + unit + math.log10(n) + SEGMENT_COST)
        if walk >= 3:
            for n in range(max(3, walk - short), walk + 1):
                cost = min(cost, best[j - n] + WALK_COST + math.log10(n) + (0.6 if upper > j - n else 0.0) + SEGMENT_COST)
        best[j] = cost
    return best[-1]


#: Addresses without user data; calls, indexing and chains of names in code; placeholders.
ADDRESS = re.compile(r"[a-z][a-z0-9+.-]*://[^\s@]*", re.I)
CODE = re.compile(r"([A-Za-z_$]+(?:(?:\.|->|::)[A-Za-z_$]+)*)(?:\([^()]*\)|\[[^\[\]]*\])?(?:[;,)\]]|\.\w+\(.*)?", re.A)
PLACEHOLDER = re.compile(r"\$?\{[^{}]*\}\}?|\$[A-Z_]+|<[^<>]*>|%[A-Z_]+%|\*+|[xX]+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def is_code(value: str, words: dict[str, float]) -> bool:
    """A call, an indexing or a chain of names, the names made of dictionary words."""
    m = CODE.fullmatch(value)
    if not m or m[1] == value and not re.search(r"\.|->|::", value):  # one bare name is a value
        return False
    parts = NAME_PARTS.findall(m[1])
    return bool(parts) and all(len(p) <= 2 or p.lower() in words for p in parts)


def plainly_none(key: str, value: str, vocabulary: str = VOCABULARY) -> bool:
    """Whether a value is an address, code, a placeholder or a sentence."""
    words, _ = dictionary(vocabulary)
    if ADDRESS.fullmatch(value) or PLACEHOLDER.fullmatch(value) or is_code(value, words):
        return True
    parts = value.split()
    if len(parts) < 3 or key.lower() == "passphrase":
        return False
    plain = [p.strip(".,;:!?'()").lower() for p in parts]
    known = sum(p in words or (len(p) <= 2 and p.isalpha()) for p in plain)
    return 4 * known >= 3 * len(parts) and all(p.isalpha() or not p for p in plain)


def find_spans(text: bytes | None, min_cost: float = MIN_COST) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    if not text:
        return []
    low = text.lower()
    context = any(h in low for h in HINTS)
    access, hexes = b"AKIA" in text, HEX_BYTES.search(text)
    if not (context or access or hexes):
        return []
    s = text.decode("utf-8", "replace")
    out = []
    if context:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(s) if len(m[2]) >= 12]
        taken = [(a, b) for _, a, b in out]
        for m in CONTEXT.finditer(s):
            a, b = m.span()
            value = m[3] or m[4]
            if (not any(x <= a and b <= y for x, y in taken) and not plainly_none(m[1], value)
                    and guess_cost(value) >= min_cost):
                out.append(("guess", a, b))
    if access:
        out += [("access", *m.span()) for m in ACCESS.finditer(s) if len(m[0]) >= 18]
    if hexes:
        out += [("hex", *m.span()) for m in HEX.finditer(s)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [find_spans(t) for t in texts(b.column("text"))]
        base = [[x for x in f if x[0] != "guess"] for f in found]
        count = lambda kind: pa.array([sum(x[0] == kind for x in f) for f in found], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), count("assign"), count("access"), count("hex"), count("guess"),
             pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in base], pa.string()),
             pa.array([joined(f) for f in found], pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts per kind, digest of the fixed kinds' spans, and all spans."""
    return map_batches(pick(docs, "doc_id", "text"), _scan,
                       "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")


def redact_text(text: bytes | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlaps merged) replaced by ``mark``."""
    if text is None:
        return None
    spans = find_spans(text)
    s = text.decode("utf-8", "replace")
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [s[at:a], mark]
        at = max(at, b)
    return "".join(out) + s[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced; ``n_chars`` follows where the text changed, other columns stay."""
    fields = docs.columns

    def run(batches):
        for b in batches:
            old = texts(b.column("text"))
            new = [redact_text(t) for t in old]
            cols = {f: b.column(f) for f in fields}
            cols["text"] = pa.array(new, pa.string())
            if "n_chars" in cols:
                chars = [c if x is None or x.encode() == o else len(x)
                         for c, x, o in zip(cols["n_chars"].to_pylist(), new, old)]
                cols["n_chars"] = pa.array(chars, cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), fields)

    return map_batches(docs, run, docs.schema)


def q_op10(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents"))
