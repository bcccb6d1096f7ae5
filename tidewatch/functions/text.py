"""Text column builders (T-01 .. T-13)."""
from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

def _fold_table() -> tuple[str, str]:
    """Letters whose compatibility decomposition is one ASCII letter or digit and marks, and that character."""
    pairs = []
    for k in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF10, 0xFF5B)]:
        base = [c for c in unicodedata.normalize("NFKD", chr(k)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0].isascii() and base[0].isalnum():
            pairs.append((chr(k), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, UNACCENTED = _fold_table()


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def normalize_text(x) -> Column:
    """T-01: strip, fold accents (composed and decomposed), non-alphanumerics -> space, collapse, lower.

    Missing -> "".
    """
    s = F.translate(F.regexp_replace(F.trim(_c(x)), r"\p{M}", ""), ACCENTED, UNACCENTED)
    s = F.regexp_replace(s, r"[^a-zA-Z0-9\s]", " ")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.coalesce(F.trim(F.lower(s)), F.lit(""))


def simple_key(x) -> Column:
    """T-02: strip, lower, spaces -> underscores."""
    return F.replace(F.lower(F.trim(_c(x))), F.lit(" "), F.lit("_"))


def remove_suffixes(x, suffixes) -> Column:
    """T-03: remove literal suffix texts (every occurrence, in order)."""
    out = _c(x)
    for s in suffixes:
        out = F.replace(out, F.lit(s), F.lit(""))
    return F.trim(out)


def zero_pad_code(x, width: int = 5) -> Column:
    """T-04: integer code -> zero-padded text; missing -> 0 -> "00000".

    Codes longer than ``width`` are kept whole (``lpad`` would cut them).
    """
    s = F.coalesce(_c(x).try_cast("long"), F.lit(0)).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def split_list(x, sep: str = ",") -> Column:
    """T-05: split list text, trim items, drop empties."""
    items = F.transform(F.split(F.coalesce(_c(x), F.lit("")), sep), lambda e: F.trim(e))
    return F.filter(items, lambda e: e != F.lit(""))


def extract_zip_codes(x) -> Column:
    """T-06: distinct sorted five-digit codes found in the text."""
    found = F.regexp_extract_all(F.coalesce(_c(x), F.lit("")), F.lit(r"\b\d{5}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(found))


def first_flag(x) -> Column:
    """T-07: first item of a comma list as int, failure -> 0."""
    return F.coalesce(F.trim(F.split_part(_c(x), F.lit(","), F.lit(1))).try_cast("int"), F.lit(0))


def last_path_segment(x) -> Column:
    """T-08: last segment of a URL path."""
    return F.element_at(F.split(_c(x), "/"), -1)


def contains_ci(x, needle: str) -> Column:
    """T-12: case-insensitive substring test; missing text -> false."""
    return F.coalesce(F.lower(_c(x)).contains(needle.lower()), F.lit(False))
