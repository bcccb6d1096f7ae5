"""Documents with awkward rows, shared by the tests of this folder."""
import random

DOC = "doc_id long, text string, lang string, source string, n_chars long, part string, score string, kept string, word string, n long, g string"


def documents(spark, rows):
    """Rows (doc_id, text[, lang, source]) with extra columns that carry names the operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "x", "x", "x", "x", 7, "x") for r in rows]
    return spark.createDataFrame(full, DOC)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(2, 9))) for _ in range(n))


def awkward():
    """Null, empty, blank, very short, very long, non-ASCII, tied and repeated rows."""
    long_text = prose(1, 20_000)
    base = prose(2, 300)
    words = base.split()
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four"), (6, "one two three four"),
        (7, long_text), (8, long_text), (9, base), (9, base), (10, " ".join(words[:290] + ["x"] * 10)),
        (11, " ".join(words[:150]) + " " + prose(3, 150)), (12, "Größe ÉTÉ İ K     日本語 text"), (13, base.upper()),
        (None, prose(4, 40)), (15, "a b c d e " * 200), (16, prose(5, 12), None, None), (17, prose(6, 50), "fr", None),
    ]
